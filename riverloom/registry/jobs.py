"""Queries that read and write tables, and the end-to-end jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from riverloom import fixtures as fixture
from riverloom.functions.geometry import line_length, xy
from riverloom.functions.projection import reproject
from riverloom.operators.profiles import axis_summary
from riverloom.plans import load, marts, prepare
from riverloom.registry import ORACLES, query
from riverloom.registry.geometry import (
    CORNERS,
    CUTS,
    FEET,
    INSIDE,
    LINE_REGIONS,
    LOW,
    ON_EDGE,
    PIECE_STRAHLER,
    PROBES,
    REGION_EDGES,
    SEGMENTS,
    SPLIT,
    SWATH_EDGES,
    VERTICES,
    region_edges,
)
from riverloom.registry.sql import (
    AXIS_SUMMARY,
    LANDCOVER_WIDE,
    NETWORK_METRICS,
    REACH_ROWS,
    ctes,
    fx,
    linked,
)
from riverloom.registry.tables import DISTINCT_SITES, POSITION
from riverloom.schemas import SITE_RESPONSE, TABLES, struct
from riverloom.session import new_folder, saved
from riverloom.sources import readers, tables
from riverloom.streaming.metrics import stream_metrics

# --- sources -----------------------------------------------------------------------------


@query("metric_csv_scan", ctes(*fx("landcover")) + "SELECT * FROM fx_landcover")
def _(spark, sf):
    path = new_folder(spark, "csv")
    fixture.landcover(spark, sf).write.option("header", True).csv(path)
    schema = struct("axis long, measure long, side string, label string, area double, width1 double")
    return readers.read_metrics(spark, path, schema)


@query(
    "spatial_layer_scan",
    ctes(*fx("reach_vertices"), ("segs", SEGMENTS))
    + "SELECT axis, COUNT(*) + 1 AS n, ROUND(SUM(leng), 3) AS length FROM segs GROUP BY axis",
)
def _(spark, sf):
    path = new_folder(spark, "layer")
    fixture.reach_vertices(spark, sf).write.parquet(path)
    layer = readers.read_layer(spark, path, "line")
    return layer.select(
        "axis",
        F.size("geom").cast("long").alias("n"),
        F.round(line_length(F.col("geom")), 3).alias("length"),
    )


@query("site_registry_import", ctes(*fx("sites")) + DISTINCT_SITES)
def _(spark, sf):
    path = new_folder(spark, "responses")
    site = F.struct(
        "code_site",
        "libelle_site",
        "statut_site",
        F.col("x").alias("longitude_site"),
        F.col("y").alias("latitude_site"),
        F.struct(F.lit("Point").alias("type")).alias("geometry"),
    )
    # a response holds the sites of a range of codes
    page = F.floor(F.regexp_extract("code_site", r"(\d+)", 1).cast("long") / 100).alias("page")
    rows = fixture.sites(spark, sf)
    rows.groupBy(page).agg(F.collect_list(site).alias("data")).drop("page").write.json(path)
    responses = readers.read_sites(spark, path, SITE_RESPONSE, lines=True)
    imported = readers.import_sites(responses)
    return imported.select("code_site", "libelle_site", "statut_site", "x", "y")


# --- replacement ----------------------------------------------------------------------------

NEW_ROWS = "SELECT * REPLACE (area * 2 AS area) FROM fx_landcover WHERE axis % 3 = 0 AND measure < 2000"

REPLACED = ctes(*fx("landcover"), ("new_rows", NEW_ROWS)) + """SELECT * FROM fx_landcover
WHERE axis NOT IN (SELECT axis FROM new_rows) UNION ALL SELECT * FROM new_rows"""


def _new_rows(target):
    fresh = (F.col("axis") % 3 == 0) & (F.col("measure") < 2000)
    return target.filter(fresh).withColumn("area", F.col("area") * 2)


@query("replace_by_key", REPLACED)
def _(spark, sf):
    target = fixture.landcover(spark, sf)
    return tables.replace_by_key(target, _new_rows(target), "axis").table


@query(
    "replace_counts",
    ctes(*fx("landcover"), ("new_rows", NEW_ROWS))
    + """SELECT (SELECT COUNT(*) FROM fx_landcover WHERE axis IN (SELECT axis FROM new_rows)) AS deleted,
  (SELECT COUNT(*) FROM new_rows) AS inserted""",
)
def _(spark, sf):
    target = fixture.landcover(spark, sf)
    replaced = tables.replace_by_key(target, _new_rows(target), "axis")
    counts = replaced.deleted.select(F.col("n").alias("deleted"), F.lit(0).cast("long").alias("inserted"))
    both = counts.unionByName(
        replaced.inserted.select(F.lit(0).cast("long").alias("deleted"), F.col("n").alias("inserted"))
    )
    return both.agg(F.sum("deleted").alias("deleted"), F.sum("inserted").alias("inserted"))


@query("stored_table_replace", REPLACED)
def _(spark, sf):
    path = new_folder(spark, "landcover")
    target = fixture.landcover(spark, sf)
    tables.create_table(target, path, "axis")
    tables.upsert_table(_new_rows(target), path, "axis")
    return tables.read_table(spark, path)


# --- network replacement ------------------------------------------------------------------------

NETWORK_ROWS = (
    ("new_swaths", "SELECT * REPLACE (gid + 7 AS gid) FROM fx_swaths WHERE axis % 2 = 0 AND measure_medial_axis < 4000"),
    ("axes", "SELECT DISTINCT axis, axis % 10 AS gid_region FROM fx_swaths"),
    ("new_axes", "SELECT DISTINCT axis, 99 AS gid_region FROM new_swaths"),
    (
        "swaths_after",
        """SELECT * FROM fx_swaths WHERE axis NOT IN (SELECT axis FROM new_axes)
  UNION ALL SELECT * FROM new_swaths""",
    ),
    (
        "metric",
        """SELECT axis, measure AS measure_medial_axis, elevation_talweg FROM fx_talweg""",
    ),
)


def _replaced_network(spark, sf):
    swaths = fixture.swaths(spark, sf)
    keep = (F.col("axis") % 2 == 0) & (F.col("measure_medial_axis") < 4000)
    new_swaths = swaths.filter(keep).withColumn("gid", F.col("gid") + 7)
    axes = swaths.select("axis", (F.col("axis") % 10).alias("gid_region")).distinct()
    new_axes = new_swaths.select("axis", F.lit(99).cast("long").alias("gid_region")).distinct()
    customers = fixture.table(spark, sf, "customer")
    held = {
        "hydro_axis": axes,
        "hydro_swaths": swaths,
        "roe": customers.select(
            F.col("c_name").alias("cdobstecou"), F.floor(F.col("c_custkey") / 15.0).alias("axis")
        ),
        "talweg_metrics": fixture.talweg(spark, sf)
        .withColumnsRenamed(POSITION)
        .select("axis", "measure_medial_axis", "elevation_talweg"),
    }
    return tables.replace_network(new_axes, new_swaths, held)


@query(
    "replace_network_axes",
    ctes(*fx("swaths"), *NETWORK_ROWS[:3])
    + """SELECT * FROM axes WHERE axis NOT IN (SELECT axis FROM new_axes)
UNION ALL SELECT * FROM new_axes""",
)
def _(spark, sf):
    return _replaced_network(spark, sf).axes


@query(
    "replace_network_swaths",
    ctes(*fx("swaths"), *NETWORK_ROWS[:4]) + "SELECT * FROM swaths_after",
)
def _(spark, sf):
    return _replaced_network(spark, sf).swaths


@query(
    "replace_network_obstacles",
    ctes(*fx("swaths"), *NETWORK_ROWS[:3])
    + """SELECT c_name AS cdobstecou, CAST(FLOOR(c_custkey / 15e0) AS BIGINT) AS axis FROM customer
WHERE CAST(FLOOR(c_custkey / 15e0) AS BIGINT) NOT IN (SELECT axis FROM new_axes)""",
)
def _(spark, sf):
    return _replaced_network(spark, sf).obstacles


@query(
    "replace_network_links",
    ctes(*fx("swaths", "talweg"), *NETWORK_ROWS)
    + """SELECT m.*, s.gid AS hydro_swaths_gid FROM metric m LEFT JOIN swaths_after s
ON s.axis = m.axis AND s.measure_medial_axis = m.measure_medial_axis""",
)
def _(spark, sf):
    return _replaced_network(spark, sf).metrics["talweg_metrics"]


@query(
    "replace_network_report",
    ctes(*fx("swaths"), *NETWORK_ROWS[:3])
    + """SELECT axis, COUNT(*) AS n FROM fx_swaths WHERE axis IN (SELECT axis FROM new_axes) GROUP BY axis""",
)
def _(spark, sf):
    return _replaced_network(spark, sf).deleted_per_axis


# --- serving tables -------------------------------------------------------------------------------


def _served(spark, sf, name: str):
    """One of the serving tables after all have been rebuilt."""
    # loaded tables are stored ones
    swaths = saved(fixture.swaths(spark, sf), "swaths")
    continuity = saved(fixture.continuity(spark, sf), "continuity")
    held = {
        "hydro_swaths": swaths,
        "hydro_axis": axis_summary(swaths, fixture.reaches(spark, sf)).withColumn(
            "gid", F.col("axis") * 10
        ),
        "talweg_metrics": fixture.talweg(spark, sf).withColumnsRenamed(POSITION),
        "landcover_area": prepare.prepare_landcover_area(fixture.landcover(spark, sf)).table,
        "continuity_area": prepare.prepare_continuity_area(continuity).table,
        "continuity_width": prepare.prepare_continuity_width(continuity).table,
        "valley_bottom": prepare.prepare_valley_bottom(fixture.valley_bottom(spark, sf)).table,
    }
    paths = marts.build_marts(spark, held, new_folder(spark, "marts"))
    return spark.read.parquet(paths[name])


@query("refresh_serving_tables", NETWORK_METRICS)
def _(spark, sf):
    return _served(spark, sf, "network_metrics")


# the other serving tables have the rows of the views they come from
for _name, _view in {
    "landcover_area_full_side": "landcover_full_side",
    "continuity_area_full_side": "continuity_full_side",
    "continuity_width_full_side": "continuity_width_full_side",
    "valley_bottom_full_side": "valley_bottom_full_side",
    "network_axis": "network_axis",
}.items():
    query(f"refresh_{_name}", ORACLES[_view])(lambda spark, sf, name=_name: _served(spark, sf, name))


# --- streaming ------------------------------------------------------------------------------------


@query(
    "stream_landcover",
    ctes(*fx("landcover", "swaths"), ("wide", LANDCOVER_WIDE)) + linked("wide"),
)
def _(spark, sf):
    raw = fixture.landcover(spark, sf)
    swaths = fixture.swaths(spark, sf)
    # every axis is spread over many files, and so over the micro-batches
    source = new_folder(spark, "arriving")
    raw.repartition(16, "axis", "measure").write.parquet(source)
    # the stored table starts empty
    path = new_folder(spark, "landcover")
    none = prepare.prepare_landcover_area(raw.limit(0)).table
    none = none.withColumn("hydro_swaths_gid", F.lit(None).cast("long"))
    tables.create_table(none, path, "axis")
    stream = spark.readStream.schema(raw.schema).option("maxFilesPerTrigger", 8).parquet(source)
    stream_metrics(
        stream,
        swaths,
        path,
        new_folder(spark, "progress"),
        prepare=lambda rows: prepare.prepare_landcover_area(rows).table,
        schema=none.schema,
    ).awaitTermination()
    return tables.read_table(spark, path, none.schema)


def _store(spark, *names):
    store = load.Store(spark, new_folder(spark, "store"), 16)
    load.create_tables(store, list(names))
    return store


@query(
    "load_landcover",
    ctes(*fx("landcover", "swaths"), ("wide", LANDCOVER_WIDE)) + linked("wide"),
)
def _(spark, sf):
    store = _store(spark, "hydro_swaths", "landcover_area")
    raw, swaths = fixture.landcover(spark, sf), fixture.swaths(spark, sf)
    load.replace_rows(store, "hydro_swaths", swaths.select("gid", "axis", "measure_medial_axis"))
    for delivery in (_new_rows(raw), raw):
        load.load_metrics(store, "landcover_area", prepare.prepare_landcover_area(delivery).table)
    return store.read("landcover_area")


PLACED_SITES = ctes(
    *fx("sites", "region_rings"),
    ("d", DISTINCT_SITES),
    ("e", REGION_EDGES),
    (
        "placed",
        f"""SELECT p.code_site, e.gid_region FROM d p JOIN e ON {INSIDE}
  GROUP BY p.code_site, e.gid_region HAVING COUNT(*) % 2 = 1""",
    ),
)

# --- layers -----------------------------------------------------------------------------------------


def _degree_layer(spark, sf, names: dict[str, str]):
    """Swath polygons moved into the working area and written in degrees."""
    metres = fixture.swath_polygons(spark, sf).withColumn(
        "geom",
        F.transform(
            "geom",
            lambda r: F.transform(r, lambda v: xy(v["x"] + 650000, v["y"] + 6550000)),
        ),
    )
    return reproject(metres, ["geom"], 2154, 4326).withColumnsRenamed(names)


def _corners(df):
    key = [c for c in df.columns if c != "geom"]
    flat = df.select(*key, F.explode(F.flatten("geom")).alias("v"))
    return flat.select(*key, F.round("v.x", 3).alias("x"), F.round("v.y", 3).alias("y"))


LAYER_CORNERS = "ROUND(x + 650000, 3) AS x, ROUND(y + 6550000, 3) AS y FROM fx_swath_rings"


@query(
    "prepare_regions",
    ctes(*fx("swath_rings")) + "SELECT axis AS gid, measure AS cd_region_hy, " + LAYER_CORNERS,
)
def _(spark, sf):
    names = {"axis": "GID", "m": "Cd.Region-Hy"}
    layer = _degree_layer(spark, sf, names).drop("value", "drainage")
    return _corners(prepare.prepare_regions(layer, srid=4326))


@query(
    "prepare_basins",
    ctes(*fx("swath_rings"))
    + "SELECT measure AS cdbh, CAST(axis + measure AS DOUBLE) AS lb_bh, " + LAYER_CORNERS,
)
def _(spark, sf):
    names = {"axis": "gid", "m": "CdBH", "drainage": "Lb BH"}
    layer = _degree_layer(spark, sf, names).drop("value")
    return _corners(prepare.prepare_basins(layer, srid=4326))


# --- sites, network and obstacles end to end ----------------------------------------------------------


@query(
    "prepare_sites",
    PLACED_SITES
    + """SELECT d.code_site, CONCAT('https://www.hydro.eaufrance.fr/sitehydro/', d.code_site, '/fiche') AS url_site,
  d.libelle_site, d.statut_site, p.gid_region, d.x, d.y FROM d JOIN placed p ON p.code_site = d.code_site""",
)
def _(spark, sf):
    sites = readers.distinct_sites(fixture.sites(spark, sf))
    return prepare.prepare_sites(sites, region_edges(spark, sf), srid=2154)


@query(
    "load_sites",
    PLACED_SITES
    + """SELECT d.code_site, d.libelle_site, d.statut_site, p.gid_region, ROUND(d.x, 2) AS x, ROUND(d.y, 2) AS y
FROM d JOIN placed p ON p.code_site = d.code_site""",
)
def _(spark, sf):
    store = _store(spark, "hydro_sites")
    sites = prepare.prepare_sites(
        readers.distinct_sites(fixture.sites(spark, sf)), region_edges(spark, sf), srid=2154
    )
    # an earlier delivery of some of them, with other names
    load.load_sites(store, sites.filter(F.col("code_site") < "S2").withColumn("libelle_site", F.lit("old")))
    load.load_sites(store, sites)
    metric = reproject(store.read("hydro_sites"), ["x", "y"], 4326, 2154)
    return metric.select(
        "code_site", "libelle_site", "statut_site", "gid_region",
        F.round("x", 2).alias("x"), F.round("y", 2).alias("y"),
    )


@query(
    "load_regions_and_display",
    """SELECT CAST(n_nationkey AS INT) AS gid, CONCAT('NATION_', CAST(n_nationkey AS VARCHAR)) AS cdregionhy,
  n_nationkey IN (3, 7) AS display, 7 AS vertices FROM nation""",
)
def _(spark, sf):
    store = _store(spark, "region_hydrographique")
    rings = fixture.region_rings(spark, sf).withColumn("ring", F.lit(0))
    regions = readers.fold_vertices(
        rings.select("gid", "ring", "seq", (F.col("x") + 650000).alias("x"), (F.col("y") + 6550000).alias("y")),
        ["gid"],
        "polygon",
    ).withColumn("cdregionhy", F.concat(F.lit("NATION_"), F.col("gid").cast("string")))
    load.load_regions(store, regions.filter("gid < 9"))
    load.display(store, "region_hydrographique", ["NATION_1"])
    load.load_regions(store, regions)
    load.display(store, "region_hydrographique", ["NATION_3", "NATION_7", "NATION_99"])
    return store.read("region_hydrographique").select(
        "gid", "cdregionhy", "display", F.size(F.col("geom")[0]).alias("vertices")
    )


PREPARED_SWATHS = (
    *SPLIT,
    *fx("region_rings"),
    ("strahler_rows", PIECE_STRAHLER),
    ("region_edges", REGION_EDGES),
    # stretches as lines: a piece is within a region if all its stretches are
    ("lines_", "SELECT axis * 1000 + piece AS piece_id, axis * 1000000 + ROW_NUMBER() OVER (PARTITION BY axis ORDER BY p0) AS line_id, xa AS x1, ya AS y1, xb AS x2, yb AS y2 FROM stretch_rows"),
    ("probes", PROBES.format(lines="lines_")),
    ("within", LINE_REGIONS.format(lines="lines_", inside=INSIDE, on_edge=ON_EDGE)),
    (
        "piece_regions",
        """SELECT n.piece_id, r.gid_region FROM (SELECT piece_id, COUNT(*) AS n FROM lines_ GROUP BY piece_id) n
  JOIN (SELECT l.piece_id, w.gid_region, COUNT(*) AS n FROM lines_ l JOIN within w ON w.line_id = l.line_id
    GROUP BY l.piece_id, w.gid_region) r ON r.piece_id = n.piece_id AND r.n = n.n""",
    ),
    (
        "swath_rows",
        """SELECT p.axis, l.measure AS measure_medial_axis,
    COALESCE(SUM(p.leng) OVER (PARTITION BY p.axis ORDER BY p.piece DESC
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS measure_from_outlet,
    CAST(p.axis + l.measure AS DOUBLE) AS drainage, p.leng AS length, CAST(s.strahler AS INT) AS strahler,
    r.gid_region
  FROM pieces p LEFT JOIN labels l ON l.axis = p.axis AND l.piece = p.piece
  JOIN strahler_rows s ON s.axis = p.axis AND s.piece = p.piece
  LEFT JOIN piece_regions r ON r.piece_id = p.axis * 1000 + p.piece""",
    ),
)


def _network_tables(spark, sf):
    return prepare.prepare_swaths_and_axis(
        fixture.swath_polygons(spark, sf), fixture.reaches(spark, sf), region_edges(spark, sf)
    )


@query(
    "prepare_swaths",
    ctes(*PREPARED_SWATHS)
    + """SELECT axis, measure_medial_axis, ROUND(measure_from_outlet, 2) AS measure_from_outlet, drainage,
  ROUND(length, 3) AS length, strahler, gid_region FROM swath_rows""",
)
def _(spark, sf):
    return _network_tables(spark, sf).hydro_swaths.select(
        "axis",
        "measure_medial_axis",
        F.round("measure_from_outlet", 2).alias("measure_from_outlet"),
        "drainage",
        F.round("length", 3).alias("length"),
        "strahler",
        "gid_region",
    )


@query(
    "load_network",
    ctes(*PREPARED_SWATHS)
    + """SELECT axis, measure_medial_axis, ROUND(measure_from_outlet, 2) AS measure_from_outlet,
  ROUND(length, 3) AS length, strahler, gid_region FROM swath_rows
UNION ALL SELECT -1, 200, 5, 7, 1, NULL""",
)
def _(spark, sf):
    store = _store(spark, *TABLES)
    network = _network_tables(spark, sf)
    # rows of an axis that is not delivered, and of one that is
    old = spark.createDataFrame(
        [(1, -1, 200, 5.0, 7.0, 1), (2, 0, 123456, 5.0, 7.0, 1)],
        "gid long, axis long, measure_medial_axis long, measure_from_outlet double, length double, strahler int",
    )
    load.replace_rows(store, "hydro_swaths", old)
    load.load_network(store, network)
    return store.read("hydro_swaths").select(
        "axis",
        "measure_medial_axis",
        F.round("measure_from_outlet", 2).alias("measure_from_outlet"),
        F.round("length", 3).alias("length"),
        "strahler",
        "gid_region",
    )


@query(
    "prepare_axis",
    ctes(
        *PREPARED_SWATHS,
        ("reaches", REACH_ROWS),
        ("fx_swaths", "SELECT axis, length, gid_region FROM swath_rows"),
        ("a", AXIS_SUMMARY),
    )
    + "SELECT axis, toponyme, ROUND(length, 3) AS length, gid_region FROM a",
)
def _(spark, sf):
    return _network_tables(spark, sf).hydro_axis.select(
        "axis", "toponyme", F.round("length", 3).alias("length"), "gid_region"
    )


@query(
    "prepare_axis_lines",
    ctes(
        *fx("reach_vertices", "swath_rings"),
        ("segs", SEGMENTS),
        ("swath_edges", SWATH_EDGES),
        ("cuts", CUTS),
        ("vertices", VERTICES),
    )
    + """SELECT axis, CAST(1 AS BIGINT) AS n_lines, COUNT(*) AS n_vertices, ROUND(SUM(x), 2) AS x, ROUND(SUM(y), 2) AS y,
  MIN(x) AS first_x, MAX(x) AS last_x FROM vertices GROUP BY axis""",
)
def _(spark, sf):
    network = _network_tables(spark, sf)
    served = marts.network_axis(network.hydro_axis, network.lines).filter("geom IS NOT NULL")
    line = F.col("geom")[0]

    def total(c: str):
        return F.aggregate(line, F.lit(0.0), lambda acc, v: acc + v[c])

    return served.select(
        "axis", F.size("geom").cast("long").alias("n_lines"), F.size(line).cast("long").alias("n_vertices"),
        F.round(total("x"), 2).alias("x"), F.round(total("y"), 2).alias("y"),
        # lines run downstream
        F.round(line[0]["x"], 3).alias("first_x"), F.round(F.element_at(line, -1)["x"], 3).alias("last_x"),
    )


OBSTACLES = """SELECT c_custkey AS pid, CONCAT('ROE', CAST(c_custkey AS VARCHAR)) AS cdobstecou,
  CAST(FLOOR(c_custkey / 15e0) AS BIGINT) AS axis,
  (c_custkey * 7919) % 100000 + 5e-1 AS x, (c_custkey * 104729) % 100000 + 5e-1 AS y
  FROM customer WHERE c_custkey % 7 <> 0"""


@query(
    "prepare_obstacles",
    ctes(
        *fx("reach_vertices", "swath_rings", "region_rings"),
        ("segs", SEGMENTS),
        ("swath_edges", SWATH_EDGES),
        ("cuts", CUTS),
        ("vertices", VERTICES),
        ("low", LOW),
        ("e", REGION_EDGES),
        ("obstacles", OBSTACLES),
        (
            "placed",
            f"""SELECT p.pid, p.cdobstecou, p.axis, p.x AS px, p.y AS py, e.gid_region FROM obstacles p JOIN e ON {INSIDE}
  GROUP BY p.pid, p.cdobstecou, p.axis, p.x, p.y, e.gid_region HAVING COUNT(*) % 2 = 1""",
        ),
        ("near", FEET.format(points="placed", condition="TRUE")),
        ("corners", CORNERS.format(points="placed")),
        (
            "snapped",
            """SELECT t.pid, COALESCE(c.x, fx) AS px, COALESCE(c.y, fy) AS py FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY pid ORDER BY d, axis, seg) AS k FROM near) t
  LEFT JOIN corners c ON c.pid = t.pid WHERE t.k = 1 AND t.d <= 100""",
        ),
        ("on_line", "SELECT s.pid, p.axis, s.px, s.py FROM snapped s JOIN placed p ON p.pid = s.pid"),
        ("feet", FEET.format(points="on_line", condition="s.axis = p.axis")),
        (
            "located",
            """SELECT pid, low + (1 - f) * leng AS distance_axis FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY pid ORDER BY d, seg) AS k FROM feet) t WHERE k = 1""",
        ),
    )
    + """SELECT p.cdobstecou, p.gid_region, p.axis, ROUND(l.distance_axis, 2) AS distance_axis,
  ROUND(s.px, 3) AS x, ROUND(s.py, 3) AS y
FROM placed p JOIN snapped s ON s.pid = p.pid JOIN located l ON l.pid = p.pid""",
)
def _(spark, sf):
    key = F.col("c_custkey")
    raw = fixture.table(spark, sf, "customer").select(
        F.concat(F.lit("ROE"), key.cast("string")).alias("CdObstEcou"),
        F.concat(F.lit("T"), key.cast("string")).alias("IdTronco_1"),
        ((key * 7919) % 100000 + 0.5).alias("x"),
        ((key * 104729) % 100000 + 0.5).alias("y"),
    )
    reach_ids = fixture.table(spark, sf, "customer").select(
        F.concat(F.lit("T"), key.cast("string")).alias("id_troncon"),
        F.when(key % 7 != 0, F.floor(key / 15.0)).alias("axis"),
    )
    network = _network_tables(spark, sf)
    prepared = prepare.prepare_obstacles(
        raw, region_edges(spark, sf), reach_ids, network.hydro_axis, network.lines
    )
    return prepared.select(
        "cdobstecou",
        "gid_region",
        "axis",
        F.round("distance_axis", 2).alias("distance_axis"),
        F.round("x", 3).alias("x"),
        F.round("y", 3).alias("y"),
    )
