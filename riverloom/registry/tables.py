"""Queries on metric tables: columns, joins, aggregates, quality."""

from __future__ import annotations

from pyspark.sql import functions as F

from riverloom import fixtures as fixture
from riverloom.functions import columns as c
from riverloom.operators import joins, link, lines, profiles, quality
from riverloom.operators.pivot import pivot_area, pivot_width
from riverloom.plans import marts, prepare
from riverloom.registry import query
from riverloom.registry.sql import (
    AXIS_SUMMARY,
    CONTINUITY_WIDE,
    LANDCOVER_WIDE,
    NETWORK_METRICS,
    REACH_ROWS,
    VALLEY_ROWS,
    WIDTH_WIDE,
    ctes,
    full_side,
    fx,
    linked,
    pct,
    pivot,
)
from riverloom.schemas import CONTINUITY_LABELS, LANDCOVER_LABELS, struct
from riverloom.sources.readers import distinct_sites

POSITION = {"measure": "measure_medial_axis"}


# --- columns -------------------------------------------------------------------------


@query(
    "clean_column_names",
    ctes(*fx("valley_bottom"))
    + """SELECT axis, measure AS m_medial_axis, side AS side_of_bank, area AS area_m2, width1, width2, swath
FROM fx_valley_bottom""",
)
def _(spark, sf):
    raw = fixture.valley_bottom(spark, sf).select(
        F.col("axis").alias("AXIS"),
        F.col("measure").alias("M.medial-axis"),
        F.col("side").alias("Side of bank"),
        F.col("area").alias("Area-M2"),
        "width1",
        "width2",
        F.col("swath").alias("SWATH"),
    )
    return c.clean_columns(raw)


@query(
    "rename_and_drop",
    ctes(*fx("valley_bottom")) + VALLEY_ROWS,
)
def _(spark, sf):
    return (
        fixture.valley_bottom(spark, sf)
        .drop("width2", "swath")
        .withColumnsRenamed({**POSITION, "width1": "width"})
    )


@query(
    "row_filters",
    ctes(*fx("profiles"))
    + """SELECT sample, side, density, mean FROM fx_profiles
WHERE quantile = 50 AND side = 'left' AND density > 0 AND mean IS NOT NULL""",
)
def _(spark, sf):
    return (
        fixture.profiles(spark, sf)
        .filter(
            (F.col("quantile") == 50)
            & (F.col("side") == "left")
            & (F.col("density") > 0)
            & F.col("mean").isNotNull()
        )
        .select("sample", "side", "density", "mean")
    )


@query(
    "area_in_hectares",
    ctes(*fx("landcover"))
    + "SELECT axis, measure, side, label, area / 10000 AS area_ha FROM fx_landcover",
)
def _(spark, sf):
    return fixture.landcover(spark, sf).select(
        "axis", "measure", "side", "label", c.hectares(F.col("area")).alias("area_ha")
    )


@query(
    "guarded_percentage",
    ctes(*fx("profiles"))
    + f"SELECT sample, side, quantile, {pct('mean', 'density')} AS pc FROM fx_profiles",
)
def _(spark, sf):
    return fixture.profiles(spark, sf).select(
        "sample", "side", "quantile", c.guarded_pct(F.col("mean"), F.col("density")).alias("pc")
    )


@query(
    "distance_sign",
    ctes(*fx("profiles"))
    + """SELECT sample, side, quantile, CASE WHEN distance <> 0 THEN -distance ELSE distance END AS distance
FROM fx_profiles""",
)
def _(spark, sf):
    return fixture.profiles(spark, sf).select(
        "sample", "side", "quantile", c.flip_sign(F.col("distance")).alias("distance")
    )


@query(
    "site_page_url",
    ctes(*fx("sites"))
    + """SELECT libelle_site, CONCAT('https://www.hydro.eaufrance.fr/sitehydro/', code_site, '/fiche') AS url_site
FROM fx_sites WHERE code_site IS NOT NULL""",
)
def _(spark, sf):
    return (
        fixture.sites(spark, sf)
        .filter(F.col("code_site").isNotNull())
        .select("libelle_site", c.site_url(F.col("code_site")).alias("url_site"))
    )


AXIS_IDS = """SELECT id_troncon, TRY_CAST(REGEXP_REPLACE(REGEXP_REPLACE(
  SPLIT_PART(link, '/', 1), '[^0-9]', '', 'g'), '0*$', '') AS BIGINT) AS axis
FROM fx_links WHERE link IS NOT NULL AND link <> ''"""


@query("axis_ids_from_links", ctes(*fx("links")) + AXIS_IDS)
def _(spark, sf):
    return c.reach_axis_ids(fixture.links(spark, sf))


@query(
    "displayed_regions",
    """SELECT n_nationkey AS gid, n_name AS cdregionhy,
CASE WHEN n_name IN ('NATION_3', 'NATION_7', 'NATION_99') THEN TRUE ELSE FALSE END AS display FROM nation""",
)
def _(spark, sf):
    regions = fixture.table(spark, sf, "nation").select(
        F.col("n_nationkey").alias("gid"),
        F.col("n_name").alias("cdregionhy"),
        (F.col("n_regionkey") == 1).alias("display"),
    )
    return c.set_displayed(regions, "cdregionhy", ["NATION_3", "NATION_7", "NATION_99"])


@query(
    "corridor_widths",
    ctes(*fx("continuity"), ("wide", WIDTH_WIDE))
    + """SELECT side, axis, measure_medial_axis,
  CASE WHEN sum_width <> 0 THEN (water_channel + active_channel) / sum_width END AS idx_confinement,
  water_channel + active_channel AS active_channel_width,
  riparian_buffer + connected_meadows + connected_cultivated AS connected_corridor_width,
  sum_width AS valley_bottom_width FROM wide""",
)
def _(spark, sf):
    wide = pivot_width(fixture.continuity(spark, sf), CONTINUITY_LABELS)
    water, active = F.col("water_channel"), F.col("active_channel")
    return wide.select(
        "side",
        "axis",
        F.col("measure").alias("measure_medial_axis"),
        c.confinement(water, active, F.col("sum_width")).alias("idx_confinement"),
        (water + active).alias("active_channel_width"),
        (
            F.col("riparian_buffer") + F.col("connected_meadows") + F.col("connected_cultivated")
        ).alias("connected_corridor_width"),
        F.col("sum_width").alias("valley_bottom_width"),
    )


@query(
    "null_measure_of_short_rows",
    ctes(*fx("duplicates"))
    + """SELECT axis, CASE WHEN leng < 20000 THEN NULL ELSE measure END AS measure, leng FROM fx_duplicates""",
)
def _(spark, sf):
    df = fixture.duplicates(spark, sf)
    return df.withColumn("measure", c.null_where(F.col("measure"), F.col("leng") < 20000))


# --- duplicates and constraints ---------------------------------------------------------

REPEATED = """SELECT axis, measure, COUNT(*) AS n FROM fx_duplicates
  WHERE axis IS NOT NULL AND measure IS NOT NULL GROUP BY axis, measure HAVING COUNT(*) > 1"""


@query(
    "find_duplicates",
    ctes(*fx("duplicates"), ("d", REPEATED))
    + "SELECT f.* FROM fx_duplicates f JOIN d ON d.axis = f.axis AND d.measure = f.measure",
)
def _(spark, sf):
    return quality.find_duplicates(fixture.duplicates(spark, sf)).rows


@query(
    "duplicate_summary",
    ctes(*fx("duplicates"), ("d", REPEATED))
    + "SELECT axis, CAST(SUM(n - 1) AS BIGINT) AS num_duplicate FROM d GROUP BY axis",
)
def _(spark, sf):
    return quality.find_duplicates(fixture.duplicates(spark, sf)).summary


@query(
    "drop_duplicate_keys",
    ctes(*fx("duplicates"), ("d", REPEATED))
    + """SELECT f.* FROM fx_duplicates f LEFT JOIN d ON d.axis = f.axis AND d.measure = f.measure
WHERE d.n IS NULL""",
)
def _(spark, sf):
    df = fixture.duplicates(spark, sf)
    return quality.drop_duplicate_keys(df, quality.find_duplicates(df).rows)


@query(
    "keep_longest",
    ctes(*fx("duplicates"))
    + """SELECT axis, CASE WHEN measure IS NOT NULL AND leng < MAX(leng) OVER (PARTITION BY axis, measure)
  THEN NULL ELSE measure END AS measure, leng FROM fx_duplicates""",
)
def _(spark, sf):
    return lines.keep_longest(fixture.duplicates(spark, sf), measure="measure")


SIDE_ROWS = """SELECT CASE WHEN l_linestatus = 'F' THEN 'left' ELSE 'right' END AS side,
  CAST(l_suppkey AS BIGINT) AS axis, CAST(l_partkey AS BIGINT) AS measure_medial_axis,
  l_extendedprice AS area FROM lineitem"""


def _side_rows(spark, sf):
    return fixture.table(spark, sf, "lineitem").select(
        F.when(F.col("l_linestatus") == "F", "left").otherwise("right").alias("side"),
        F.col("l_suppkey").cast("long").alias("axis"),
        F.col("l_partkey").cast("long").alias("measure_medial_axis"),
        F.col("l_extendedprice").alias("area"),
    )


@query(
    "duplicates_per_side",
    ctes(("r", SIDE_ROWS))
    + """SELECT side, axis, measure_medial_axis, area FROM (
  SELECT *, COUNT(*) OVER (PARTITION BY side, axis, measure_medial_axis) AS n FROM r) t WHERE n > 1""",
)
def _(spark, sf):
    return quality.check_sides(_side_rows(spark, sf)).duplicates


@query(
    "drop_duplicates_of_sides",
    ctes(("r", SIDE_ROWS))
    + """SELECT side, axis, measure_medial_axis, area FROM r WHERE (axis, measure_medial_axis) NOT IN (
  SELECT (axis, measure_medial_axis) FROM r GROUP BY side, axis, measure_medial_axis HAVING COUNT(*) > 1)""",
)
def _(spark, sf):
    return quality.check_sides(_side_rows(spark, sf), drop=True).table


@query(
    "unique_violations",
    ctes(*fx("duplicates")) + REPEATED,
)
def _(spark, sf):
    return quality.unique_violations(fixture.duplicates(spark, sf), ["axis", "measure"])


@query(
    "foreign_key_violations",
    ctes(*fx("valley_bottom", "swaths"))
    + """SELECT axis, measure, side, swath_gid FROM (
  SELECT axis, measure, side, CASE WHEN measure % 600 = 0 THEN NULL ELSE axis * 100000 + measure END AS swath_gid
  FROM fx_valley_bottom) v WHERE swath_gid IS NOT NULL AND swath_gid NOT IN (SELECT gid FROM fx_swaths)""",
)
def _(spark, sf):
    gid = F.when(F.col("measure") % 600 != 0, F.col("axis") * 100000 + F.col("measure"))
    child = fixture.valley_bottom(spark, sf).select("axis", "measure", "side", gid.alias("swath_gid"))
    return quality.fk_violations(child, fixture.swaths(spark, sf), "swath_gid", "gid")


@query(
    "conform_to_schema",
    """SELECT CAST(n_nationkey AS INT) AS gid, n_name AS cdregionhy, CAST(NULL AS VARCHAR) AS lbregionhy,
CAST(n_regionkey AS VARCHAR) AS cdbh, FALSE AS display FROM nation""",
)
def _(spark, sf):
    schema = struct("gid int, cdregionhy string, lbregionhy string, cdbh string, display boolean")
    nation = fixture.table(spark, sf, "nation").select(
        F.col("n_name").alias("cdregionhy"),
        F.col("n_regionkey").alias("cdbh"),
        F.col("n_nationkey").cast("double").alias("gid"),
    )
    return quality.conform(nation, schema)


# --- pivots and sums over banks -----------------------------------------------------------


@query(
    "pivot_landcover_area",
    ctes(*fx("landcover"))
    + pivot("fx_landcover", "area / 10000", LANDCOVER_LABELS, "sum_area"),
)
def _(spark, sf):
    return pivot_area(fixture.landcover(spark, sf), LANDCOVER_LABELS)


@query(
    "pivot_continuity_width",
    ctes(*fx("continuity")) + pivot("fx_continuity", "width1", CONTINUITY_LABELS, "sum_width"),
)
def _(spark, sf):
    return pivot_width(fixture.continuity(spark, sf), CONTINUITY_LABELS)


@query("prepare_landcover_area", ctes(*fx("landcover")) + LANDCOVER_WIDE)
def _(spark, sf):
    return prepare.prepare_landcover_area(fixture.landcover(spark, sf)).table


@query("prepare_continuity_area", ctes(*fx("continuity")) + CONTINUITY_WIDE)
def _(spark, sf):
    return prepare.prepare_continuity_area(fixture.continuity(spark, sf)).table


@query("prepare_continuity_width", ctes(*fx("continuity")) + WIDTH_WIDE)
def _(spark, sf):
    return prepare.prepare_continuity_width(fixture.continuity(spark, sf)).table


@query("prepare_valley_bottom", ctes(*fx("valley_bottom")) + VALLEY_ROWS)
def _(spark, sf):
    return prepare.prepare_valley_bottom(fixture.valley_bottom(spark, sf)).table


@query(
    "prepare_talweg_metrics",
    ctes(*fx("duplicates"), ("d", REPEATED))
    + """SELECT f.axis, f.measure AS measure_medial_axis, f.leng AS elevation_talweg FROM fx_duplicates f
LEFT JOIN d ON d.axis = f.axis AND d.measure = f.measure WHERE d.n IS NULL""",
)
def _(spark, sf):
    raw = fixture.duplicates(spark, sf).select(
        F.lit(0).alias("swath"), F.col("leng").alias("elevation_talweg"), "axis", "measure"
    )
    return prepare.prepare_talweg_metrics(raw)


PROFILES = """SELECT sample, quantile, CAST(density AS INT) AS density, mean, profile, axis, measure AS measure_medial_axis,
  CASE WHEN distance <> 0 THEN -distance ELSE distance END AS distance FROM (
  SELECT sample, SUM(density) AS density,
    CASE WHEN COUNT(*) = COUNT(mean) THEN SUM(mean) END AS mean,
    MIN(quantile) AS quantile, MIN(profile) AS profile, MIN(axis) AS axis, MIN(measure) AS measure,
    MIN(distance) AS distance
  FROM fx_profiles WHERE quantile = 50 GROUP BY sample) t WHERE density > 0"""


@query("prepare_elevation_profiles", ctes(*fx("profiles")) + PROFILES)
def _(spark, sf):
    return prepare.prepare_elevation_profiles(fixture.profiles(spark, sf))


@query(
    "landcover_full_side",
    ctes(
        *fx("landcover", "swaths"),
        ("wide", LANDCOVER_WIDE),
        ("linked", linked("wide")),
    )
    + full_side("linked", LANDCOVER_LABELS, "sum_area"),
)
def _(spark, sf):
    wide = prepare.prepare_landcover_area(fixture.landcover(spark, sf)).table
    return marts.full_side_area(
        link.link_swaths(wide, fixture.swaths(spark, sf)), LANDCOVER_LABELS
    )


@query(
    "continuity_full_side",
    ctes(
        *fx("continuity", "swaths"),
        ("wide", CONTINUITY_WIDE),
        ("linked", linked("wide")),
    )
    + full_side("linked", CONTINUITY_LABELS, "sum_area"),
)
def _(spark, sf):
    wide = prepare.prepare_continuity_area(fixture.continuity(spark, sf)).table
    return marts.full_side_area(
        link.link_swaths(wide, fixture.swaths(spark, sf)), CONTINUITY_LABELS
    )


@query(
    "continuity_width_full_side",
    ctes(*fx("continuity", "swaths"), ("wide", WIDTH_WIDE), ("linked", linked("wide")))
    + full_side("linked", CONTINUITY_LABELS, "sum_width"),
)
def _(spark, sf):
    wide = prepare.prepare_continuity_width(fixture.continuity(spark, sf)).table
    return marts.full_side_width(
        link.link_swaths(wide, fixture.swaths(spark, sf)), CONTINUITY_LABELS
    )


@query(
    "valley_bottom_full_side",
    ctes(*fx("valley_bottom", "swaths"), ("rows_", VALLEY_ROWS), ("linked", linked("rows_")))
    + """SELECT hydro_swaths_gid, axis, measure_medial_axis, SUM(area) AS area, SUM(width) AS width
FROM linked GROUP BY hydro_swaths_gid, axis, measure_medial_axis""",
)
def _(spark, sf):
    rows = prepare.prepare_valley_bottom(fixture.valley_bottom(spark, sf)).table
    return marts.full_side_valley_bottom(link.link_swaths(rows, fixture.swaths(spark, sf)))


# --- axis attributes ------------------------------------------------------------------------


@query(
    "first_toponyme_per_axis",
    ctes(("reaches", REACH_ROWS))
    + """SELECT axis, toponyme FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY axis ORDER BY fid) AS k FROM reaches) t WHERE k = 1""",
)
def _(spark, sf):
    return profiles.first_toponyme(fixture.reaches(spark, sf))


@query(
    "axis_summary",
    ctes(*fx("swaths"), ("reaches", REACH_ROWS)) + AXIS_SUMMARY,
)
def _(spark, sf):
    return profiles.axis_summary(fixture.swaths(spark, sf), fixture.reaches(spark, sf))


@query(
    "rows_per_axis",
    ctes(*fx("swaths")) + "SELECT axis, COUNT(*) AS n FROM fx_swaths GROUP BY axis",
)
def _(spark, sf):
    return profiles.rows_per_axis(fixture.swaths(spark, sf))


@query(
    "network_axis",
    ctes(*fx("swaths"), ("reaches", REACH_ROWS), ("a", AXIS_SUMMARY))
    + "SELECT axis, axis * 10 AS fid, toponyme, gid_region FROM a",
)
def _(spark, sf):
    axes = profiles.axis_summary(fixture.swaths(spark, sf), fixture.reaches(spark, sf))
    return marts.network_axis(axes.withColumn("gid", F.col("axis") * 10))


# --- joins ------------------------------------------------------------------------------------


@query(
    "known_axis_rows",
    ctes(*fx("links"), ("ids", AXIS_IDS))
    + "SELECT id_troncon, axis FROM ids WHERE axis IN (SELECT s_suppkey FROM supplier)",
)
def _(spark, sf):
    axes = fixture.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("axis"))
    ids = c.reach_axis_ids(fixture.links(spark, sf))
    return joins.keyed_join(ids, axes.distinct(), ["axis"], "left_semi")


@query(
    "reach_attributes",
    ctes(*fx("links"), ("ids", AXIS_IDS))
    + """SELECT o.o_orderkey, ids.axis FROM orders o
LEFT JOIN ids ON ids.id_troncon = CONCAT('T', CAST(o.o_orderkey AS VARCHAR)) WHERE ids.axis IS NOT NULL""",
)
def _(spark, sf):
    rows = fixture.table(spark, sf, "orders").select(
        "o_orderkey", F.concat(F.lit("T"), F.col("o_orderkey").cast("string")).alias("id_troncon")
    )
    ids = c.reach_axis_ids(fixture.links(spark, sf))
    return rows.join(ids, "id_troncon", "left").filter(F.col("axis").isNotNull()).drop("id_troncon")


@query(
    "link_to_swaths",
    ctes(
        *fx("landcover", "swaths"),
        ("m", "SELECT side, label, axis, measure AS measure_medial_axis, area FROM fx_landcover"),
    )
    + linked("m"),
)
def _(spark, sf):
    metric = fixture.landcover(spark, sf).drop("width1").withColumnsRenamed(POSITION)
    return link.link_swaths(metric, fixture.swaths(spark, sf))


@query(
    "unlink_deleted_swaths",
    ctes(
        *fx("landcover", "swaths"),
        ("m", "SELECT side, label, axis, measure AS measure_medial_axis, area FROM fx_landcover"),
        ("l", linked("m")),
    )
    + """SELECT side, label, axis, measure_medial_axis, area,
  CASE WHEN hydro_swaths_gid % 3 <> 0 THEN hydro_swaths_gid END AS hydro_swaths_gid FROM l""",
)
def _(spark, sf):
    metric = fixture.landcover(spark, sf).drop("width1").withColumnsRenamed(POSITION)
    swaths = fixture.swaths(spark, sf)
    return link.unlink_deleted(link.link_swaths(metric, swaths), swaths.filter(F.col("gid") % 3 != 0))


@query("network_metrics", NETWORK_METRICS)
def network_metrics(spark, sf):
    swaths = fixture.swaths(spark, sf)
    axes = profiles.axis_summary(swaths, fixture.reaches(spark, sf))
    continuity = fixture.continuity(spark, sf)
    talweg = fixture.talweg(spark, sf).withColumnsRenamed(POSITION)

    def linked_rows(rows):
        return link.link_swaths(rows, swaths)

    return marts.network_metrics(
        swaths,
        axes,
        linked_rows(talweg),
        marts.full_side_width(
            linked_rows(prepare.prepare_continuity_width(continuity).table), CONTINUITY_LABELS
        ),
        marts.full_side_area(
            linked_rows(prepare.prepare_landcover_area(fixture.landcover(spark, sf)).table),
            LANDCOVER_LABELS,
        ),
        marts.full_side_area(
            linked_rows(prepare.prepare_continuity_area(continuity).table), CONTINUITY_LABELS
        ),
    )


# --- sites, limits, sets -------------------------------------------------------------------------

DISTINCT_SITES = """SELECT code_site, libelle_site, statut_site, x, y FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY code_site ORDER BY libelle_site, statut_site, x, y) AS k
  FROM fx_sites WHERE statut_site = 1 AND code_site IS NOT NULL) t WHERE k = 1"""


@query("distinct_sites", ctes(*fx("sites")) + DISTINCT_SITES)
def _(spark, sf):
    return distinct_sites(fixture.sites(spark, sf))


@query(
    "first_ten_sites",
    ctes(*fx("sites"), ("d", DISTINCT_SITES)) + "SELECT * FROM d ORDER BY code_site LIMIT 10",
)
def _(spark, sf):
    return distinct_sites(fixture.sites(spark, sf)).orderBy("code_site").limit(10)


@query(
    "distinct_keys",
    ctes(*fx("landcover")) + "SELECT DISTINCT axis FROM fx_landcover",
)
def _(spark, sf):
    return fixture.landcover(spark, sf).select("axis").distinct()


@query(
    "append_records",
    """SELECT s_suppkey AS axis, s_name AS toponyme, CAST(NULL AS DOUBLE) AS length FROM supplier
UNION ALL SELECT c_custkey AS axis, CAST(NULL AS VARCHAR) AS toponyme, c_acctbal AS length FROM customer""",
)
def _(spark, sf):
    a = fixture.table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("axis"), F.col("s_name").alias("toponyme")
    )
    b = fixture.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("axis"), F.col("c_acctbal").alias("length")
    )
    return a.unionByName(b, allowMissingColumns=True)
