"""Queries on points, lines, polygons and the network."""

from __future__ import annotations

from pyspark.sql import functions as F

from riverloom import fixtures as fixture
from riverloom.functions import geometry as g
from riverloom.functions import projection
from riverloom.functions.columns import tag_srid
from riverloom.functions.simplify import simplify_lines
from riverloom.operators import containment, lines, network, rings
from riverloom.operators.joins import grown
from riverloom.registry import query
from riverloom.registry.sql import ctes, fx
from riverloom.session import saved
from riverloom.sources import readers

REGION_EDGES = """SELECT a.gid AS gid_region, a.x AS x1, a.y AS y1, b.x AS x2, b.y AS y2
  FROM fx_region_rings a JOIN fx_region_rings b ON b.gid = a.gid AND b.seq = a.seq + 1"""

# the same for points that may lie on an edge
ON_EDGE = """ABS((e.x2 - e.x1) * (p.y - e.y1) - (e.y2 - e.y1) * (p.x - e.x1))
      <= SQRT((e.x2 - e.x1) * (e.x2 - e.x1) + (e.y2 - e.y1) * (e.y2 - e.y1)) * 1e-6
    AND p.x BETWEEN LEAST(e.x1, e.x2) - 1e-6 AND GREATEST(e.x1, e.x2) + 1e-6
    AND p.y BETWEEN LEAST(e.y1, e.y2) - 1e-6 AND GREATEST(e.y1, e.y2) + 1e-6"""

INSIDE = "(e.y1 <= p.y) <> (e.y2 <= p.y) AND p.x < e.x1 + (p.y - e.y1) / (e.y2 - e.y1) * (e.x2 - e.x1)"

# segments of the axis lines, numbered downstream
SEGMENTS = """SELECT a.axis, a.seq AS seg, a.x AS x1, a.y AS y1, b.x AS x2, b.y AS y2,
  SQRT((b.x - a.x) * (b.x - a.x) + (b.y - a.y) * (b.y - a.y)) AS leng
  FROM fx_reach_vertices a JOIN fx_reach_vertices b ON b.axis = a.axis AND b.seq = a.seq + 1"""

SWATH_EDGES = """SELECT a.axis, a.measure, a.x AS x1, a.y AS y1, b.x AS x2, b.y AS y2
  FROM fx_swath_rings a JOIN fx_swath_rings b
  ON b.axis = a.axis AND b.measure = a.measure AND b.seq = a.seq + 1"""

# cut positions on segments, rounded as shares of the segment
CUTS = """SELECT DISTINCT axis, seg + ROUND(t, 9) AS p FROM (
  SELECT s.axis, s.seg,
    ((e.x1 - s.x1) * (e.y2 - e.y1) - (e.y1 - s.y1) * (e.x2 - e.x1)) / d AS t,
    ((e.x1 - s.x1) * (s.y2 - s.y1) - (e.y1 - s.y1) * (s.x2 - s.x1)) / d AS u
  FROM (SELECT s.*, e.x1 AS ex1, e.y1 AS ey1, e.x2 AS ex2, e.y2 AS ey2,
      NULLIF((s.x2 - s.x1) * (e.y2 - e.y1) - (s.y2 - s.y1) * (e.x2 - e.x1), 0) AS d
    FROM segs s JOIN swath_edges e ON e.axis = s.axis) s,
    LATERAL (SELECT s.ex1 AS x1, s.ey1 AS y1, s.ex2 AS x2, s.ey2 AS y2) e) c
  WHERE t BETWEEN 0 AND 1 AND u BETWEEN 0 AND 1"""

# vertices of the axis lines: those of the reaches, and where swath borders cut them
VERTICES = """SELECT axis, x, y FROM fx_reach_vertices
  UNION ALL SELECT c.axis, s.x1 + (c.p - s.seg) * (s.x2 - s.x1), s.y1 + (c.p - s.seg) * (s.y2 - s.y1)
  FROM cuts c JOIN segs s ON s.axis = c.axis AND s.seg = FLOOR(c.p)"""

# the nearest vertex within 100 m of each point of a table with pid, px and py
CORNERS = """SELECT * FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY pid ORDER BY d, x, y) AS k FROM (
      SELECT p.pid, v.x, v.y, SQRT((v.x - p.px) * (v.x - p.px) + (v.y - p.py) * (v.y - p.py)) AS d
      FROM {points} p JOIN vertices v ON v.x BETWEEN p.px - 100 AND p.px + 100 AND v.y BETWEEN p.py - 100 AND p.py + 100) t) t
  WHERE k = 1 AND d <= 100"""

# stretches between neighbouring vertices or cuts, numbered into pieces
STRETCHES = """SELECT axis, p AS p0, q AS p1,
    SUM(cut) OVER (PARTITION BY axis ORDER BY p) AS piece, FLOOR(p) AS seg
  FROM (SELECT axis, p, LEAD(p) OVER (PARTITION BY axis ORDER BY p) AS q, MAX(cut) AS cut
    FROM (SELECT axis, CAST(seq AS DOUBLE) AS p, 0 AS cut FROM fx_reach_vertices
      UNION ALL SELECT axis, p, 1 FROM cuts) b GROUP BY axis, p) b WHERE q IS NOT NULL"""

STRETCH_ROWS = """SELECT t.axis, t.piece, t.p0, CAST(t.seg AS BIGINT) AS seg, s.leng * (t.p1 - t.p0) AS leng,
    s.x1 + (t.p0 - t.seg) * (s.x2 - s.x1) AS xa, s.y1 + (t.p0 - t.seg) * (s.y2 - s.y1) AS ya,
    s.x1 + (t.p1 - t.seg) * (s.x2 - s.x1) AS xb, s.y1 + (t.p1 - t.seg) * (s.y2 - s.y1) AS yb
  FROM stretches t JOIN segs s ON s.axis = t.axis AND s.seg = t.seg"""

PIECES = """SELECT axis, piece, MIN(p0) AS p0, SUM(leng) AS leng, MIN_BY(xa, p0) AS xa, MIN_BY(ya, p0) AS ya,
    MIN_BY((xa + xb) / 2, p0) AS x, MIN_BY((ya + yb) / 2, p0) AS y FROM stretch_rows GROUP BY axis, piece"""

PIECE_LABELS = """SELECT p.axis, p.piece, e.measure FROM pieces p JOIN swath_edges e ON e.axis = p.axis
  AND (e.y1 <= p.y) <> (e.y2 <= p.y) AND p.x < e.x1 + (p.y - e.y1) / NULLIF(e.y2 - e.y1, 0) * (e.x2 - e.x1)
  GROUP BY p.axis, p.piece, e.measure HAVING COUNT(*) % 2 = 1"""

SPLIT = [
    *fx("reach_vertices", "swath_rings"),
    ("segs", SEGMENTS),
    ("swath_edges", SWATH_EDGES),
    ("cuts", CUTS),
    ("stretches", STRETCHES),
    ("stretch_rows", STRETCH_ROWS),
    ("pieces", PIECES),
    ("labels", PIECE_LABELS),
]


def region_edges(spark, sf):
    rings = fixture.region_rings(spark, sf).withColumnRenamed("gid", "gid_region")
    return containment.vertex_edges(rings, ["gid_region"])


def axis_lines(spark, sf):
    """Whole lines, one per axis."""
    v = fixture.reach_vertices(spark, sf)
    return v.groupBy("axis").agg(
        F.transform(
            F.sort_array(F.collect_list(F.struct("seq", "x", "y"))), lambda p: g.xy(p["x"], p["y"])
        ).alias("geom")
    )


# --- vertex arrays -----------------------------------------------------------------------


@query(
    "line_length",
    ctes(*fx("reach_vertices"), ("segs", SEGMENTS))
    + "SELECT axis, ROUND(SUM(leng), 3) AS length FROM segs GROUP BY axis",
)
def _(spark, sf):
    return axis_lines(spark, sf).select(
        "axis", F.round(g.line_length(F.col("geom")), 3).alias("length")
    )


@query(
    "line_segments",
    ctes(*fx("reach_vertices"), ("segs", SEGMENTS)) + "SELECT axis, seg, x1, y1, x2, y2 FROM segs",
)
def _(spark, sf):
    return containment.line_edges(axis_lines(spark, sf), ["axis"])


@query(
    "cut_positions",
    ctes(*SPLIT[:5]) + "SELECT axis, ROUND(p, 6) AS p FROM cuts",
)
def _(spark, sf):
    edges = containment.ring_edges(fixture.swath_polygons(spark, sf), ["axis", "m"])
    drawn = axis_lines(spark, sf).withColumn("fid", F.col("axis"))
    cuts = lines.cut_positions(drawn, edges, "fid", ["axis"], 20000.0)
    return cuts.select(F.col("fid").alias("axis"), F.explode("cuts").alias("p")).select(
        "axis", F.round("p", 6).alias("p")
    )


@query(
    "snap_to_grid",
    ctes(*fx("reach_vertices"))
    + """SELECT axis, COUNT(*) AS n, SUM(y) AS y FROM (
  SELECT axis, x, y, LAG(x) OVER w AS px, LAG(y) OVER w AS py FROM (
    SELECT axis, seq, ROUND(x / 9000) * 9000 AS x, ROUND(y / 9000) * 9000 AS y FROM fx_reach_vertices) r
  WINDOW w AS (PARTITION BY axis ORDER BY seq)) d
WHERE px IS NULL OR px <> x OR py <> y GROUP BY axis""",
)
def _(spark, sf):
    snapped = axis_lines(spark, sf).select("axis", g.snap_grid(F.col("geom"), 9000.0).alias("geom"))
    return snapped.select(
        "axis",
        F.size("geom").cast("long").alias("n"),
        F.aggregate("geom", F.lit(0.0), lambda a, v: a + v["y"]).alias("y"),
    )


@query(
    "rounded_coordinates",
    ctes(*fx("reach_vertices"))
    + "SELECT axis, ROUND(x / 7, 3) AS x, ROUND(y / 7, 3) AS y FROM fx_reach_vertices",
)
def _(spark, sf):
    drawn = axis_lines(spark, sf).select(
        "axis", F.transform("geom", lambda v: g.xy(v["x"] / 7, v["y"] / 7)).alias("geom")
    )
    return drawn.select("axis", F.explode(g.round_coordinates(F.col("geom"))).alias("v")).select(
        "axis", "v.x", "v.y"
    )


@query("drop_third_coordinate", ctes(*fx("reach_vertices")) + "SELECT axis, x, y FROM fx_reach_vertices")
def _(spark, sf):
    v = fixture.reach_vertices(spark, sf)
    solid = v.groupBy("axis").agg(
        F.collect_list(F.struct("x", "y", (F.col("y") / 10).alias("z"))).alias("geom")
    )
    flat = solid.select("axis", g.drop_z(F.col("geom")).alias("geom"))
    return flat.select("axis", F.explode("geom").alias("v")).select("axis", "v.x", "v.y")


@query(
    "srid_tag",
    ctes(*fx("reach_vertices")) + "SELECT axis, COUNT(*) AS n, 4326 AS srid FROM fx_reach_vertices GROUP BY axis",
)
def _(spark, sf):
    tagged = tag_srid(axis_lines(spark, sf), "geom", 4326)
    srid = tagged.schema["geom"].metadata["srid"]
    return tagged.select("axis", F.size("geom").cast("long").alias("n"), F.lit(srid).alias("srid"))


def _degrees_sql() -> str:
    """Inverse conic projection of points (x, y), six steps for the latitude."""
    e, n = repr(projection._E), repr(projection._N)
    steps = "PI() / 2 - 2 * ATAN(t)"
    for _ in range(projection._STEPS):
        steps = (
            f"PI() / 2 - 2 * ATAN(t * POW(2 / (1 + {e} * SIN({steps})) - 1, {projection._E / 2!r}))"
        )
    return f"""SELECT k, DEGREES(ATAN2(dx, dy) / {n}) + {projection.LON_ORIGIN} AS lon, DEGREES({steps}) AS lat
  FROM (SELECT k, x - {projection.EAST_0} AS dx, {projection._RHO_0 + projection.NORTH_0!r} - y AS dy,
    POW(SQRT((x - {projection.EAST_0}) * (x - {projection.EAST_0})
      + ({projection._RHO_0 + projection.NORTH_0!r} - y) * ({projection._RHO_0 + projection.NORTH_0!r} - y))
      / {projection._AF!r}, {1 / projection._N!r}) AS t FROM pts) q"""


@query(
    "reproject_points",
    ctes(
        *fx("sites"),
        ("pts", "SELECT libelle_site AS k, 650000 + x AS x, 6550000 + y AS y FROM fx_sites"),
        ("deg", _degrees_sql()),
    )
    + "SELECT k, ROUND(lon, 7) AS x, ROUND(lat, 7) AS y FROM deg",
)
def _(spark, sf):
    pts = fixture.sites(spark, sf).select(
        F.col("libelle_site").alias("k"),
        (F.col("x") + 650000).alias("x"),
        (F.col("y") + 6550000).alias("y"),
    )
    moved = projection.reproject(pts, ["x", "y"], 2154, 4326)
    return moved.select("k", F.round("x", 7).alias("x"), F.round("y", 7).alias("y"))


@query(
    "reproject_lines_round_trip",
    ctes(*fx("reach_vertices"))
    + "SELECT axis, ROUND(x + 650000, 4) AS x, ROUND(y + 6550000, 4) AS y FROM fx_reach_vertices",
)
def _(spark, sf):
    drawn = axis_lines(spark, sf).select(
        "axis",
        F.transform("geom", lambda v: g.xy(v["x"] + 650000, v["y"] + 6550000)).alias("geom"),
    )
    there = projection.reproject(drawn, ["geom"], 2154, 4326)
    back = projection.reproject(there, ["geom"], 4326, 2154)
    return back.select("axis", F.explode("geom").alias("v")).select(
        "axis", F.round("v.x", 4).alias("x"), F.round("v.y", 4).alias("y")
    )


# chords that are still to be split: at the vertex farthest from the chord, if beyond 400 m
CHORDS = """chords(axis, a, b) AS (
  SELECT axis, MIN(seq), MAX(seq) FROM fx_reach_vertices GROUP BY axis
  UNION ALL
  SELECT axis, CASE WHEN h.half = 0 THEN a ELSE far END, CASE WHEN h.half = 0 THEN far ELSE b END FROM (
    SELECT c.axis, c.a, c.b, p.seq AS far, d.d,
      ROW_NUMBER() OVER (PARTITION BY c.axis, c.a, c.b ORDER BY d.d DESC, p.seq) AS k
    FROM chords c
    JOIN fx_reach_vertices u ON u.axis = c.axis AND u.seq = c.a
    JOIN fx_reach_vertices v ON v.axis = c.axis AND v.seq = c.b
    JOIN fx_reach_vertices p ON p.axis = c.axis AND p.seq > c.a AND p.seq < c.b,
    LATERAL (SELECT LEAST(GREATEST(((p.x - u.x) * (v.x - u.x) + (p.y - u.y) * (v.y - u.y))
      / ((v.x - u.x) * (v.x - u.x) + (v.y - u.y) * (v.y - u.y)), 0), 1) AS f) t,
    LATERAL (SELECT SQRT(POW(p.x - u.x - t.f * (v.x - u.x), 2) + POW(p.y - u.y - t.f * (v.y - u.y), 2)) AS d) d
  ) s, (VALUES (0), (1)) h(half) WHERE s.k = 1 AND s.d > 400)"""


@query(
    "simplify_lines",
    ctes(*fx("reach_vertices"), recursive=True).rstrip()
    + f""",
{CHORDS},
kept AS (
  SELECT axis, seq, x, y, LEAD(x) OVER w AS nx, LEAD(y) OVER w AS ny FROM fx_reach_vertices v
  WHERE EXISTS (SELECT 1 FROM chords c WHERE c.axis = v.axis AND v.seq IN (c.a, c.b))
  WINDOW w AS (PARTITION BY axis ORDER BY seq))
SELECT axis, CAST(COUNT(*) AS INT) AS vertices, ROUND(SUM(SQRT(POW(nx - x, 2) + POW(ny - y, 2))), 3) AS length
FROM kept GROUP BY axis""",
)
def _(spark, sf):
    thin = simplify_lines(axis_lines(spark, sf), 400.0)
    return thin.select(
        "axis",
        F.size("geom").alias("vertices"),
        F.round(g.line_length(F.col("geom")), 3).alias("length"),
    )


# --- containment ---------------------------------------------------------------------------


@query(
    "points_in_regions",
    ctes(*fx("sites", "region_rings"), ("e", REGION_EDGES))
    + f"""SELECT p.libelle_site, p.x, p.y, e.gid_region FROM fx_sites p JOIN e ON {INSIDE}
GROUP BY p.libelle_site, p.x, p.y, e.gid_region HAVING COUNT(*) % 2 = 1""",
)
def points_in_regions(spark, sf):
    pts = fixture.sites(spark, sf).select("libelle_site", "x", "y")
    return containment.points_in_polygons(
        pts, region_edges(spark, sf), ["gid_region"]
    )


# two-vertex lines, some of which end on a border
SHORT_LINES = "SELECT axis * 100 + seg AS line_id, x1, y1, x2, y2 FROM segs"

PROBES = """SELECT line_id, 0 AS k, x1 AS x, y1 AS y FROM {lines} UNION ALL SELECT line_id, 1, x2, y2 FROM {lines}
  UNION ALL SELECT line_id, 2, (x1 + x2) / 2, (y1 + y2) / 2 FROM {lines}"""

LINE_REGIONS = """SELECT l.line_id, r.gid_region FROM {lines} l JOIN (
    SELECT line_id, gid_region FROM (
      SELECT p.line_id, p.k, e.gid_region FROM probes p JOIN region_edges e ON ({inside}) OR ({on_edge})
      GROUP BY p.line_id, p.k, e.gid_region
      HAVING COUNT(*) FILTER ({inside}) % 2 = 1 OR COUNT(*) FILTER ({on_edge}) > 0) i
    GROUP BY line_id, gid_region HAVING COUNT(*) = 3) r ON r.line_id = l.line_id
  WHERE NOT EXISTS (SELECT 1 FROM region_edges e WHERE e.gid_region = r.gid_region
    AND SIGN((e.x2 - e.x1) * (l.y1 - e.y1) - (e.y2 - e.y1) * (l.x1 - e.x1))
      * SIGN((e.x2 - e.x1) * (l.y2 - e.y1) - (e.y2 - e.y1) * (l.x2 - e.x1)) < 0
    AND SIGN((l.x2 - l.x1) * (e.y1 - l.y1) - (l.y2 - l.y1) * (e.x1 - l.x1))
      * SIGN((l.x2 - l.x1) * (e.y2 - l.y1) - (l.y2 - l.y1) * (e.x2 - l.x1)) < 0)"""


@query(
    "lines_in_regions",
    ctes(
        *fx("reach_vertices", "region_rings"),
        ("segs", SEGMENTS),
        ("short_lines", SHORT_LINES),
        (
            "probes",
            PROBES.format(lines="short_lines"),
        ),
        ("region_edges", REGION_EDGES),
        ("within", LINE_REGIONS.format(lines="short_lines", inside=INSIDE, on_edge=ON_EDGE)),
    )
    + """SELECT l.line_id, w.gid_region FROM short_lines l LEFT JOIN within w ON w.line_id = l.line_id""",
)
def _(spark, sf):
    segs = containment.line_edges(axis_lines(spark, sf), ["axis"])
    short = segs.select(
        (F.col("axis") * 100 + F.col("seg")).alias("line_id"),
        F.array(
            g.xy(F.col("x1"), F.col("y1")), g.xy(F.col("x2"), F.col("y2"))
        ).alias("geom"),
    )
    placed = containment.lines_in_polygons(short, region_edges(spark, sf), "line_id", "gid_region")
    return placed.select("line_id", "gid_region")


# --- splitting and merging -------------------------------------------------------------------


@query(
    "split_lines_by_swaths",
    ctes(*SPLIT)
    + """SELECT p.axis, l.measure AS m, CAST(p.axis + l.measure AS DOUBLE) AS drainage, ROUND(p.leng, 3) AS length,
  ROUND(p.xa, 3) AS x, ROUND(p.ya, 3) AS y
FROM pieces p LEFT JOIN labels l ON l.axis = p.axis AND l.piece = p.piece""",
)
def split_lines_by_swaths(spark, sf):
    pieces = lines.split_lines(
        fixture.reaches(spark, sf), fixture.swath_polygons(spark, sf)
    ).pieces
    start = g.first_vertex(F.col("geom"))
    return pieces.select(
        "axis",
        "m",
        "drainage",
        F.round(g.line_length(F.col("geom")), 3).alias("length"),
        F.round(start["x"], 3).alias("x"),
        F.round(start["y"], 3).alias("y"),
    )


PIECE_STRAHLER = """SELECT axis, piece, strahler FROM (
    SELECT w.axis, w.piece, (w.axis + w.reach) % 6 + 1 AS strahler,
      ROW_NUMBER() OVER (PARTITION BY w.axis, w.piece ORDER BY w.leng DESC, w.reach) AS k
    FROM (SELECT axis, piece, seg // 5 AS reach, SUM(leng) AS leng FROM stretch_rows GROUP BY 1, 2, 3) w) t
  WHERE k = 1"""


@query(
    "largest_overlap",
    ctes(*SPLIT, ("strahler_rows", PIECE_STRAHLER))
    + """SELECT p.axis, ROUND(p.leng, 3) AS length, CAST(s.strahler AS INT) AS strahler FROM pieces p
JOIN strahler_rows s ON s.axis = p.axis AND s.piece = p.piece""",
)
def _(spark, sf):
    reaches = fixture.reaches(spark, sf)
    split = lines.split_lines(reaches, fixture.swath_polygons(spark, sf))
    strahler = lines.largest_overlap(split.shares, reaches)
    return split.pieces.join(grown(strahler), "piece").select(
        "axis", F.round(g.line_length(F.col("geom")), 3).alias("length"), "strahler"
    )


@query(
    "merge_lines",
    ctes(*fx("reach_vertices"), ("segs", SEGMENTS))
    + """SELECT v.axis, v.n, s.length, v.x0, v.x1 FROM (
  SELECT axis, COUNT(*) AS n, MIN(x) AS x0, MAX(x) AS x1 FROM fx_reach_vertices GROUP BY axis) v
JOIN (SELECT axis, ROUND(SUM(leng), 3) AS length FROM segs GROUP BY axis) s ON s.axis = v.axis""",
)
def _(spark, sf):
    merged = lines.merge_lines(fixture.reaches(spark, sf), "fid")
    geom = F.col("geom")
    return merged.select(
        "axis",
        F.size(geom).cast("long").alias("n"),
        F.round(g.line_length(geom), 3).alias("length"),
        F.round(g.first_vertex(geom)["x"], 3).alias("x0"),
        F.round(g.last_vertex(geom)["x"], 3).alias("x1"),
    )


# --- network ---------------------------------------------------------------------------------------


@query(
    "network_nodes",
    ctes(
        *fx("reach_vertices"),
        (
            "ends",
            """SELECT axis, k, MAX(CASE WHEN seq = 5 * k THEN x END) AS xa, MAX(CASE WHEN seq = 5 * k THEN y END) AS ya,
    MAX(CASE WHEN seq = 5 * k + 5 THEN x END) AS xb, MAX(CASE WHEN seq = 5 * k + 5 THEN y END) AS yb
  FROM fx_reach_vertices CROSS JOIN (SELECT UNNEST(RANGE(4)) AS k) t GROUP BY axis, k""",
        ),
        (
            "nodes",
            """SELECT x, y, COUNT(*) AS n FROM (SELECT xa AS x, ya AS y FROM ends
    UNION ALL SELECT xb, yb FROM ends) u GROUP BY x, y""",
        ),
    )
    + """SELECT CAST(e.axis * 4 + e.k AS BIGINT) AS fid, a.n AS degree_a, b.n AS degree_b FROM ends e
JOIN nodes a ON a.x = e.xa AND a.y = e.ya JOIN nodes b ON b.x = e.xb AND b.y = e.yb""",
)
def _(spark, sf):
    drawn = network.identify_nodes(fixture.reaches(spark, sf)).select("fid", "node_a", "node_b")
    every = drawn.select(F.col("node_a").alias("node")).unionByName(
        drawn.select(F.col("node_b").alias("node"))
    )
    degree = every.groupBy("node").agg(F.count(F.lit(1)).alias("n"))
    a = degree.select(F.col("node").alias("node_a"), F.col("n").alias("degree_a"))
    b = degree.select(F.col("node").alias("node_b"), F.col("n").alias("degree_b"))
    return drawn.join(grown(a), "node_a").join(grown(b), "node_b").select("fid", "degree_a", "degree_b")


@query(
    "drop_degenerate_edges",
    ctes(*fx("edges")) + "SELECT * FROM fx_edges WHERE node_a <> node_b",
)
def _(spark, sf):
    return network.drop_degenerate(fixture.edges(spark, sf))


@query(
    "measure_from_outlet",
    ctes(
        *fx("edges"),
        ("valid", "SELECT * FROM fx_edges WHERE node_a <> node_b"),
        (
            "walk",
            """SELECT edge_id, axis, node_a, CAST(0 AS DOUBLE) AS measure, length FROM valid e
    WHERE NOT EXISTS (SELECT 1 FROM valid n WHERE n.axis = e.axis AND n.node_a = e.node_b)
    UNION ALL SELECT e.edge_id, e.axis, e.node_a, w.measure + w.length, e.length
    FROM valid e JOIN walk w ON w.axis = e.axis AND w.node_a = e.node_b""",
        ),
        recursive=True,
    )
    + "SELECT edge_id, axis, measure FROM walk",
)
def measure_from_outlet(spark, sf):
    edges = network.drop_degenerate(fixture.edges(spark, sf))
    return network.measure_from_outlet(edges).select("edge_id", "axis", "measure")


# running distance to the lower end of each segment, counted from the outlet
# ways no longer than that along the main river cannot be missed
BRAID_WAYS = """SELECT axis, CAST(20 AS BIGINT) AS node, 0e0 AS d FROM fx_braids WHERE edge_id % 1000 = 0
  UNION SELECT w.axis, r.v, w.d + r.length FROM ways w JOIN arcs r ON r.axis = w.axis AND r.u = w.node
  JOIN stem s ON s.axis = r.axis AND s.node = r.v WHERE w.d + r.length <= s.d"""


@query(
    "multipolygon_parts",
    ctes(
        *fx("region_rings", "nested_rings"),
        ("e", """SELECT a.gid, a.ring, a.seq, a.x AS x1, a.y AS y1, b.x AS x2, b.y AS y2
  FROM fx_nested_rings a JOIN fx_nested_rings b ON b.gid = a.gid AND b.ring = a.ring AND b.seq = a.seq + 1"""),
        ("p", "SELECT gid, ring, (x1 + x2) / 2 AS x, (y1 + y2) / 2 AS y FROM e WHERE seq = 0"),
        ("around", f"""SELECT p.gid, p.ring, e.ring AS other FROM p JOIN e ON e.gid = p.gid AND e.ring <> p.ring AND {INSIDE}
  GROUP BY p.gid, p.ring, e.ring HAVING COUNT(*) % 2 = 1"""),
        ("depths", """SELECT p.gid, p.ring, COUNT(a.other) AS depth FROM p LEFT JOIN around a ON a.gid = p.gid AND a.ring = p.ring
  GROUP BY p.gid, p.ring"""),
        ("areas", "SELECT gid, ring, ABS(SUM(x1 * y2 - x2 * y1)) / 2 AS area FROM e GROUP BY gid, ring"),
    )
    + """SELECT gid, COUNT(*) FILTER (depth % 2 = 0) AS parts, COUNT(*) FILTER (depth % 2 = 1) AS holes,
  ROUND(SUM(CASE WHEN depth % 2 = 0 THEN area ELSE -area END), 3) AS area
FROM depths JOIN areas USING (gid, ring) GROUP BY gid""",
)
def _(spark, sf):
    layer = readers.fold_vertices(fixture.nested_rings(spark, sf), ["gid"], "polygon")
    parts = rings.to_multipolygons(layer, "gid")
    n = F.size("parts")
    return parts.select(
        "gid", n.cast("long").alias("parts"), (F.size(F.flatten("parts")) - n).cast("long").alias("holes"),
        F.round(g.parts_area(F.col("parts")), 3).alias("area"),
    )


@query(
    "measure_braided_network",
    ctes(
        *fx("reach_vertices", "braids"),
        ("arcs", """SELECT axis, node_a AS u, node_b AS v, length FROM fx_braids
  UNION ALL SELECT axis, node_b, node_a, length FROM fx_braids"""),
        ("river", """SELECT axis, edge_id % 1000 AS node, SUM(length) OVER (PARTITION BY axis ORDER BY edge_id DESC) AS d
  FROM fx_braids WHERE edge_id % 1000 < 100 UNION ALL SELECT DISTINCT axis, 20, 0e0 FROM fx_braids"""),
        ("stem", """SELECT axis, node, d FROM river
  UNION ALL SELECT b.axis, b.edge_id % 100 + 50, r.d + b.length FROM fx_braids b
  JOIN river r ON r.axis = b.axis AND r.node = b.edge_id % 100 WHERE b.edge_id % 1000 BETWEEN 200 AND 299"""),
        ("ways", BRAID_WAYS),
        ("nearest", "SELECT axis, node, MIN(d) AS d FROM ways GROUP BY axis, node"),
        recursive=True,
    )
    + """SELECT b.edge_id, b.axis, CASE WHEN x.d <= y.d THEN x.d ELSE y.d END AS measure, CAST(y.d <= x.d AS INT) AS along FROM fx_braids b
LEFT JOIN nearest x ON x.axis = b.axis AND x.node = b.node_a LEFT JOIN nearest y ON y.axis = b.axis AND y.node = b.node_b""",
)
def _(spark, sf):
    edges = fixture.braids(spark, sf)
    outlets = edges.select("axis").distinct().withColumn("node", F.lit(20).cast("long"))
    return network.measure_from_outlet(edges, outlets=outlets).select(
        "edge_id", "axis", "measure", F.col("along").cast("int").alias("along")
    )


LOW = """SELECT axis, seg, x1, y1, x2, y2, leng, COALESCE(SUM(leng) OVER (PARTITION BY axis ORDER BY seg DESC
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS low FROM segs"""

FEET = """SELECT pid, axis, seg, leng, low, f, x1 + f * (x2 - x1) AS fx, y1 + f * (y2 - y1) AS fy,
    SQRT((px - x1 - f * (x2 - x1)) * (px - x1 - f * (x2 - x1))
      + (py - y1 - f * (y2 - y1)) * (py - y1 - f * (y2 - y1))) AS d FROM (
    SELECT p.pid, s.*, p.px, p.py, LEAST(GREATEST(((p.px - s.x1) * (s.x2 - s.x1) + (p.py - s.y1) * (s.y2 - s.y1))
      / ((s.x2 - s.x1) * (s.x2 - s.x1) + (s.y2 - s.y1) * (s.y2 - s.y1)), 0), 1) AS f
    FROM {points} p JOIN low s ON {condition}) t"""

POINTS = """SELECT c_custkey AS pid, CAST(FLOOR(c_custkey / 15e0) AS BIGINT) AS axis,
  (c_custkey * 7919) % 100000 + 5e-1 AS px, (c_custkey * 104729) % 100000 + 5e-1 AS py FROM customer"""


def network_points(spark, sf):
    """Customers as points, each with an axis of its own."""
    key = F.col("c_custkey")
    return fixture.table(spark, sf, "customer").select(
        key.alias("point_id"),
        F.floor(key / 15.0).alias("axis"),
        ((key * 7919) % 100000 + 0.5).alias("x"),
        ((key * 104729) % 100000 + 0.5).alias("y"),
    )


def network_segments(spark, sf):
    reaches = network.identify_nodes(fixture.reaches(spark, sf)).withColumn(
        "length", g.line_length(F.col("geom"))
    )
    measured = network.measure_from_outlet(
        reaches.select("fid", "axis", "node_a", "node_b", "length"), "fid"
    )
    return network.measured_segments(
        reaches.select("fid", "axis", "geom").join(grown(measured.select("fid", "measure")), "fid"), "fid"
    )


@query(
    "snap_to_lines",
    ctes(
        *fx("reach_vertices"),
        ("segs", SEGMENTS),
        ("low", LOW),
        ("pts", POINTS),
        ("feet", FEET.format(points="pts", condition="TRUE")),
    )
    + """SELECT pid AS point_id, ROUND(fx, 3) AS x, ROUND(fy, 3) AS y, ROUND(d, 3) AS snap_distance FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY pid ORDER BY d, axis, seg) AS k FROM feet) t WHERE k = 1 AND d <= 100""",
)
def _(spark, sf):
    segs = containment.line_edges(axis_lines(spark, sf), ["axis"]).withColumnRenamed(
        "axis", "line_id"
    )
    snapped = network.snap_to_lines(network_points(spark, sf), segs, 100.0)
    return snapped.select(
        "point_id",
        F.round("x", 3).alias("x"),
        F.round("y", 3).alias("y"),
        F.round("snap_distance", 3).alias("snap_distance"),
    )


@query(
    "snap_to_vertices",
    ctes(
        *fx("reach_vertices"),
        ("segs", SEGMENTS),
        ("low", LOW),
        ("pts", POINTS),
        ("feet", FEET.format(points="pts", condition="TRUE")),
        ("vertices", "SELECT axis, x, y FROM fx_reach_vertices"),
        ("corners", CORNERS.format(points="pts")),
    )
    + """SELECT t.pid AS point_id, ROUND(COALESCE(c.x, fx), 3) AS x, ROUND(COALESCE(c.y, fy), 3) AS y,
  ROUND(COALESCE(c.d, t.d), 3) AS snap_distance FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY pid ORDER BY d, axis, seg) AS k FROM feet) t
LEFT JOIN corners c ON c.pid = t.pid WHERE t.k = 1 AND t.d <= 100""",
)
def _(spark, sf):
    segs = containment.line_edges(axis_lines(spark, sf), ["axis"]).withColumnRenamed("axis", "line_id")
    snapped = network.snap_to_lines(network_points(spark, sf), segs, 100.0, prefer_vertices=True)
    return snapped.select(
        "point_id",
        F.round("x", 3).alias("x"),
        F.round("y", 3).alias("y"),
        F.round("snap_distance", 3).alias("snap_distance"),
    )


@query(
    "locate_points_on_axis",
    ctes(
        *fx("reach_vertices"),
        ("segs", SEGMENTS),
        ("low", LOW),
        ("pts", POINTS),
        ("feet", FEET.format(points="pts", condition="s.axis = p.axis")),
    )
    + """SELECT pid AS point_id, axis, ROUND(low + (1 - f) * leng, 2) AS distance_axis FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY pid ORDER BY d, seg) AS k FROM feet) t WHERE k = 1""",
)
def _(spark, sf):
    segments = saved(network_segments(spark, sf), "segments")
    located = network.locate_points(network_points(spark, sf), segments)
    return located.select("point_id", "axis", F.round("distance_axis", 2).alias("distance_axis"))
