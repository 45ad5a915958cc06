"""Corridor tables derived from the driver's tables, for queries, tests and bench.

The driver's tables hold no river data, so positions, labels and lengths are
derived from their keys and amounts, over the whole tables. ``SQL`` holds the
same derivation for the oracle. Amounts are summed as whole cents, so that no
result depends on the order of a float sum.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riverloom.schemas import CONTINUITY_LABELS, LANDCOVER_LABELS


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _slot() -> Column:
    return F.col("l_partkey") % 40


def _measure() -> Column:
    return (_slot() * 200).cast("long").alias("measure")


def _side() -> Column:
    return F.when(F.col("l_linestatus") == "F", "left").otherwise("right").alias("side")


def _label(labels: list[str], a: int, n: int, r: int) -> Column:
    shift = F.when(F.col("l_returnflag") == "A", a).when(F.col("l_returnflag") == "N", n)
    index = (F.col("l_linenumber") + shift.otherwise(r)) % len(labels)
    return F.element_at(F.array(*[F.lit(x) for x in labels]), (index + 1).cast("int")).alias("label")


def _area() -> Column:
    cents = F.round(F.col("l_extendedprice") * 100).cast("long")
    return (F.sum(cents).cast("double") / 100.0).alias("area")


def _width1() -> Column:
    return F.sum(F.col("l_quantity").cast("long")).cast("double").alias("width1")


def _labelled(spark, sf_dir, label: Column) -> DataFrame:
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_suppkey").cast("long").alias("axis"), _measure(), _side(), label)
        .agg(_area(), _width1())
    )


def landcover(spark, sf_dir) -> DataFrame:
    return _labelled(spark, sf_dir, _label(LANDCOVER_LABELS, 0, 3, 6))


def continuity(spark, sf_dir) -> DataFrame:
    return _labelled(spark, sf_dir, _label(CONTINUITY_LABELS, 0, 2, 5))


def valley_bottom(spark, sf_dir) -> DataFrame:
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy(
            (F.col("l_suppkey") * 40 + _slot()).cast("long").alias("swath"),
            _side(),
            F.col("l_suppkey").cast("long").alias("axis"),
            _measure(),
        )
        .agg(
            _area(),
            _width1(),
            F.max(F.col("l_quantity").cast("long")).cast("double").alias("width2"),
        )
    )


def talweg(spark, sf_dir) -> DataFrame:
    return (
        table(spark, sf_dir, "lineitem")
        .filter(_slot() != 3)
        .groupBy(F.col("l_suppkey").cast("long").alias("axis"), _measure())
        .agg(
            F.min("l_extendedprice").alias("elevation_talweg"),
            F.max("l_discount").alias("slope_talweg"),
            F.min("l_tax").alias("slope_valley_bottom"),
        )
    )


def duplicates(spark, sf_dir) -> DataFrame:
    """True duplicates and null measures."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("long").alias("axis"),
        F.when(F.col("l_discount") != 0, F.col("l_linenumber").cast("long")).alias("measure"),
        F.col("l_extendedprice").alias("leng"),
    )


def swaths(spark, sf_dir) -> DataFrame:
    """Swath rows; every seventh position is missing."""
    slot = F.col("slot")
    sup = F.col("l_suppkey").cast("long")
    return (
        table(spark, sf_dir, "lineitem")
        .select("l_suppkey", _slot().alias("slot"))
        .filter(slot % 7 != 0)
        .distinct()
        .select(
            (sup * 100000 + slot * 200).alias("gid"),
            sup.alias("axis"),
            (slot * 200).cast("long").alias("measure_medial_axis"),
            (slot * 210).cast("double").alias("measure_from_outlet"),
            F.when((slot == 11) & (sup % 5 == 0), None)
            .otherwise((190 + slot).cast("double"))
            .alias("length"),
            (sup % 6 + 1).cast("int").alias("strahler"),
            F.when(slot > 30, None)
            .otherwise(((sup + F.floor(slot / 16.0)) % 5).cast("int"))
            .alias("gid_region"),
        )
    )


def profiles(spark, sf_dir) -> DataFrame:
    qty = F.col("l_quantity").cast("long")
    place = F.col("l_suppkey") * 40 + _slot()
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy(
            (place * 21 + qty % 21).cast("long").alias("sample"),
            _side(),
            (25 * (F.col("l_linenumber") % 3 + 1)).cast("int").alias("quantile"),
            place.cast("double").alias("profile"),
            F.col("l_suppkey").cast("long").alias("axis"),
            _measure(),
            ((qty % 21 - 10) * 10).cast("int").alias("distance"),
        )
        .agg(
            (F.count(F.lit(1)) - 1).cast("int").alias("density"),
            F.when(F.min("l_discount") != 0, F.min("l_extendedprice")).alias("mean"),
        )
        .select(
            "sample", "side", "quantile", "density", "mean", "profile", "axis", "measure", "distance"
        )
    )


def sites(spark, sf_dir) -> DataFrame:
    key = F.col("c_custkey")
    code = key - F.when(key % 5 == 4, 1).otherwise(0)
    return table(spark, sf_dir, "customer").select(
        F.when(key % 17 != 0, F.concat(F.lit("S"), code.cast("string"))).alias("code_site"),
        F.col("c_name").alias("libelle_site"),
        (key % 3).cast("int").alias("statut_site"),
        ((key * 7919) % 100000 + 0.5).alias("x"),
        ((key * 104729) % 100000 + 0.5).alias("y"),
    )


def _each(values: list[tuple], names: list[str]) -> Column:
    rows = [F.struct(*[F.lit(v).alias(n) for v, n in zip(row, names)]) for row in values]
    return F.explode(F.array(*rows))


def region_rings(spark, sf_dir) -> DataFrame:
    """25 L-shaped cells of 20 km; a quarter of the plane is uncovered."""
    corners = [
        (0, 0, 0),
        (1, 20000, 0),
        (2, 20000, 10000),
        (3, 10000, 10000),
        (4, 10000, 20000),
        (5, 0, 20000),
        (6, 0, 0),
    ]
    key = F.col("n_nationkey")
    return (
        table(spark, sf_dir, "nation")
        .select("n_nationkey", _each(corners, ["seq", "dx", "dy"]).alias("t"))
        .select(
            key.alias("gid"),
            F.col("t.seq").alias("seq"),
            ((key % 5) * 20000 + F.col("t.dx")).cast("double").alias("x"),
            (F.floor(key / 5.0) * 20000 + F.col("t.dy")).cast("double").alias("y"),
        )
    )


# rings 1 to 6 beside the region's own: a hole, an island in it, a lake on that, an island
# there, a part of its own and its hole
SQUARES = [
    (1, 1000, 1000, 9000, 9000),
    (2, 2000, 2000, 8000, 8000),
    (3, 3000, 3000, 5000, 7000),
    (4, 3500, 3500, 4500, 4500),
    (5, 12000, 12000, 18000, 18000),
    (6, 13000, 13000, 17000, 14000),
]


def _square_corners() -> list[tuple]:
    rows = []
    for ring, x0, y0, x1, y1 in SQUARES:
        corners = [(x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0)]
        rows += [(ring, seq, x, y) for seq, (x, y) in enumerate(corners)]
    return rows


def nested_rings(spark, sf_dir) -> DataFrame:
    """Regions with holes and islands, rings in any order and drawn either way."""
    key, ring, seq = F.col("n_nationkey"), F.col("t.ring"), F.col("t.seq")
    gid = key.cast("long")
    flip = (key + ring) % 2 == 0
    squares = (
        table(spark, sf_dir, "nation")
        .select("n_nationkey", _each(_square_corners(), ["ring", "seq", "dx", "dy"]).alias("t"))
        .select(
            gid.alias("gid"),
            ((ring * 3 + key) % 7).cast("int").alias("ring"),
            F.when(flip, 4 - seq).otherwise(seq).cast("int").alias("seq"),
            ((key % 5) * 20000 + F.col("t.dx")).cast("double").alias("x"),
            (F.floor(key / 5.0) * 20000 + F.col("t.dy")).cast("double").alias("y"),
        )
    )
    own = region_rings(spark, sf_dir).select(
        F.col("gid").cast("long").alias("gid"), (F.col("gid") % 7).cast("int").alias("ring"), F.col("seq").cast("int").alias("seq"), "x", "y"
    )
    return own.unionByName(squares)


def reach_vertices(spark, sf_dir) -> DataFrame:
    """One 21-vertex line per axis."""
    key, i = F.col("s_suppkey"), F.col("i")
    return (
        table(spark, sf_dir, "supplier")
        .select("s_suppkey", F.explode(F.sequence(F.lit(0), F.lit(20))).alias("i"))
        .select(
            key.cast("long").alias("axis"),
            i.alias("seq"),
            (i * 5000).cast("double").alias("x"),
            (
                ((key * 977) % 90000 + 5000 + ((i * i * 37 + key * 13) % 11) * 100).cast("double")
                + 0.25
            ).alias("y"),
        )
    )


def swath_rings(spark, sf_dir) -> DataFrame:
    """Strips across each axis, every fourth missing, borders off the vertices."""
    corners = [(0, 0, 0), (1, 10000, 0), (2, 10000, 100000), (3, 0, 100000), (4, 0, 0)]
    key, k = F.col("s_suppkey"), F.col("k")
    return (
        table(spark, sf_dir, "supplier")
        .select("s_suppkey", F.explode(F.sequence(F.lit(0), F.lit(9))).alias("k"))
        .filter((key + k) % 4 != 0)
        .select("s_suppkey", "k", _each(corners, ["seq", "dx", "dy"]).alias("t"))
        .select(
            key.cast("long").alias("axis"),
            (k * 200).cast("long").alias("measure"),
            F.col("t.seq").alias("seq"),
            (k * 10000 + 1250 + F.col("t.dx")).cast("double").alias("x"),
            F.col("t.dy").cast("double").alias("y"),
        )
    )


def edges(spark, sf_dir) -> DataFrame:
    """Ten trees; the first edge of each is degenerate."""
    n = F.floor(F.col("o_orderkey") / 10.0)
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("edge_id"),
        (F.col("o_orderkey") % 10).alias("axis"),
        n.alias("node_a"),
        F.floor(n * 9 / 10.0).alias("node_b"),
        F.floor("o_totalprice").cast("double").alias("length"),
    )


def braids(spark, sf_dir) -> DataFrame:
    """One river an axis, from node 0 to its outlet 20, with arms, side branches and a ring of
    its own; lines are drawn either way."""
    v = reach_vertices(spark, sf_dir).select("axis", F.col("seq").cast("long").alias("s"))
    a, s = F.col("axis"), F.col("s")

    def lines(kind: int, where: Column, start: Column, stop: Column, length: Column) -> DataFrame:
        flip = (a + s * 3 + kind) % 2 == 0
        return v.filter(where).select(
            (a * 1000 + kind * 100 + s).alias("edge_id"), "axis",
            F.when(flip, stop).otherwise(start).cast("long").alias("node_a"),
            F.when(flip, start).otherwise(stop).cast("long").alias("node_b"),
            length.cast("double").alias("length"),
        )

    return (
        lines(0, s < 20, s, s + 1, (a * 31 + s * 17) % 90 + 10)
        .unionByName(lines(1, (s % 5 == 1) & (s <= 16), s, s + 3, (a * 13 + s * 7) % 190 + 20))
        .unionByName(lines(2, s % 7 == 3, s, s + 50, (a + s) % 9 + 1))
        .unionByName(lines(3, s < 3, s + 100, (s + 1) % 3 + 100, F.lit(5)))
    )


def links(spark, sf_dir) -> DataFrame:
    key = F.col("o_orderkey")
    course = F.lpad(F.col("o_custkey").cast("string"), 16, "0")
    second = F.when(key % 3 == 0, "/COURDEAU0000000000000099").otherwise("")
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("T"), key.cast("string")).alias("id_troncon"),
        F.when(key % 11 == 0, None)
        .when(key % 13 == 0, "")
        .otherwise(F.concat(F.lit("COURDEAU"), course, second))
        .alias("link"),
    )


# --- geometry tables in array form -----------------------------------------------


def reaches(spark, sf_dir) -> DataFrame:
    """The lines of ``reach_vertices`` cut into four reaches of five segments.

    Vertices 0, 5, 10, 15 and 20 are ends, so a vertex at a joint is in two
    reaches. Strahler order and name differ from reach to reach.
    """
    v = reach_vertices(spark, sf_dir)
    part = F.explode(
        F.array_distinct(
            F.filter(
                F.array(F.floor(F.col("seq") / 5.0), F.ceil(F.col("seq") / 5.0) - 1),
                lambda k: (k >= 0) & (k <= 3),
            )
        )
    )
    return (
        v.select("axis", "seq", "x", "y", part.alias("part"))
        .groupBy("axis", "part")
        .agg(F.sort_array(F.collect_list(F.struct("seq", "x", "y"))).alias("v"))
        .select(
            (F.col("axis") * 4 + F.col("part")).alias("fid"),
            "axis",
            ((F.col("axis") + F.col("part")) % 6 + 1).cast("int").alias("strahler"),
            F.when(F.col("part") == 0, None)
            .otherwise(F.concat(F.lit("River "), (F.col("axis") * 4 + F.col("part")).cast("string")))
            .alias("toponyme"),
            F.transform("v", lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y"))).alias("geom"),
        )
    )


def swath_polygons(spark, sf_dir) -> DataFrame:
    """One polygon per strip, with value 2 as for valid swaths."""
    return (
        swath_rings(spark, sf_dir)
        .groupBy("axis", "measure")
        .agg(F.sort_array(F.collect_list(F.struct("seq", "x", "y"))).alias("v"))
        .select(
            "axis",
            F.col("measure").alias("m"),
            F.lit(2).alias("value"),
            (F.col("axis") + F.col("measure")).cast("double").alias("drainage"),
            F.array(
                F.transform("v", lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y")))
            ).alias("geom"),
        )
    )


# --- the same derivations as SQL text ------------------------------------------------


def _label_case(labels: list[str], n: int, r: int) -> str:
    shift = f"CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN {n} ELSE {r} END"
    arms = " ".join(f"WHEN {i} THEN '{x}'" for i, x in enumerate(labels))
    return f"CASE (l_linenumber + {shift}) % {len(labels)} {arms} END"


def _labelled_sql(label_case: str) -> str:
    return f"""SELECT CAST(l_suppkey AS BIGINT) AS axis,
       CAST((l_partkey % 40) * 200 AS BIGINT) AS measure,
       CASE WHEN l_linestatus = 'F' THEN 'left' ELSE 'right' END AS side,
       {label_case} AS label,
       CAST(SUM(CAST(ROUND(l_extendedprice * 100) AS BIGINT)) AS DOUBLE) / 1e2 AS area,
       CAST(SUM(CAST(l_quantity AS BIGINT)) AS DOUBLE) AS width1
FROM lineitem GROUP BY 1, 2, 3, 4"""


SQL = {
    "landcover": _labelled_sql(_label_case(LANDCOVER_LABELS, 3, 6)),
    "continuity": _labelled_sql(_label_case(CONTINUITY_LABELS, 2, 5)),
    "valley_bottom": """SELECT CAST(l_suppkey * 40 + l_partkey % 40 AS BIGINT) AS swath,
       CASE WHEN l_linestatus = 'F' THEN 'left' ELSE 'right' END AS side,
       CAST(SUM(CAST(ROUND(l_extendedprice * 100) AS BIGINT)) AS DOUBLE) / 1e2 AS area,
       CAST(SUM(CAST(l_quantity AS BIGINT)) AS DOUBLE) AS width1,
       CAST(MAX(CAST(l_quantity AS BIGINT)) AS DOUBLE) AS width2,
       CAST(l_suppkey AS BIGINT) AS axis,
       CAST((l_partkey % 40) * 200 AS BIGINT) AS measure
FROM lineitem GROUP BY 1, 2, 6, 7""",
    "talweg": """SELECT CAST(l_suppkey AS BIGINT) AS axis,
       CAST((l_partkey % 40) * 200 AS BIGINT) AS measure,
       MIN(l_extendedprice) AS elevation_talweg,
       MAX(l_discount) AS slope_talweg,
       MIN(l_tax) AS slope_valley_bottom
FROM lineitem WHERE l_partkey % 40 <> 3 GROUP BY 1, 2""",
    "duplicates": """SELECT CAST(l_orderkey AS BIGINT) AS axis,
       CASE WHEN l_discount = 0 THEN NULL ELSE CAST(l_linenumber AS BIGINT) END AS measure,
       l_extendedprice AS leng
FROM lineitem""",
    "swaths": """SELECT CAST(l_suppkey AS BIGINT) * 100000 + (l_partkey % 40) * 200 AS gid,
       CAST(l_suppkey AS BIGINT) AS axis,
       CAST((l_partkey % 40) * 200 AS BIGINT) AS measure_medial_axis,
       CAST((l_partkey % 40) * 210 AS DOUBLE) AS measure_from_outlet,
       CASE WHEN l_partkey % 40 = 11 AND l_suppkey % 5 = 0 THEN NULL
            ELSE CAST(190 + l_partkey % 40 AS DOUBLE) END AS length,
       CAST(l_suppkey % 6 + 1 AS INT) AS strahler,
       CASE WHEN l_partkey % 40 > 30 THEN NULL
            ELSE CAST((l_suppkey + CAST(FLOOR((l_partkey % 40) / 16e0) AS BIGINT)) % 5 AS INT) END AS gid_region
FROM lineitem WHERE (l_partkey % 40) % 7 <> 0 GROUP BY l_suppkey, l_partkey % 40""",
    "profiles": """SELECT CAST((l_suppkey * 40 + l_partkey % 40) * 21 + CAST(l_quantity AS BIGINT) % 21 AS BIGINT) AS sample,
       CASE WHEN l_linestatus = 'F' THEN 'left' ELSE 'right' END AS side,
       CAST(25 * (l_linenumber % 3 + 1) AS INT) AS quantile,
       CAST(COUNT(*) - 1 AS INT) AS density,
       CASE WHEN MIN(l_discount) = 0 THEN NULL ELSE MIN(l_extendedprice) END AS mean,
       CAST((l_suppkey * 40 + l_partkey % 40) AS DOUBLE) AS profile,
       CAST(l_suppkey AS BIGINT) AS axis,
       CAST((l_partkey % 40) * 200 AS BIGINT) AS measure,
       CAST((CAST(l_quantity AS BIGINT) % 21 - 10) * 10 AS INT) AS distance
FROM lineitem GROUP BY 1, 2, 3, 6, 7, 8, 9""",
    "sites": """SELECT CASE WHEN c_custkey % 17 = 0 THEN NULL
            ELSE CONCAT('S', CAST(c_custkey - CASE WHEN c_custkey % 5 = 4 THEN 1 ELSE 0 END AS VARCHAR(20))) END AS code_site,
       c_name AS libelle_site,
       CAST(c_custkey % 3 AS INT) AS statut_site,
       (c_custkey * 7919) % 100000 + 5e-1 AS x,
       (c_custkey * 104729) % 100000 + 5e-1 AS y
FROM customer""",
    "region_rings": """SELECT n_nationkey AS gid, CAST(t.seq AS INT) AS seq,
       CAST((n_nationkey % 5) * 20000 + t.dx AS DOUBLE) AS x,
       CAST(FLOOR(n_nationkey / 5e0) * 20000 + t.dy AS DOUBLE) AS y
FROM nation CROSS JOIN (VALUES (0,0,0),(1,20000,0),(2,20000,10000),(3,10000,10000),
                               (4,10000,20000),(5,0,20000),(6,0,0)) AS t(seq, dx, dy)""",
    "nested_rings": f"""SELECT CAST(gid AS BIGINT) AS gid, CAST(gid % 7 AS INT) AS ring, seq, x, y FROM fx_region_rings
UNION ALL SELECT CAST(n_nationkey AS BIGINT), CAST((t.ring * 3 + n_nationkey) % 7 AS INT),
       CAST(CASE WHEN (n_nationkey + t.ring) % 2 = 0 THEN 4 - t.seq ELSE t.seq END AS INT),
       CAST((n_nationkey % 5) * 20000 + t.dx AS DOUBLE), CAST(FLOOR(n_nationkey / 5e0) * 20000 + t.dy AS DOUBLE)
FROM nation CROSS JOIN (VALUES {', '.join(map(str, _square_corners()))}) AS t(ring, seq, dx, dy)""",
    "reach_vertices": """SELECT CAST(s_suppkey AS BIGINT) AS axis, CAST(t.i AS INT) AS seq,
       CAST(t.i * 5000 AS DOUBLE) AS x,
       CAST((s_suppkey * 977) % 90000 + 5000 + ((t.i * t.i * 37 + s_suppkey * 13) % 11) * 100 AS DOUBLE) + 2.5e-1 AS y
FROM supplier CROSS JOIN (SELECT UNNEST(RANGE(21)) AS i) AS t""",
    "swath_rings": """SELECT CAST(s_suppkey AS BIGINT) AS axis, CAST(k.k * 200 AS BIGINT) AS measure, CAST(t.seq AS INT) AS seq,
       CAST(k.k * 10000 + 1250 + t.dx AS DOUBLE) AS x, CAST(t.dy AS DOUBLE) AS y
FROM supplier CROSS JOIN (SELECT UNNEST(RANGE(10)) AS k) AS k
CROSS JOIN (VALUES (0,0,0),(1,10000,0),(2,10000,100000),(3,0,100000),(4,0,0)) AS t(seq, dx, dy)
WHERE (s_suppkey + k.k) % 4 <> 0""",
    "edges": """SELECT o_orderkey AS edge_id, o_orderkey % 10 AS axis,
       CAST(FLOOR(o_orderkey / 10e0) AS BIGINT) AS node_a,
       CAST(FLOOR(FLOOR(o_orderkey / 10e0) * 9 / 10e0) AS BIGINT) AS node_b,
       CAST(FLOOR(o_totalprice) AS DOUBLE) AS length
FROM orders""",
    "braids": " UNION ALL ".join(
        f"""SELECT axis * 1000 + {kind * 100} + seq AS edge_id, axis,
       CAST(CASE WHEN (axis + seq * 3 + {kind}) % 2 = 0 THEN {b} ELSE {a} END AS BIGINT) AS node_a,
       CAST(CASE WHEN (axis + seq * 3 + {kind}) % 2 = 0 THEN {a} ELSE {b} END AS BIGINT) AS node_b,
       CAST({length} AS DOUBLE) AS length FROM fx_reach_vertices WHERE {where}"""
        for kind, where, a, b, length in (
            (0, "seq < 20", "seq", "seq + 1", "(axis * 31 + seq * 17) % 90 + 10"),
            (1, "seq % 5 = 1 AND seq <= 16", "seq", "seq + 3", "(axis * 13 + seq * 7) % 190 + 20"),
            (2, "seq % 7 = 3", "seq", "seq + 50", "(axis + seq) % 9 + 1"),
            (3, "seq < 3", "seq + 100", "(seq + 1) % 3 + 100", "5"),
        )
    ),
    "links": """SELECT CONCAT('T', CAST(o_orderkey AS VARCHAR(20))) AS id_troncon,
       CASE WHEN o_orderkey % 11 = 0 THEN NULL WHEN o_orderkey % 13 = 0 THEN ''
            ELSE CONCAT('COURDEAU', LPAD(CAST(o_custkey AS VARCHAR(20)), 16, '0'),
                        CASE WHEN o_orderkey % 3 = 0 THEN '/COURDEAU0000000000000099' ELSE '' END) END AS link
FROM orders""",
}
