import heapq
import random

import pytest
from pyspark.sql import functions as F

from riverloom.functions.geometry import line_length
from riverloom.operators import graph, joins, network
from riverloom.plans import prepare

EDGES = "e long, a long, b long, len double"
REACH = "fid long, axis long, strahler int, toponyme string, geom array<struct<x:double,y:double>>"
SWATH = "axis long, m double, value int, drainage double, geom array<array<struct<x:double,y:double>>>"


def shortest(edges, outlets):
    near = {}
    for _, a, b, n in edges:
        near.setdefault(a, []).append((b, n))
        near.setdefault(b, []).append((a, n))
    best, heap = {}, [(0.0, n) for n in outlets]
    while heap:
        d, n = heapq.heappop(heap)
        if n in best:
            continue
        best[n] = d
        for m, size in near.get(n, []):
            heapq.heappush(heap, (d + size, m))
    return best


def flipped(edges, rng):
    return [(e, b, a, n) if rng.random() < 0.5 else (e, a, b, n) for e, a, b, n in edges]


def tree(n, reach, rng):
    return [(i, i, rng.randrange(max(0, i - reach), i), float(rng.randint(1, 9))) for i in range(1, n)]


def braided(n, rng):
    """A long river with islands, a ring, side branches, and a part of its own."""
    edges = [(i, i, i + 1, float(rng.randint(1, 9))) for i in range(n)]
    for i in range(3, n - 6, 9):
        edges.append((1000 + i, i, i + rng.randint(2, 5), float(rng.randint(1, 30))))
    for i in range(5, n, 17):
        edges += [(2000 + i, i, 5000 + i, 4.0), (3000 + i, 5000 + i, 6000 + i, 1.0), (4000 + i, 6000 + i, 5000 + i, 9.0)]
    edges += [(9000 + i, 8000 + i, 8000 + (i + 1) % 5, 2.0) for i in range(5)]
    return edges + [(9100, 9101, 9102, 1.0)]


SHAPES = [
    lambda rng: [(i, i, i + 1, 1.0) for i in range(120)],  # a path
    lambda rng: [(i, i, i + 1, 2.0) for i in range(40)] + [(500 + i, i, 500 + i, 1.0 + i) for i in range(40)],  # a comb
    lambda rng: tree(120, 120, rng),
    lambda rng: tree(120, 3, rng),
    lambda rng: braided(60, rng),
    lambda rng: [(i, rng.randrange(12), 12 + rng.randrange(12), float(rng.randint(1, 20))) for i in range(60)],
]


def test_distances_against_dijkstra(spark):
    """Graphs of all shapes, side by side."""
    rng = random.Random(5)
    edges, outlets = [], []
    for k, shape in enumerate(SHAPES):
        edges += [(k * 10**5 + e, k * 10**5 + a, k * 10**5 + b, n) for e, a, b, n in shape(rng)]
        outlets += [k * 10**5] + ([k * 10**5 + 40] if k == 4 else [])
    edges = flipped(edges, rng)
    best = shortest(edges, outlets)
    df = spark.createDataFrame(edges, EDGES).repartition(3)
    got = graph.end_distances(df, spark.createDataFrame([(n,) for n in outlets], "n long")).collect()
    assert {r.e: (r.d_a, r.d_b) for r in got} == {e: (best.get(a), best.get(b)) for e, a, b, _ in edges}


def test_parallel_edges_rings_and_nothing(spark):
    edges = [(1, 1, 2, 5.0), (2, 2, 1, 3.0), (3, 2, 3, 1.0), (4, 10, 11, 1.0), (5, 11, 12, 2.0), (6, 12, 10, 3.0)]
    df = spark.createDataFrame(edges, EDGES)

    def found(*outlets):
        out = graph.end_distances(df, spark.createDataFrame([(n,) for n in outlets], "n long")).collect()
        return {r.e: (r.d_a, r.d_b) for r in out}

    none = {e: (None, None) for e in range(1, 7)}
    parts = {1: (4.0, 1.0), 2: (1.0, 4.0), 3: (1.0, 0.0)}, {4: (1.0, 0.0), 5: (0.0, 2.0), 6: (2.0, 1.0)}
    assert found(3, 11) == parts[0] | parts[1]
    assert found(99, 3) == none | parts[0]
    empty = graph.end_distances(df.limit(0), spark.createDataFrame([(1,)], "n long"))
    assert empty.collect() == []


def test_components(spark, rows):
    rng = random.Random(2)
    links = [(rng.randrange(200), rng.randrange(200)) for _ in range(140)] + [(i + 300, i + 301) for i in range(100)] + [(7, 7), (999, 999)]
    root = {n: n for p in links for n in p}

    def top(n):
        return n if root[n] == n else top(root[n])

    for a, b in links:
        x, y = sorted((top(a), top(b)))
        root[y] = x
    got = rows(graph.components(spark.createDataFrame(links, "u long, v long")), "n", "component")
    assert got == sorted(((n, top(n)) for n in root), key=repr)


def net(spark, edges, values=None):
    rows = [(e, 1, str(a), str(b), n, (values or {}).get(e)) for e, a, b, n in edges]
    return spark.createDataFrame(rows, "edge_id long, axis long, node_a string, node_b string, length double, drained double")


def test_flips_change_nothing(spark):
    """Outlets are given, or told by a value that rises; forks and rings included."""
    rng = random.Random(9)
    edges = braided(18, rng)
    best = shortest(edges, [18])
    want = {e: min(best[a], best[b]) if a in best else None for e, a, b, _ in edges}
    values = {i: 1.0 + i for i in range(4, 14)} | {2005: 0.5}
    for seed in (1,):
        rng = random.Random(seed)
        turned = flipped(edges, rng)
        outlet = spark.createDataFrame([(1, "18")], "axis long, node string")
        out = network.measure_from_outlet(net(spark, turned), outlets=outlet).collect()
        assert {r.edge_id: r.measure for r in out} == want
        for r in out:
            if r.measure is not None:
                a, b = best[int(r.node_a)], best[int(r.node_b)]
                assert r.along == (b <= a)
        out = network.measure_from_outlet(net(spark, turned, values), rising="drained").collect()
        river = {e for e, a, _, _ in edges if a in best}
        assert {r.edge_id: r.measure for r in out if r.edge_id in river} == {e: want[e] for e in river}


def test_vertex_order_where_values_do_not_tell(spark, rows):
    edges = [(1, 1, 2, 5.0), (2, 2, 3, 7.0), (3, 2, 4, 9.0), (4, 20, 21, 1.0), (5, 21, 22, 2.0), (6, 30, 31, 1.0), (7, 32, 31, 1.0)]
    values = {1: 3.0, 2: 3.0, 4: 8.0, 5: 2.0}
    out = network.measure_from_outlet(net(spark, edges, values), rising="drained")
    # sinks 3 and 4; the leaf 20, where more is drained; the sink 31 in the middle
    assert rows(out, "edge_id", "measure") == [(1, 7.0), (2, 0.0), (3, 0.0), (4, 0.0), (5, 1.0), (6, 0.0), (7, 0.0)]


def test_network_of_reaches_drawn_any_way(spark):
    """The job's measures, lengths and directions do not depend on the reaches' vertex order."""
    swaths = [
        (axis, float(200 * k), 2, 10.0 + 5 * k, [[(x, y) for x, y in ((100 * k + 5.5, -60.0), (100 * k + 105.5, -60.0), (100 * k + 105.5, 60.0), (100 * k + 5.5, 60.0), (100 * k + 5.5, -60.0))]])
        for axis in (1, 2) for k in range(6)
    ]
    lines = []
    for axis in (1, 2):
        lines += [(axis * 10 + k, axis, k % 3, "r", [(150.0 * k, 0.0), (150.0 * k + 70, 1.0), (150.0 * k + 150, 0.0)]) for k in range(4)]
    # axis 2 has an arm around its second reach, and a side branch
    lines += [(25, 2, 1, "r", [(150.0, 0.0), (225.0, 30.0), (300.0, 0.0)]), (26, 2, 1, "r", [(300.0, 0.0), (310.0, 50.0)])]
    edges = spark.createDataFrame([], "gid_region int, x1 double, y1 double, x2 double, y2 double")
    results = []
    for seed in (None, 1):
        rng = random.Random(seed)
        drawn = [r if seed is None or rng.random() < 0.5 else (*r[:4], r[4][::-1]) for r in lines]
        built = prepare.prepare_swaths_and_axis(spark.createDataFrame(swaths, SWATH), spark.createDataFrame(drawn, REACH), edges)
        first = F.col("geom")[0]
        out = built.hydro_swaths.select(
            "axis", "measure_medial_axis", F.round("measure_from_outlet", 6).alias("d"), F.round("length", 6).alias("n"),
            F.round(first["x"], 6).alias("x"), F.round(first["y"], 6).alias("y"),
        ).collect()
        results.append(sorted(map(tuple, out), key=repr))
        total = built.hydro_swaths.agg(F.sum(line_length(F.col("geom")))).first()[0]
        assert total == pytest.approx(sum(sum(((a - c) ** 2 + (b - d) ** 2) ** 0.5 for (a, b), (c, d) in zip(r[4], r[4][1:])) for r in lines))
    assert results[0] == results[1]
    assert any(r[2] == 0.0 for r in results[0])


def test_hot_keys_are_split(spark, rows):
    left = spark.range(4000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 7 WHEN id % 3 = 1 THEN id WHEN id % 30 = 2 THEN NULL ELSE id % 50 END AS k", "array(id) AS x")
    right = spark.range(0, 4000, 2).selectExpr("id AS k", "-id AS v").unionByName(spark.createDataFrame([(7, 70), (9, 90)], "k long, v long"))
    assert len(joins.hot_keys(left, ["k"])) >= 1
    for how in ("left", "left_semi", "left_anti"):
        want = left.join(right, "k", how).select(*left.columns, *(["v"] if how == "left" else []))
        assert rows(joins.hot_join(left, right, ["k"], how)) == rows(want)
    assert joins.hot_keys(left.limit(0), ["k"]) == [] and joins.hot_keys(spark.range(100000).withColumnRenamed("id", "k"), ["k"]) == []
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = joins.hot_join(left, right, ["k"], "left_semi").withColumn("p", F.spark_partition_id())
        sizes = [r["count"] for r in joined.groupBy("p").count().collect()]
        assert len(sizes) > 1 and max(sizes) < 2 * sorted(sizes)[len(sizes) // 2]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
