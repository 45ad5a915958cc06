import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from riverloom.functions import geometry as g
from riverloom.functions.projection import reproject
from riverloom.functions.simplify import kept_vertices, simplify_lines
from riverloom.operators import containment
from riverloom.operators.grid import segment_cells

LINE = "id int, geom array<struct<x:double,y:double>>"


def line(spark, *lines):
    return spark.createDataFrame([(i, [(float(x), float(y)) for x, y in v]) for i, v in enumerate(lines)], LINE)


def vertices(df):
    return [[(p["x"], p["y"]) for p in r["geom"]] for r in df.orderBy("id").collect()]


def test_length_of_short_and_long_lines(spark):
    df = line(spark, [(0, 0), (3, 4), (3, 10)], [(1, 1)], [])
    assert [r[0] for r in df.orderBy("id").select(g.line_length(F.col("geom"))).collect()] == [11.0, 0.0, 0.0]


def test_cutting_inside_a_line(spark):
    df = line(spark, [(0, 0), (10, 0), (20, 0)])
    cut = df.withColumn("geom", g.cut_line(F.col("geom"), F.lit(0.5), F.lit(1.25)))
    assert vertices(cut) == [[(5, 0), (10, 0), (12.5, 0)]]
    whole = df.withColumn("geom", g.cut_line(F.col("geom"), F.lit(0.0), F.lit(2.0)))
    assert vertices(whole) == vertices(df)
    at_vertex = df.withColumn("geom", g.cut_line(F.col("geom"), F.lit(1.0), F.lit(2.0)))
    assert vertices(at_vertex) == [[(10, 0), (20, 0)]]


def test_snapping_drops_repeats(spark):
    df = line(spark, [(0.1, 0), (0.2, 0.1), (0.9, 0), (2.2, 0)])
    snapped = df.withColumn("geom", g.snap_grid(F.col("geom"), 1.0))
    assert vertices(snapped) == [[(0, 0), (1, 0), (2, 0)]]


def test_known_point_and_round_trip(spark):
    pts = [(3.0, 46.5), (-5.0, 41.0), (9.0, 51.0), (2.35, 48.85), (-1.5, 47.2)]
    df = spark.createDataFrame([(x, y, x, y) for x, y in pts], "x double, y double, lon double, lat double")
    metres = reproject(df, ["x", "y"], 4326, 2154)
    first = metres.filter("lon = 3").first()
    assert (first["x"], first["y"]) == pytest.approx((700000, 6600000), abs=1e-8)
    assert metres.schema["x"].metadata["srid"] == 2154
    for r in reproject(metres, ["x", "y"], 2154, 4326).collect():
        assert (r["x"], r["y"]) == pytest.approx((r["lon"], r["lat"]), abs=1e-12)
    there = reproject(reproject(metres, ["x", "y"], 2154, 4326), ["x", "y"], 4326, 2154)
    for a, b in zip(metres.orderBy("lon").collect(), there.orderBy("lon").collect()):
        assert math.hypot(a["x"] - b["x"], a["y"] - b["y"]) < 1e-3
    with pytest.raises(ValueError, match="tagged"):
        reproject(metres, ["x", "y"], 4326, 2154)


def test_rings_are_reprojected(spark):
    df = spark.createDataFrame([([[(3.0, 46.5)], [(3.0, 46.5)]],)], "geom array<array<struct<x:double,y:double>>>")
    ring = reproject(df, ["geom"], 4326, 2154).first()["geom"]
    assert [round(p["y"]) for r in ring for p in r] == [6600000, 6600000]


def test_simplification_keeps_ends_and_tolerance(spark):
    rng = np.random.default_rng(3)
    x = np.arange(200) * 10.0
    y = np.cumsum(rng.normal(0, 8, 200))
    kept = kept_vertices(x, y, 30.0)
    assert kept[0] == 0 and kept[-1] == 199 and len(kept) < 100
    for a, b in zip(kept, kept[1:]):
        for i in range(a + 1, b):
            cross = abs((x[b] - x[a]) * (y[i] - y[a]) - (y[b] - y[a]) * (x[i] - x[a]))
            assert cross / math.hypot(x[b] - x[a], y[b] - y[a]) <= 30.0 + 1e-9
    df = line(spark, [(0, 0), (100, 50), (300, 0), (300, 500)], [(0, 0), (1, 1)])
    assert vertices(simplify_lines(df, 200.0)) == [[(0, 0), (300, 0), (300, 500)], [(0, 0), (1, 1)]]


def test_cells_cover_a_segment(spark):
    rng = random.Random(5)
    rows = [(i, *[rng.uniform(0, 50) for _ in range(4)]) for i in range(200)]
    df = spark.createDataFrame(rows, "id int, x1 double, y1 double, x2 double, y2 double")
    from riverloom.operators.grid import SHIFT

    cells = {}
    for r in segment_cells(df, 7.0).collect():
        cells.setdefault(r["id"], set()).add((r["cx"], r["cy"]))
    for i, x1, y1, x2, y2 in rows:
        for k in range(101):
            px, py = x1 + (x2 - x1) * k / 100, y1 + (y2 - y1) * k / 100
            assert (math.floor(px / 7 - SHIFT), math.floor(py / 7 - SHIFT)) in cells[i]


def ring_rows(seed, polygons):
    rng = random.Random(seed)
    rows = []
    for gid in range(polygons):
        n, cx, cy, size = rng.randint(3, 40), rng.uniform(0, 100), rng.uniform(0, 100), rng.uniform(2, 40)
        angles = sorted(rng.uniform(0, 2 * math.pi) for _ in range(n))
        ring = [(cx + size * rng.uniform(0.2, 1) * math.cos(a), cy + size * rng.uniform(0.2, 1) * math.sin(a)) for a in angles]
        rows += [(gid, i, *ring[i], *ring[(i + 1) % n]) for i in range(n)]
    return rows


def contains(edges, x, y):
    odd = False
    for _, _, x1, y1, x2, y2 in edges:
        if (y1 <= y) != (y2 <= y) and x < x1 + (y - y1) / (y2 - y1) * (x2 - x1):
            odd = not odd
    return odd


@pytest.mark.parametrize("cell", [None, 3.0, 40.0])
def test_containment_equals_brute_force(spark, cell):
    rows = ring_rows(11, 15)
    rng = random.Random(2)
    pts = [(i, rng.uniform(-5, 105), rng.uniform(-5, 105)) for i in range(1500)]
    want = {
        (i, gid) for i, x, y in pts for gid in range(15) if contains([r for r in rows if r[0] == gid], x, y)
    }
    edges = spark.createDataFrame(rows, "gid int, seg int, x1 double, y1 double, x2 double, y2 double")
    points = spark.createDataFrame(pts, "id int, x double, y double")
    got = containment.points_in_polygons(points, edges, ["gid"], cell=cell).select("id", "gid").collect()
    assert len(got) == len(want) and {tuple(r) for r in got} == want


def test_containment_with_shared_key(spark, monkeypatch, rows):
    square = [(0, 0, 10, 0), (10, 0, 10, 10), (10, 10, 0, 10), (0, 10, 0, 0)]
    edges = spark.createDataFrame(
        [(axis, m, *map(float, e)) for axis, m in [(1, 200), (2, 200), (2, 400)] for e in square],
        "axis long, m long, x1 double, y1 double, x2 double, y2 double",
    )
    points = spark.createDataFrame([(1, 5.0, 5.0), (2, 5.0, 5.0), (3, 5.0, 5.0), (1, 15.0, 5.0)], "axis long, x double, y double")
    monkeypatch.setattr(containment, "BROADCAST_ROWS", 0)
    out = containment.points_in_polygons(points, edges, ["axis", "m"], by=["axis"])
    assert rows(out, "axis", "m") == [(1, 200), (2, 200), (2, 400)]


def test_hole_and_parts(spark, rows):
    def ring(size, at):
        c = [(at, at), (at + size, at), (at + size, at + size), (at, at + size), (at, at)]
        return [(float(x), float(y)) for x, y in c]

    polygons = spark.createDataFrame(
        [(1, [ring(10, 0), ring(4, 3), ring(5, 20)])], "gid int, geom array<array<struct<x:double,y:double>>>"
    )
    points = spark.createDataFrame([(1, 1.0, 1.0), (2, 5.0, 5.0), (3, 22.0, 22.0), (4, 15.0, 15.0)], "id int, x double, y double")
    out = containment.points_in_polygons(points, containment.ring_edges(polygons, ["gid"]), ["gid"])
    assert rows(out, "id") == [(1,), (3,)]


def test_line_containment(spark, rows):
    # an L: the square of 20 without its upper right quarter
    corner = [(0, 0), (20, 0), (20, 10), (10, 10), (10, 20), (0, 20), (0, 0)]
    v = spark.createDataFrame([(1, i, float(x), float(y)) for i, (x, y) in enumerate(corner)], "gid int, seq int, x double, y double")
    lines = line(
        spark,
        [(1, 1), (5, 5)],  # inside
        [(1, 1), (30, 1)],  # leaves
        [(5, 15), (15, 5)],  # both ends inside, touches the inner corner
        [(5, 18), (18, 5)],  # both ends inside, crosses the notch
        [(0, 5), (5, 5)],  # starts on the border
        [(10, 15), (15, 10)],  # border to border across the notch
        [(30, 30), (40, 40)],  # far away
    )
    out = containment.lines_in_polygons(lines, containment.vertex_edges(v, ["gid"]), "id", "gid")
    assert rows(out, "id", "gid") == [(0, 1), (1, None), (2, 1), (3, None), (4, 1), (5, None), (6, None)]


def test_crowded_cells_and_repeated_rows(spark):
    """A polygon with 6,000 edges in one cell, equal points, and a closed line."""
    n = 6000
    ring = [(math.cos(2 * math.pi * k / n), math.sin(2 * math.pi * k / n)) for k in range(n)]
    rows = [(3, *ring[k], *ring[(k + 1) % n]) for k in range(n)]
    edges = spark.createDataFrame(rows, "gid int, x1 double, y1 double, x2 double, y2 double")
    points = spark.createDataFrame([(1, 0.1, 0.1), (1, 0.1, 0.1), (2, 0.5, -0.2), (3, 1.5, 0.0)], "id int, x double, y double")
    got = containment.points_in_polygons(points, edges, ["gid"], cell=100.0).collect()
    assert sorted(r.id for r in got) == [1, 1, 2]
    line = [(0.0, 0.0), (0.5, 0.0), (0.5, 0.5), (0.0, 0.0)]
    lines = spark.createDataFrame([(1, line), (2, [(0.0, 0.0), (2.0, 0.0)])], "fid int, geom array<struct<x:double,y:double>>")
    out = containment.lines_in_polygons(lines, edges, "fid", "gid", cell=100.0)
    assert {r.fid: r.gid for r in out.collect()} == {1: 3, 2: None}


def test_cover_goes_down_only_where_cells_are(spark):
    """The cells of a plain grid, of those that are asked for; few rows for a long line far away."""
    import random

    from riverloom.operators.grid import cover_cells, segment_cells

    rng = random.Random(6)
    segs = [(i, *(rng.uniform(-300, 300) for _ in range(4))) for i in range(60)]
    segs += [(100, -250.0, 7.0, 250.0, 7.0), (101, 3.0, -250.0, 3.0, 250.0), (102, 5.0, 5.0, 5.0, 5.0)]
    df = spark.createDataFrame(segs, "id long, x1 double, y1 double, x2 double, y2 double")
    cells = [(rng.randrange(-300, 300), rng.randrange(-300, 300)) for _ in range(4000)]
    leaves = spark.createDataFrame(sorted(set(cells)), "cx long, cy long").cache()
    plain = segment_cells(df, 1.0).join(leaves, ["cx", "cy"], "left_semi")
    key = ["id", "cx", "cy"]
    want = sorted(tuple(r) for r in plain.select(*key).collect())
    assert want and sorted(tuple(r) for r in cover_cells(df, leaves, 1.0).select(*key).collect()) == want
    long = spark.createDataFrame([(1, 0.0, 1e5, 1e5, 1e5)], "id long, x1 double, y1 double, x2 double, y2 double")
    assert segment_cells(long, 1.0).count() > 100_000
    assert cover_cells(long, leaves, 1.0).count() == 0
