import random

from pyspark.sql import functions as F

from riverloom.functions.geometry import parts_area, ring_area
from riverloom.operators import rings

POLYGONS = "gid long, geom array<array<struct<x:double,y:double>>>, note string"


def box(x0, y0, x1, y1, turned=False):
    ring = [(x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0)]
    return [(float(x), float(y)) for x, y in (ring[::-1] if turned else ring)]


def signed(ring):
    return sum(a.x * b.y - b.x * a.y for a, b in zip(ring, ring[1:])) / 2


def test_islands_in_holes(spark):
    flat = [box(3, 3, 4, 4), box(0, 0, 10, 10, True), box(20, 0, 30, 10), box(1, 1, 9, 9), box(2, 2, 8, 8, True), box(5, 5, 6, 6, True)]
    df = spark.createDataFrame([(1, flat, "a"), (2, [box(0, 0, 1, 1)], None), (3, [], "b"), (4, None, "c"), (None, [box(0, 0, 2, 2)], "d")], POLYGONS)
    nested = {(r.gid, r.ring): (r.depth, r.within) for r in rings.nest_rings(df, "gid").collect()}
    assert nested[1, 1] == (0, None) and nested[1, 2] == (0, None) and nested[1, 3] == (1, 1)
    assert nested[1, 4] == (2, 3) and nested[1, 0] == (3, 4) and nested[1, 5] == (3, 4) and nested[2, 0] == (0, None)
    out = {r.gid: r for r in rings.to_multipolygons(df, "gid").withColumn("area", parts_area(F.col("parts"))).collect()}
    assert set(out) == {1, 2, None}
    parts = out[1].parts
    assert [len(p) for p in parts] == [2, 1, 3]
    assert all(signed(p[0]) > 0 and all(signed(h) < 0 for h in p[1:]) for p in parts)
    assert out[1].area == 100 - 64 + 36 - 1 - 1 + 100


def test_many_rings_beside_each_other(spark):
    rng = random.Random(3)
    flat = [box(0, 0, 1000, 1000)]
    for i in range(30):
        for j in range(30):
            flat.append(box(i * 33 + 2, j * 33 + 2, i * 33 + 30, j * 33 + 30, rng.random() < 0.5))
    rng.shuffle(flat)
    df = spark.createDataFrame([(1, flat, "a")], POLYGONS)
    (row,) = rings.to_multipolygons(df, "gid").withColumn("area", parts_area(F.col("parts"))).collect()
    assert len(row.parts) == 1 and len(row.parts[0]) == 901
    assert row.area == 1000**2 - 900 * 28 * 28


def test_far_coordinates(spark):
    df = spark.createDataFrame([([(7e5 + x, 6.6e6 + y) for x, y in box(0, 0, 0.5, 0.25)],)], "line array<struct<x:double,y:double>>")
    assert abs(df.select(ring_area(F.col("line"))).first()[0] - 0.125) < 1e-9
