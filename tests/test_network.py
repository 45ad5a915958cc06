import math
import random

import pytest
from pyspark.sql import functions as F

from riverloom.functions.geometry import line_length
from riverloom.operators import lines, network
from riverloom.operators.pointers import follow_pointers
from riverloom.plans import prepare
from riverloom.session import saved

REACH = "fid long, axis long, strahler int, toponyme string, geom array<struct<x:double,y:double>>"
SWATH = "AXIS long, M double, VALUE int, DRAINAGE double, geom array<array<struct<x:double,y:double>>>"


def reach(fid, axis, *points, strahler=1, name=None):
    return (fid, axis, strahler, name, [(float(x), float(y)) for x, y in points])


def strip(axis, m, x0, x1, value=2, y0=-50, y1=50):
    ring = [(x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0)]
    return (axis, float(m), value, 1.5, [[(float(x), float(y)) for x, y in ring]])


def swath_rows(df):
    return df.select("AXIS", "M", "DRAINAGE", "geom").toDF("axis", "m", "drainage", "geom")


def test_pointers_on_random_trees(spark):
    rng = random.Random(8)
    parent = {i: (rng.randrange(max(0, i - 3), i) if i else None) for i in range(400)}
    weight = {i: rng.randint(1, 9) for i in parent}
    df = spark.createDataFrame([(i, p, float(weight[i])) for i, p in parent.items()], "k long, p long, w double")
    for r in follow_pointers(df, "k", "p", "w").collect():
        node, total = r["k"], 0
        while parent[node] is not None:
            total += weight[node]
            node = parent[node]
        assert (r["last"], r["total"]) == (node, total)


def test_pointer_cycles(spark, rows):
    df = spark.createDataFrame([(1, 2, 1.0), (2, 3, 1.0), (3, 1, 1.0), (4, None, 1.0)], "k long, p long, w double")
    with pytest.raises(ValueError, match="cycle"):
        follow_pointers(df, "k", "p", "w")
    out = follow_pointers(df, "k", "p", "w", cycles="break")
    assert rows(out) == [(1, 1, 0.0), (2, 1, 2.0), (3, 1, 1.0), (4, 4, 0.0)]


def test_rings_are_left_alone_early(spark, tmp_path, monkeypatch):
    """Rings of three and of six, rows that run into them, and a path, in a few writes."""
    from riverloom.operators import pointers

    written = []
    monkeypatch.setattr(pointers, "saved", lambda df, name: written.append(name) or saved(df, name))
    step = {0: 4, 3: -2, 9: -5}  # rows that end in 0 run into a ring
    rings = [(i, i + step.get(i % 10, 1)) for i in range(1, 2990)]
    ends = [(-1, 4), (-2, -1), (-3, -4), (-4, None)]
    df = spark.createDataFrame([(k, to, 1.0) for k, to in rings + ends], "k long, p long, w double")
    out = {r["k"]: (r["last"], r["total"]) for r in pointers.follow_pointers(df, "k", "p", "w", cycles="null").collect()}
    assert len(out) == len(rings + ends) and len(written) <= 5
    assert {k: v for k, v in out.items() if v != (None, None)} == expected_ends(dict(rings + ends))


def expected_ends(to):
    found = {}
    for k in to:
        at, n, seen = k, 0, set()
        while to.get(at) is not None and at not in seen:
            seen.add(at)
            at, n = to[at], n + 1
        if at not in seen:
            found[k] = (at, float(n))
    return found


def test_measure_forks_and_axes(spark, rows):
    edges = spark.createDataFrame(
        [(1, 1, "a", "b", 5.0), (2, 1, "b", "c", 7.0), (3, 1, "b", "d", 9.0), (4, 2, "x", "a", 1.0), (5, 1, "s", "s", 1.0)],
        "edge_id long, axis long, node_a string, node_b string, length double",
    )
    out = network.measure_from_outlet(network.drop_degenerate(edges))
    # the fork goes on with the lowest id; axis 2 ends at the node where axis 1 begins
    assert rows(out, "edge_id", "measure") == [(1, 7.0), (2, 0.0), (3, 0.0), (4, 0.0)]


def test_split_merges_across_reaches(spark, rows):
    reaches = spark.createDataFrame(
        [reach(1, 1, (0, 0), (100, 0), (250, 0)), reach(2, 1, (250, 0), (400, 0)), reach(3, 1, (400, 0), (500, 0))], REACH
    )
    swaths = swath_rows(spark.createDataFrame([strip(1, 200, 200, 300), strip(1, 400, 300, 400), strip(2, 200, 0, 500)], SWATH))
    split = lines.split_lines(reaches, swaths)
    got = split.pieces.select("axis", "m", "drainage", F.round(line_length(F.col("geom")), 3))
    # a border runs through the joint at 400, none through that at 250
    assert rows(got) == sorted([(1, None, None, 200.0), (1, 200.0, 1.5, 100.0), (1, 400.0, 1.5, 100.0), (1, None, None, 100.0)], key=repr)
    middle = split.pieces.filter("m = 200").first()["geom"]
    assert [p["x"] for p in middle] == pytest.approx([200, 250, 300], abs=1e-6)
    assert split.shares.agg(F.sum("length")).first()[0] == pytest.approx(500, abs=1e-6)


def test_split_of_many_members(spark):
    n = 2300
    reaches = spark.createDataFrame([reach(i, 1, (i * 10, 0), (i * 10 + 10, 0)) for i in range(n)], REACH)
    swaths = swath_rows(spark.createDataFrame([strip(2, 200, 0, 10)], SWATH))
    whole = lines.split_lines(reaches, swaths).pieces.collect()
    assert len(whole) == 1 and len(whole[0]["geom"]) == n + 1
    assert [whole[0]["geom"][i]["x"] for i in (0, -1)] == [0, 10 * n]


def test_split_lengths_sum_up(spark):
    rng = random.Random(4)
    reaches, swaths = [], []
    for axis in range(5):
        x, y, points = 0.0, rng.uniform(-5, 5), []
        while x < 1000:
            points.append((x, y))
            x, y = x + rng.uniform(1, 20), y + rng.uniform(-3, 3)
        cuts = sorted(rng.sample(range(1, len(points) - 1), 3))
        for k, (a, b) in enumerate(zip([0, *cuts], [*cuts, len(points) - 1])):
            reaches.append(reach(axis * 10 + k, axis, *points[a : b + 1]))
        swaths += [strip(axis, m, m + 0.37, m + 40.41, y0=-500, y1=500) for m in range(0, 1000, 60)]
    frame = spark.createDataFrame(reaches, REACH)
    split = lines.split_lines(frame, swath_rows(spark.createDataFrame(swaths, SWATH)))
    total = frame.agg(F.sum(line_length(F.col("geom")))).first()[0]
    assert split.pieces.agg(F.sum(line_length(F.col("geom")))).first()[0] == pytest.approx(total, abs=1e-6)
    assert split.shares.agg(F.sum("length")).first()[0] == pytest.approx(total, abs=1e-6)
    labelled = split.pieces.filter("m is not null").groupBy("axis", "m").count().collect()
    assert len(labelled) == 5 * 17 and {r["count"] for r in labelled} == {1}


def test_merge_lines_keeps_forks_apart_and_opens_rings(spark, rows):
    df = spark.createDataFrame(
        [
            reach(1, 1, (0, 0), (1, 0)), reach(2, 1, (1.000000001, 0), (2, 0)),
            reach(3, 2, (0, 0), (1, 0)), reach(4, 2, (1, 0), (2, 0)), reach(5, 2, (1, 0), (1, 5)),
            reach(6, 3, (0, 0), (1, 0)), reach(7, 3, (1, 0), (1, 1)), reach(8, 3, (1, 1), (0, 0)),
        ],
        REACH,
    )
    merged = lines.merge_lines(df, "fid")
    assert rows(merged.select("axis", F.size("geom"))) == [(1, 3), (2, 2), (2, 2), (2, 2), (3, 4)]


def test_snap_and_locate(spark, rows):
    segs = network.measured_segments(
        spark.createDataFrame([(1, 1, 50.0, [(0.0, 0.0), (1000.0, 0.0), (1000.0, 500.0)]), (2, 2, 0.0, [(0.0, 90.0), (1000.0, 90.0)])],
                              "line_id long, axis long, measure double, geom array<struct<x:double,y:double>>"),
        "line_id",
    )
    assert rows(segs, "line_id", "seg", "low") == [(1, 0, 550.0), (1, 1, 50.0), (2, 0, 0.0)]
    pts = spark.createDataFrame(
        [(1, 1, 300.0, 20.0), (2, 1, 300.0, 80.0), (3, 1, 300.0, 500.0), (4, 2, 400.0, 189.0), (5, 9, 10.0, 0.0)],
        "point_id long, axis long, x double, y double",
    )
    snapped = network.snap_to_lines(pts, segs, 100.0)
    assert rows(snapped, "point_id", "x", "y") == [(1, 300.0, 0.0), (2, 300.0, 90.0), (4, 400.0, 90.0), (5, 10.0, 0.0)]
    located = network.locate_points(snapped, segs, 10.0)
    # point 2 was moved onto the other axis but is placed on its own; axis 9 is unknown
    assert rows(located, "point_id", "distance_axis") == sorted([(1, 1250.0), (2, 1250.0), (4, 600.0), (5, None)], key=repr)
    assert located.columns.count("distance_axis") == 1


def region_rows(spark):
    v = [(0, -1000), (5000, -1000), (5000, 1000), (0, 1000), (0, -1000)]
    ring = [[(float(x), float(y)) for x, y in v]]
    return spark.createDataFrame([(4, "W", ring)], "gid int, CdRegionHy string, geom array<array<struct<x:double,y:double>>>")


@pytest.fixture(scope="module")
def prepared(spark):
    reaches = spark.createDataFrame(
        [reach(1, 1, (100, 0), (450, 0), strahler=2, name="Upper"), reach(2, 1, (450, 0), (1000, 0), strahler=3, name="Lower"),
         reach(3, 2, (100, 500), (6000, 500), strahler=1)],
        REACH,
    )
    swaths = spark.createDataFrame(
        [strip(1, 400, 200, 500), strip(1, 200, 500, 900), strip(1, 0, 900, 950, value=1),
         strip(1, 600, 100, 120), strip(1, 600, 120, 140), strip(2, 200, 300, 400, y0=450, y1=550)],
        SWATH,
    )
    regions = prepare.prepare_regions(region_rows(spark))
    assert regions.columns == ["gid", "cdregionhy", "geom"]
    return prepare.prepare_swaths_and_axis(swaths, reaches, prepare.region_edges(regions))


def test_prepared_network(prepared, rows):
    got = prepared.hydro_swaths.select(
        "axis", "measure_medial_axis", F.round("measure_from_outlet", 3), F.round("length", 3), "strahler", "gid_region"
    )
    # swath 0 is not valid and the two copies of 600 cancel each other; axis 2 leaves the region
    assert rows(got) == sorted(
        [(1, None, 800.0, 100.0, 2, 4), (1, 400, 500.0, 300.0, 2, 4), (1, 200, 100.0, 400.0, 3, 4), (1, None, 0.0, 100.0, 3, 4),
         (2, None, 5700.0, 200.0, 1, 4), (2, 200, 5600.0, 100.0, 1, 4), (2, None, 0.0, 5600.0, 1, None)],
        key=repr,
    )
    assert rows(prepared.hydro_axis, "axis", "toponyme", F.round("length", 3), "gid_region") == sorted(
        [(1, "Upper", 900.0, 4), (2, None, 5900.0, 4)], key=repr)
    assert rows(prepared.lines.select("axis", F.size("geom"))) == [(1, 6), (2, 4)]


def test_prepared_obstacles(spark, prepared, rows):
    obstacles = spark.createDataFrame(
        [("R1", "T1", 300.0, 30.0), ("R2", "T1", 300.0, 300.0), ("R3", "T9", 300.0, 0.0), ("R4", None, 300.0, 0.0),
         ("R5", "T2", -50.0, 500.0), ("R6", "T3", 400.0, 0.0)],
        "CdObstEcou string, IdTronco_1 string, x double, y double",
    )
    reach_ids = spark.createDataFrame([("T1", 1), ("T2", 2), ("T3", 77), ("T8", None)], "id_troncon string, axis long")
    edges = prepare.region_edges(prepare.prepare_regions(region_rows(spark)))
    out = prepare.prepare_obstacles(obstacles, edges, reach_ids, prepared.hydro_axis, prepared.lines)
    # too far; unknown reach; no reach; outside the regions; unknown axis
    assert rows(out, "cdobstecou", "axis", "gid_region", "x", "y", "distance_axis") == [("R1", 1, 4, 300.0, 0.0, 700.0)]
    assert "gid" in out.columns


def test_prepared_sites_and_basins(spark, rows):
    sites = spark.createDataFrame([("A", "a", 300.0, 0.0), ("B", "b", -5.0, 0.0), (None, "c", 1.0, 1.0)],
                                  "code_site string, libelle_site string, x double, y double")
    edges = prepare.region_edges(prepare.prepare_regions(region_rows(spark)))
    out = prepare.prepare_sites(sites, edges, srid=2154)
    assert rows(out) == [("A", "https://www.hydro.eaufrance.fr/sitehydro/A/fiche", "a", 4, 300.0, 0.0)]
    basins = prepare.prepare_basins(region_rows(spark))
    assert basins.columns == ["cdregionhy", "geom"] and basins.schema["geom"].metadata["srid"] == 2154


def test_reaches_into_a_cycle_have_no_measure(spark):
    rows = [(1, 1, 0, 1), (2, 1, 1, 2), (3, 2, 0, 1), (4, 2, 1, 0), (5, 2, 7, 0)]
    edges = spark.createDataFrame(rows, "edge_id long, axis long, a int, b int").selectExpr(
        "edge_id", "axis", "struct(a AS qx, 0 AS qy) AS node_a", "struct(b AS qx, 0 AS qy) AS node_b", "10D AS length"
    )
    out = {r.edge_id: r.measure for r in network.measure_from_outlet(edges).collect()}
    assert out == {1: 10.0, 2: 0.0, 3: None, 4: None, 5: None}


def test_network_beyond_the_plain_case(spark):
    """An axis without swaths, a swath crossed twice alike, a piece of many reaches, a cycle."""
    reaches = [reach(1, 1, (0, 0), (100, 0)), reach(2, 2, (0, 500), (100, 500))]
    # axis 3 runs through its swath, back, and through it again
    reaches.append(reach(3, 3, (0, 0), (64, 0), (64, 32), (0, 32)))
    reaches += [reach(1000 + i, 4, (i, 900), (i + 1, 900)) for i in range(1500)]
    # two swaths cut the ring of axis 5 into halves that run into each other
    reaches += [reach(5, 5, (0, 0), (100, 0), (100, 30)), reach(6, 5, (100, 30), (0, 30), (0, 0))]
    swaths = swath_rows(
        spark.createDataFrame(
            [strip(1, 200, 0, 100), strip(3, 200, 16, 48, y0=-8, y1=40), strip(4, 200, -1, 1501, y0=890, y1=910), strip(5, 200, -10, 50), strip(5, 400, 50, 110)],
            SWATH,
        )
    ).withColumn("value", F.lit(2))
    regions = spark.createDataFrame([], "gid_region int, x1 double, y1 double, x2 double, y2 double")
    frame = spark.createDataFrame(reaches, REACH).withColumns(
        {"strahler": F.lit(1), "toponyme": F.lit("x"), "gid_region": F.lit(1)}
    )
    built = prepare.prepare_swaths_and_axis(swaths, frame, regions)
    out = built.hydro_swaths.select("gid", "axis", "measure_medial_axis", "measure_from_outlet", F.round("length", 3).alias("n")).collect()
    assert {r.axis for r in out} == {1, 3, 4, 5}
    assert len({r.gid for r in out}) == len(out)
    tied = [r for r in out if r.axis == 3 and r.measure_medial_axis == 200]
    assert [r.n for r in tied] == [32.0, 32.0]
    assert [(r.measure_medial_axis, r.n) for r in out if r.axis == 4] == [(200, 1500.0)]
    assert [r.measure_from_outlet for r in out if r.axis == 5] == [None, None]
    assert all(r.measure_from_outlet is not None for r in out if r.axis != 5)


def test_locating_far_odd_and_repeated_points(spark):
    rng = random.Random(8)
    segs = []
    for line in (1, 2):
        x = y = low = 0.0
        for k in range(60, 0, -1):  # upstream
            ux, uy = x + rng.uniform(-40, 60), y + rng.uniform(-40, 60)
            leng = math.hypot(ux - x, uy - y)
            segs.append((line, line, k, ux, uy, x, y, leng, low))
            x, y, low = ux, uy, low + leng
    schema = "line_id long, axis long, seg int, x1 double, y1 double, x2 double, y2 double, leng double, low double"
    pts = [(i, 1 + i % 2, rng.uniform(-500, 3000), rng.uniform(-500, 3000)) for i in range(120)]
    pts += [(200, 1, 9e6, -4e6), (201, 2, -1e5, 3e4), (202, 1, float("nan"), 0.0), (203, 1, None, 0.0), (204, 9, 1.0, 1.0), (205, 1, float("inf"), 1.0)]
    pts += [pts[0]] * 3
    points = spark.createDataFrame(pts, "id long, axis long, x double, y double")
    got = network.locate_points(points, spark.createDataFrame(segs, schema), 10.0).collect()
    assert len(got) == len(pts)

    def plain(axis, px, py):
        best = None
        for line, a, k, x1, y1, x2, y2, leng, low in segs:
            if a == axis:
                f = max(0.0, min(1.0, ((px - x1) * (x2 - x1) + (py - y1) * (y2 - y1)) / leng**2))
                d = math.hypot(px - x1 - f * (x2 - x1), py - y1 - f * (y2 - y1))
                best = min(best or (math.inf,), (d, low + (1 - f) * leng))
        return best[1]

    for r in got:
        if r.id >= 202:
            assert r.distance_axis is None
        else:
            assert r.distance_axis == pytest.approx(plain(r.axis, r.x, r.y), abs=1e-4)


def test_snapping_to_vertices_first(spark):
    segs = spark.createDataFrame(
        [(1, 0, 0.0, 0.0, 100.0, 0.0), (1, 1, 100.0, 0.0, 100.0, 300.0)],
        "line_id long, seg int, x1 double, y1 double, x2 double, y2 double",
    )
    pts = [(1, 95.0, 10.0), (2, 50.0, 8.0), (3, 50.0, 25.0), (4, 95.0, 10.0), (5, float("nan"), 1.0)]
    points = spark.createDataFrame(pts, "id long, x double, y double")
    first = network.snap_to_lines(points, segs, 20.0, prefer_vertices=True)
    assert rows_of(first) == [(1, 100.0, 0.0), (2, 50.0, 0.0), (4, 100.0, 0.0)]
    assert rows_of(network.snap_to_lines(points, segs, 20.0)) == [(1, 100.0, 10.0), (2, 50.0, 0.0), (4, 100.0, 10.0)]


def rows_of(df):
    return sorted((r.id, r.x, r.y) for r in df.collect())


def test_merging_whatever_way_lines_are_drawn(spark):
    rng = random.Random(12)
    rows = [reach(1, 1, (0, 0), (10, 0)), reach(2, 1, (20, 0), (10, 0))]
    for axis in (2, 3, 4):  # chains of 20 lines, some turned round; axis 4 is a ring
        n = 20
        at = [(100.0 * math.cos(2 * math.pi * i / n), 100.0 * math.sin(2 * math.pi * i / n)) if axis == 4 else (i * 7.0, axis * 50.0 + i % 3) for i in range(n + 1)]
        at[n] = at[0] if axis == 4 else at[n]
        for i in range(n):
            ends = [at[i], at[i + 1]]
            rows.append(reach(100 * axis + i, axis, *(ends if axis == 3 or rng.random() < 0.7 else ends[::-1])))
    # a fork is no joint
    rows += [reach(900, 9, (0, 0), (1, 0)), reach(901, 9, (1, 0), (2, 1)), reach(902, 9, (2, -1), (1, 0))]
    merged = lines.merge_lines(spark.createDataFrame(rows, REACH), "fid").collect()
    sizes = {a: sorted(len(r.geom) for r in merged if r.axis == a) for a in (1, 2, 3, 4, 9)}
    assert sizes == {1: [3], 2: [21], 3: [21], 4: [21], 9: [2, 2, 2]}
    assert [v["x"] for r in merged if r.axis == 3 for v in r.geom] == pytest.approx([7.0 * i for i in range(21)], abs=1e-4)
    swaths = swath_rows(spark.createDataFrame([strip(1, 200, 5, 15)], SWATH))
    pieces = lines.split_lines(spark.createDataFrame(rows[:2], REACH), swaths).pieces.collect()
    assert sorted((r.m or 0, round(abs(r.geom[-1]["x"] - r.geom[0]["x"]), 6)) for r in pieces) == [(0, 5.0), (0, 5.0), (200, 10.0)]
