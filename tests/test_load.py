"""The whole way from raw layers to serving tables in a store."""

import pytest
from pyspark.sql import functions as F

from riverloom.functions.geometry import line_length
from riverloom.plans import load, marts, prepare
from riverloom.schemas import CONTINUITY_LABELS, FOREIGN_KEYS, LANDCOVER_LABELS, TABLES, UNIQUE_KEYS
from riverloom.operators.quality import fk_violations, unique_violations

X, Y = 700000.0, 6600000.0


def at(points):
    return [(X + x, Y + y) for x, y in points]


def box(x0, y0, x1, y1):
    return at([(x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0)])


RINGS = "geom array<array<struct<x:double,y:double>>>"


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    s = load.Store(spark, str(tmp_path_factory.mktemp("store")), 4)
    load.create_tables(s)
    return s


def network(spark, shift=0):
    reaches = spark.createDataFrame(
        [(1, 5, 2, "Upper", at([(0, 0), (500, 0)])), (2, 5, 3, "Lower", at([(500, 0), (1000, 0)]))],
        "fid long, AXIS long, STRAHLER int, TOPONYME string, geom array<struct<x:double,y:double>>",
    )
    swaths = spark.createDataFrame(
        [(5, float(m), 2, 1.0, [box(a, -50, a + 300, 50)]) for m, a in ((200 + shift, 600), (400 + shift, 300))],
        "AXIS long, M double, VALUE int, DRAINAGE double, " + RINGS,
    )
    return prepare.prepare_swaths_and_axis(swaths, reaches, prepare.region_edges(regions(spark)))


def regions(spark):
    raw = spark.createDataFrame(
        [(3, "W", "Isere", "06", [box(-1000, -1000, 5000, 1000)])],
        "gid int, CdRegionHy string, LbRegionHy string, CdBH string, " + RINGS,
    )
    return prepare.prepare_regions(raw)


def labelled(spark, labels):
    return spark.createDataFrame(
        [(side, 5, m, label, 10000.0 * (i + 1), 2.0) for side in ("left", "right") for m in (200, 600) for i, label in enumerate(labels)],
        "side string, axis long, measure long, label string, area double, width1 double",
    )


def test_store_from_raw_to_serving(spark, store, rows):
    basins = spark.createDataFrame([(1.0, "06", "Rhone", [box(-9000, -9000, 9000, 9000)])], "gid double, CdBH string, LbBH string, " + RINGS)
    assert load.load_basins(store, prepare.prepare_basins(basins)) == (0, 1)
    assert load.load_regions(store, regions(spark)) == (0, 1)
    load.display(store, "region_hydrographique", ["W"])
    region = store.read("region_hydrographique").first()
    assert region["display"] is True and region["geom"][0][0]["y"] == pytest.approx(46.491, abs=1e-3)

    report = load.load_network(store, network(spark))
    assert report.counts["hydro_swaths"] == (0, 4) and report.swaths_deleted.count() == 0
    stored = store.read("hydro_swaths")
    assert rows(stored, "measure_medial_axis", "gid_region") == sorted([(None, 3), (None, 3), (200, 3), (400, 3)], key=repr)
    assert stored.first()["geom"][0]["x"] == pytest.approx(3.0, abs=0.02)
    # thinned to its two ends and merged over both reaches
    assert [len(r["geom"]) for r in store.read("hydro_axis_lines").collect()] == [2]

    landcover = prepare.prepare_landcover_area(labelled(spark, LANDCOVER_LABELS)).table
    continuity = labelled(spark, CONTINUITY_LABELS)
    assert load.load_metrics(store, "landcover_area", landcover) == (0, 4)
    load.load_metrics(store, "continuity_area", prepare.prepare_continuity_area(continuity).table)
    load.load_metrics(store, "continuity_width", prepare.prepare_continuity_width(continuity).table)
    valley = spark.createDataFrame([(0.0, "left", 1.0, 1.0, 1.0, 5, 200)], "swath double, side string, area double, width1 double, width2 double, axis long, measure long")
    load.load_metrics(store, "valley_bottom", prepare.prepare_valley_bottom(valley).table)
    talweg = spark.createDataFrame([(0.0, 5, 200, 9.5)], "swath double, axis long, measure long, elevation_talweg double")
    load.load_metrics(store, "talweg_metrics", prepare.prepare_talweg_metrics(talweg))
    assert load.load_metrics(store, "talweg_metrics", prepare.prepare_talweg_metrics(talweg)) == (1, 1)
    with pytest.raises(ValueError):
        load.load_metrics(store, "roe", talweg)

    obstacles = spark.createDataFrame([("R1", "T1", X + 300, Y + 30)], "CdObstEcou string, IdTronco_1 string, x double, y double")
    ids = spark.createDataFrame([("T1", 5)], "id_troncon string, axis long")
    tables = network(spark)
    prepared = prepare.prepare_obstacles(obstacles, prepare.region_edges(regions(spark)), ids, tables.hydro_axis, tables.lines)
    assert load.load_obstacles(store, prepared) == (0, 1)
    assert rows(store.read("roe").select("axis", F.round("distance_axis", 2))) == [(5, 700.0)]

    sites = spark.createDataFrame([("S1", "Gauge", 3.001, 46.5001)], "code_site string, libelle_site string, x double, y double")
    assert load.load_sites(store, prepare.prepare_sites(sites, prepare.region_edges(regions(spark)))) == (0, 1)
    assert store.read("hydro_sites").first()["x"] == pytest.approx(3.001, abs=1e-9)

    for name, keys in UNIQUE_KEYS.items():
        assert unique_violations(store.read(name), keys).count() == 0
    for child, column, parent, parent_column in FOREIGN_KEYS:
        assert fk_violations(store.read(child), store.read(parent), column, parent_column).count() == 0

    paths = marts.build_marts(spark, {n: store.read(n) for n in TABLES}, store.folder + "/served")
    served = spark.read.parquet(paths["network_metrics"])
    assert served.count() == 4 and len(served.columns) == 48
    linked = served.filter("measure_medial_axis = 200").first()
    assert linked["talweg_elevation_min"] == 9.5 and linked["forest"] == 8.0
    assert spark.read.parquet(paths["network_axis"]).count() == 1


def test_second_network_load_cascades(spark, store, rows):
    before = rows(store.read("landcover_area"), "measure_medial_axis", F.col("hydro_swaths_gid").isNotNull())
    assert before == [(200, True), (200, True), (600, False), (600, False)]
    report = load.load_network(store, network(spark, shift=200))
    assert rows(report.swaths_deleted) == [(5, 4)]
    assert report.counts["hydro_swaths"] == (4, 4) and report.obstacles_deleted == 1
    assert store.read("roe").count() == 0
    after = rows(store.read("landcover_area"), "measure_medial_axis", F.col("hydro_swaths_gid").isNotNull())
    assert after == [(200, False), (200, False), (600, True), (600, True)]
    assert store.read("hydro_swaths").agg(F.max(line_length(F.col("geom")))).first()[0] < 0.02
