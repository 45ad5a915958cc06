import pytest
from pyspark.sql import functions as F

from riverloom.operators.link import LINK, link_swaths, unlink_deleted
from riverloom.plans import marts
from riverloom.schemas import CONTINUITY_LABELS, LANDCOVER_LABELS
from riverloom.sources.tables import served


def wide(spark, labels, total, table_rows):
    """Rows (side, axis, measure, value, pc, gid); every label holds the same value."""
    df = spark.createDataFrame(
        table_rows,
        f"side string, axis long, measure_medial_axis long, value double, pc double, {LINK} long",
    )
    return df.select(
        "side",
        "axis",
        "measure_medial_axis",
        *[F.col("value").alias(c) for c in labels],
        F.col("value").alias(total),
        *[F.col("pc").alias(f"{c}_pc") for c in labels],
        LINK,
    )


def test_bank_sums_halve_percentages_of_one_bank(spark):
    df = wide(
        spark,
        LANDCOVER_LABELS,
        "sum_area",
        [("left", 1, 200, 2.0, 40.0, 9), ("right", 1, 200, None, None, 9), ("left", 1, 400, 3.0, 50.0, None)],
    )
    out = {r["measure_medial_axis"]: r for r in marts.full_side_area(df, LANDCOVER_LABELS).collect()}
    assert out[200]["forest"] == 2.0 and out[200]["forest_pc"] == 20.0
    # unlinked rows are a group of their own
    assert out[400][LINK] is None and out[400]["forest_pc"] == 25.0


def test_valley_bottom_sums(spark, rows):
    df = spark.createDataFrame(
        [(1, 200, "left", 2.0, 1.0, 9), (1, 200, "right", 3.0, None, 9)],
        f"axis long, measure_medial_axis long, side string, area double, width double, {LINK} long",
    )
    assert rows(marts.full_side_valley_bottom(df)) == [(9, 1, 200, 5.0, 1.0)]


def test_links_follow_the_swaths(spark, rows):
    metric = spark.createDataFrame(
        [(1.0, 200.0, "a"), (1.0, 400.0, "b"), (1.0, None, "c")],
        "axis double, measure_medial_axis double, v string",
    )
    swaths = spark.createDataFrame([(7, 1, 200), (8, 1, None)], "gid long, axis long, measure_medial_axis long")
    linked = link_swaths(metric, swaths)
    assert rows(linked, "v", LINK) == [("a", 7), ("b", None), ("c", None)]
    # linking again after the swath moved to another id
    moved = spark.createDataFrame([(70, 1, 200), (71, 1, 400)], swaths.schema)
    assert rows(link_swaths(linked, moved), "v", LINK) == [("a", 70), ("b", 71), ("c", None)]
    assert rows(unlink_deleted(linked, moved), "v", LINK) == [("a", None), ("b", None), ("c", None)]


@pytest.fixture
def tables(spark):
    swaths = spark.createDataFrame(
        [(7, 1, 200, 5.0, 3, 2), (8, 1, 400, 6.0, 3, None)],
        "gid long, axis long, measure_medial_axis long, measure_from_outlet double, strahler int, gid_region int",
    )
    continuity = wide(
        spark, CONTINUITY_LABELS, "sum_area", [("left", 1, 200, 2.0, 10.0, 7), ("right", 1, 200, 4.0, 20.0, 7)]
    )
    width = wide(
        spark, CONTINUITY_LABELS, "sum_width", [("left", 1, 200, 2.0, 10.0, 7), ("right", 1, 200, 4.0, 20.0, 7)]
    )
    landcover = wide(spark, LANDCOVER_LABELS, "sum_area", [("left", 1, 200, 1.0, 30.0, 7)])
    talweg = spark.createDataFrame(
        [(1, 200, 99.0, 0.1, 0.2, 7)],
        f"axis long, measure_medial_axis long, elevation_talweg double, slope_talweg double, slope_valley_bottom double, {LINK} long",
    )
    valley = spark.createDataFrame(
        [(1, 200, "left", 2.0, 1.0, 7)],
        f"axis long, measure_medial_axis long, side string, area double, width double, {LINK} long",
    )
    axis = spark.createDataFrame([(1, 1, "Big River", 2)], "gid long, axis long, toponyme string, gid_region int")
    return {
        "hydro_swaths": swaths,
        "hydro_axis": axis,
        "continuity_area": continuity,
        "continuity_width": width,
        "landcover_area": landcover,
        "talweg_metrics": talweg,
        "valley_bottom": valley,
    }


def test_network_metrics(spark, tables):
    out = marts.network_metrics(
        tables["hydro_swaths"],
        tables["hydro_axis"],
        tables["talweg_metrics"],
        marts.full_side_width(tables["continuity_width"], CONTINUITY_LABELS),
        marts.full_side_area(tables["landcover_area"], LANDCOVER_LABELS),
        marts.full_side_area(tables["continuity_area"], CONTINUITY_LABELS),
    )
    found = {r["fid"]: r for r in out.collect()}
    assert len(out.columns) == 47  # the geometry makes 48
    r = found[7]
    assert r["toponyme"] == "Big River" and r["talweg_elevation_min"] == 99.0
    assert r["idx_confinement"] == 2.0 and r["connected_corridor_width"] == 18.0
    # the percentage, not the area
    assert r["disconnected"] == 6.0 and r["disconnected_pc"] == 15.0
    assert found[8]["sum_area"] is None and found[8]["measure"] == 6.0


def test_serving_tables_are_rebuilt_in_order(spark, tables, tmp_path):
    paths = marts.build_marts(spark, tables, str(tmp_path))
    assert list(paths)[-1] == "network_metrics"
    assert spark.read.parquet(paths["network_metrics"]).count() == 2
    assert spark.read.parquet(paths["network_axis"]).columns == ["axis", "fid", "toponyme", "gid_region"]
    # a second run replaces the first
    marts.build_marts(spark, {**tables, "hydro_swaths": tables["hydro_swaths"].filter("gid = 7")}, str(tmp_path))
    assert served(spark, str(tmp_path), "network_metrics").count() == 1
    # one that fails changes nothing
    with pytest.raises(Exception):
        marts.build_marts(spark, {n: t for n, t in tables.items() if n != "hydro_axis"}, str(tmp_path))
    assert served(spark, str(tmp_path), "network_metrics").count() == 1


def test_axis_serving_table_with_lines(spark, tables, rows):
    lines = spark.createDataFrame(
        [(1, 20, [(1.0, 0.0), (2.0, 0.0)]), (1, 10, [(0.0, 0.0), (1.0, 0.0)])],
        "axis long, line_no long, geom array<struct<x:double,y:double>>",
    )
    out = marts.network_axis(tables["hydro_axis"], lines).filter("axis = 1").collect()
    assert [[[v["x"] for v in g] for g in r["geom"]] for r in out] == [[[0.0, 1.0], [1.0, 2.0]]]
