"""Physical plans: what is shuffled, pushed down and never done."""

import pytest
from pyspark.sql import functions as F

from riverloom import fixtures, registry
from riverloom.operators.pivot import pivot_area
from riverloom.operators.profiles import elevation_profile
from riverloom.plans import marts
from riverloom.schemas import CONTINUITY_LABELS, LANDCOVER_LABELS

SF = "/root/testdata/sf0.001"
registry.load()


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(df):
    return plan(df).count("Exchange hashpartitioning")


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("plans")
    for name in ("landcover", "profiles"):
        getattr(fixtures, name)(spark, SF).write.parquet(str(folder / name))
    return {n: spark.read.parquet(str(folder / n)) for n in ("landcover", "profiles")}


@pytest.mark.parametrize(
    "name",
    [
        "network_metrics",
        "landcover_full_side",
        "find_duplicates",
        "drop_duplicate_keys",
        "keep_longest",
        "replace_by_key",
        "points_in_regions",
        "lines_in_regions",
        "snap_to_lines",
        "axis_summary",
    ],
)
def test_joins_are_keyed(spark, no_broadcast, name):
    text = plan(registry.QUERIES[name](spark, SF))
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_duplicates_need_no_window(spark):
    for name in ("find_duplicates", "duplicate_summary", "drop_duplicate_keys", "keep_longest"):
        assert "Window" not in plan(registry.QUERIES[name](spark, SF))


def test_pivot_is_one_shuffle_and_reads_what_it_needs(stored):
    df = pivot_area(stored["landcover"], LANDCOVER_LABELS)
    assert shuffles(df) == 1
    assert "partial_max" in plan(df) and "width1" not in plan(df)


def test_profile_filter_reaches_the_scan(stored):
    text = plan(elevation_profile(stored["profiles"]))
    assert "EqualTo(quantile,50)" in text
    assert "ObjectHashAggregate" not in text and "SortAggregate" not in text


def test_network_metrics_shuffles_each_bank_sum_once(spark, no_broadcast, tmp_path):
    """Link, sums and wide join: a metric table is shuffled for its link and its sums only."""

    def full(labels, total):
        columns = [*labels, total, *[f"{c}_pc" for c in labels]]
        path = str(tmp_path / total / str(len(labels)))
        spark.range(10).select(
            F.col("id").alias("hydro_swaths_gid"),
            F.col("id").alias("axis"),
            F.col("id").alias("measure_medial_axis"),
            *[F.lit(1.0).alias(c) for c in columns],
        ).write.parquet(path)
        df = spark.read.parquet(path)
        return marts._full_side(df, labels, total)

    swaths = spark.range(10).selectExpr(
        "id AS gid", "id AS axis", "id AS measure_medial_axis", "1D AS measure_from_outlet", "1 AS strahler", "1 AS gid_region"
    )
    axis = spark.range(10).selectExpr("id AS axis", "'x' AS toponyme")
    talweg = spark.range(10).selectExpr(
        "id AS hydro_swaths_gid", "id AS axis", "id AS measure_medial_axis",
        "1D AS elevation_talweg", "1D AS slope_talweg", "1D AS slope_valley_bottom",
    )
    df = marts.network_metrics(
        swaths, axis, talweg,
        full(CONTINUITY_LABELS, "sum_width"), full(LANDCOVER_LABELS, "sum_area"), full(CONTINUITY_LABELS, "sum_area"),
    )
    # swaths by axis and by position, axis, talweg, and one for each of the three sums
    assert shuffles(df) == 7
    assert df.count() == 10


def test_polygon_table_is_broadcast_only_when_small(spark, monkeypatch):
    from riverloom.operators import containment

    query = registry.QUERIES["points_in_regions"]
    assert "BroadcastHashJoin" in plan(query(spark, SF))
    monkeypatch.setattr(containment, "BROADCAST_ROWS", 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" not in plan(query(spark, SF))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_exploded_sides_are_never_broadcast(spark, tmp_path):
    """Spark takes cells for as small as the segments they come from."""
    from riverloom.operators import containment, lines, network, pointers

    def table(name, select):
        spark.range(1).selectExpr(*select).write.parquet(str(tmp_path / name))
        return spark.read.parquet(str(tmp_path / name))

    segs = table("segs", ["1L AS axis", "1L AS line_id", "0 AS seg", "0D AS x1", "0D AS y1", "900D AS x2", "0D AS y2"])
    points = table("points", ["1L AS point_id", "1L AS axis", "5D AS x", "5D AS y"])
    shares = table("shares", ["1L AS piece", "1L AS fid", "2D AS length"])
    reaches = table("reaches", ["1L AS fid", "3 AS strahler"])
    links = table("links", ["1L AS k", "2L AS p", "2L AS last", "1D AS total", "1L AS low"])
    ahead = links.selectExpr("k AS p", "p AS p2", "last AS last2", "total AS total2", "low AS low2")
    for df in (
        containment.crossing_pairs(segs, segs.select("axis", "x1", "y1", "x2", "y2"), ["axis"], 10.0),
        network.snap_to_lines(points, segs, 100.0),
        lines.largest_overlap(shares, reaches),
        pointers._step(links, ahead),
    ):
        text = plan(df)
        assert "SortMergeJoin" in text and "BroadcastHashJoin" not in text


def test_pivot_link_and_bank_sums_share_a_shuffle(spark, stored):
    """The metric rows are shuffled once, and the swaths once."""
    from riverloom.operators.link import link_swaths
    from riverloom.plans.prepare import prepare_landcover_area

    swaths = spark.createDataFrame([(1, 1, 200)], "gid long, axis long, measure_medial_axis long")
    linked = link_swaths(prepare_landcover_area(stored["landcover"]).table, swaths)
    assert shuffles(marts.full_side_area(linked, LANDCOVER_LABELS)) == 2


def test_far_segments_make_few_cells(spark):
    """Cells grow with the segments: ten of 50 km pass a few each, not 500."""
    from unittest import mock

    from riverloom.operators import network

    segs = spark.createDataFrame(
        [(1, 1, i, i * 5e4, 0.0, (i + 1) * 5e4, 3e3, 5e4, 0.0) for i in range(10)],
        "line_id long, axis long, seg int, x1 double, y1 double, x2 double, y2 double, leng double, low double",
    )
    points = spark.createDataFrame([(1, 1, 130000.0, 900.0)], "point_id long, axis long, x double, y double")
    leaves = []
    kept = lambda df, name: leaves.append(df.count()) or df
    with mock.patch.object(network, "saved", kept):
        (found,) = network.locate_points(points, segs).collect()
    assert leaves[0] <= 60
    assert found.distance_axis == pytest.approx((1 - (30000 * 5e4 + 900 * 3e3) / (5e4**2 + 3e3**2)) * 5e4)
