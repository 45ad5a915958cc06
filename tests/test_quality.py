import pytest
from pyspark.sql import functions as F

from riverloom.operators import quality
from riverloom.operators.joins import keyed_join
from riverloom.operators.lines import keep_longest
from riverloom.plans import prepare
from riverloom.schemas import TABLES, struct

POSITIONS = "axis long, measure long, v int"


@pytest.fixture
def positions(spark):
    return spark.createDataFrame(
        [(1, 10, 1), (1, 10, 2), (1, 10, 3), (1, 20, 4), (1, None, 5), (1, None, 6), (None, 10, 7), (None, 10, 8)],
        POSITIONS,
    )


def test_duplicates_need_complete_keys(positions, rows):
    found = quality.find_duplicates(positions)
    assert rows(found.rows, "v") == [(1,), (2,), (3,)]
    assert rows(found.summary) == [(1, 2)]


def test_removal_leaves_no_copy_and_keeps_nulls(positions, rows):
    found = quality.find_duplicates(positions)
    kept = quality.drop_duplicate_keys(positions, found.rows)
    assert rows(kept, "v") == [(4,), (5,), (6,), (7,), (8,)]
    assert rows(quality.without_duplicates(positions), "v") == rows(kept, "v")


def test_talweg_drops_repeated_positions(spark, rows):
    raw = spark.createDataFrame(
        [(0, 1, 10, 1.0), (1, 1, 10, 2.0), (2, 1, 20, 3.0)],
        "Swath int, AXIS long, measure long, slope_talweg double",
    )
    out = prepare.prepare_talweg_metrics(raw)
    assert "swath" not in out.columns
    assert rows(out, "axis", "measure_medial_axis", "slope_talweg") == [(1, 20, 3.0)]


def test_side_check_reports_but_keeps(spark, rows):
    df = spark.createDataFrame(
        [("left", 1, 10, 1), ("left", 1, 10, 2), ("right", 1, 10, 3), ("right", 1, 20, 4)],
        "side string, axis long, measure_medial_axis long, v int",
    )
    checked = quality.check_sides(df)
    assert checked.table.count() == 4
    assert rows(checked.duplicates, "v") == [(1,), (2,)]
    # dropping takes the position out on both banks
    assert rows(quality.check_sides(df, drop=True).table, "v") == [(4,)]


def test_keep_longest_keeps_ties_and_geometry(spark, rows):
    df = spark.createDataFrame(
        [(1, 10, 5.0, "a"), (1, 10, 9.0, "b"), (1, 10, 9.0, "c"), (1, 20, 1.0, "d"), (1, None, 2.0, "e"), (1, None, 3.0, "f")],
        "axis long, m long, leng double, geom string",
    )
    out = keep_longest(df)
    assert rows(out, "geom", "m") == [("a", None), ("b", 10), ("c", 10), ("d", 20), ("e", None), ("f", None)]
    assert rows(quality.unique_violations(out, ["axis", "m"])) == [(1, 10, 2)]


def test_foreign_keys(spark, rows):
    child = spark.createDataFrame([(1, 5), (2, 6), (3, None)], "id int, parent int")
    parent = spark.createDataFrame([(5,)], "gid int")
    assert rows(quality.fk_violations(child, parent, "parent", "gid")) == [(2, 6)]


def test_conform_orders_casts_and_defaults(spark):
    df = spark.createDataFrame([("1", None)], "gid string, display boolean")
    out = quality.conform(df, struct("display boolean, gid int, name string"))
    assert out.columns == ["display", "gid", "name"]
    assert tuple(out.first()) == (False, 1, None)
    with pytest.raises(ValueError, match="not in the table"):
        quality.conform(df, struct("gid int"))


def test_double_axis_is_cast(spark):
    df = spark.createDataFrame([(2000796122.0, 200.0)], "axis double, measure_medial_axis double")
    out = quality.conform(df, TABLES["continuity_area"])
    assert (out.first()["axis"], out.first()["measure_medial_axis"]) == (2000796122, 200)
    assert len(out.columns) == 21


def test_keyed_join_spreads_incomplete_keys(spark, rows):
    left = spark.range(2000).select(
        F.lit(1).cast("long").alias("axis"), F.lit(None).cast("long").alias("m"), "id"
    )
    right = spark.createDataFrame([(1, 5, "x")], "axis long, m long, name string")
    out = keyed_join(left, right, ["axis", "m"], "left")
    assert out.columns == ["axis", "m", "id", "name"]
    assert out.count() == 2000 and out.filter("name is not null").count() == 0
    assert keyed_join(left, right, ["axis", "m"], "left_anti").count() == 2000
    assert keyed_join(left, right, ["axis", "m"], "left_semi").count() == 0


def test_incomplete_keys_are_spread_over_the_tasks(spark, tmp_path):
    spark.range(2000).selectExpr("if(id < 1, 5, null) AS p", "id").write.parquet(str(tmp_path / "left"))
    spark.range(1).selectExpr("5 AS p", "'x' AS name").write.parquet(str(tmp_path / "right"))
    left, right = (spark.read.parquet(str(tmp_path / n)) for n in ("left", "right"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for how in ("left", "left_anti"):
            out = keyed_join(left, right, ["p"], how)
            tasks = out.groupBy(F.spark_partition_id().alias("task")).count().collect()
            assert max(r["count"] for r in tasks) < 1500
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
