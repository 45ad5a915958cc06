import pytest
from pyspark.sql import functions as F

from riverloom.functions import columns as c
from riverloom.operators.pivot import pivot_area, pivot_width
from riverloom.operators.profiles import axis_summary, elevation_profile
from riverloom.plans import prepare

LABELS = ["forest", "crops"]
CELLS = "side string, axis long, measure long, label string, area double, width1 double"


def test_clean_names_and_clash(spark):
    df = spark.createDataFrame([(1, 2, 3)], ["A.B-c d", "Plain", "x"])
    assert c.clean_columns(df).columns == ["a_b_c_d", "plain", "x"]
    with pytest.raises(ValueError, match="clash"):
        c.clean_columns(spark.createDataFrame([(1, 2)], ["Dense urban", "dense_urban"]))


def test_axis_id_drops_end_zeros(spark, rows):
    df = spark.createDataFrame(
        [
            ("a", "COURDEAU0000002215482270/COURDEAU0000002215482269"),
            ("b", "COURDEAU0000000000000013"),
            ("c", "none"),
            ("d", ""),
            ("e", None),
        ],
        "id_troncon string, link string",
    )
    assert rows(c.reach_axis_ids(df)) == [("a", 221548227), ("b", 13), ("c", None)]


def test_percent_and_sign_guards(spark, rows):
    df = spark.createDataFrame(
        [(1.0, 4.0, 5), (None, 4.0, 0), (1.0, 0.0, None), (1.0, None, -3)],
        "part double, total double, d int",
    )
    out = df.select(
        c.guarded_pct(F.col("part"), F.col("total")), c.flip_sign(F.col("d"))
    ).collect()
    assert [tuple(r) for r in out] == [(25.0, -5), (None, 0), (None, None), (None, 3)]


def test_display_flags(spark, rows):
    df = spark.createDataFrame(
        [("06", False), ("07", True), (None, True)], "cdbh string, display boolean"
    )
    assert rows(c.set_displayed(df, "cdbh", ["06"])) == sorted(
        [("06", True), ("07", False), (None, True)], key=repr
    )
    assert rows(c.set_displayed(df, "cdbh", []), "display") == [(False,), (False,), (True,)]
    with pytest.raises(ValueError):
        c.set_displayed(df.drop("display"), "cdbh", ["06"])


def test_pivot_values_and_empty_row(spark):
    df = spark.createDataFrame(
        [
            ("left", 1, 200, "forest", 30000.0, 3.0),
            ("left", 1, 200, "crops", 10000.0, None),
            ("right", 1, 200, "forest", None, None),
        ],
        CELLS,
    )
    wide = {r["side"]: r for r in pivot_area(df, LABELS).collect()}
    assert wide["left"]["forest"] == 3.0 and wide["left"]["sum_area"] == 4.0
    assert wide["left"]["forest_pc"] == 75.0
    # no area at all: the sum is 0 and so every percentage is null
    assert wide["right"]["sum_area"] == 0.0
    assert wide["right"]["forest_pc"] is None and wide["right"]["crops"] is None
    width = {r["side"]: r for r in pivot_width(df, LABELS).collect()}
    assert width["left"]["sum_width"] == 3.0 and width["left"]["crops"] is None


@pytest.mark.parametrize("label", ["forest", "lava", None])
def test_pivot_rejects_repeated_and_unlisted_labels(spark, label):
    df = spark.createDataFrame(
        [("left", 1, 200, "forest", 1.0, 1.0), ("left", 1, 200, label, 2.0, 1.0)], CELLS
    )
    with pytest.raises(Exception, match="repeated or unlisted label at axis 1, measure 200"):
        pivot_area(df, LABELS).count()


def test_labels_that_clash_after_cleaning(spark):
    df = spark.createDataFrame([("left", 1, 200, "a b", 1.0, 1.0)], CELLS)
    with pytest.raises(ValueError, match="clash"):
        prepare.prepare_landcover_area(df, ["a b", "a-b"])
    out = prepare.prepare_landcover_area(df, ["a b"]).table
    assert "a_b" in out.columns and "a_b_pc" in out.columns


def test_profile_sums_are_null_strict(spark, rows):
    df = spark.createDataFrame(
        [
            (1, "right", 50, 2, 5.0, 7.0, 1, 200, 10),
            (1, "left", 50, 3, 6.0, 7.0, 1, 200, 10),
            (1, "left", 25, 9, 9.0, 7.0, 1, 200, 10),
            (2, "left", 50, 2, None, 7.0, 1, 200, 0),
            (2, "right", 50, 2, 4.0, 7.0, 1, 200, 0),
            (3, "left", 50, 0, 4.0, 7.0, 1, 200, -10),
        ],
        "sample long, side string, quantile int, density int, mean double, profile double,"
        " axis long, measure long, distance int",
    )
    assert rows(elevation_profile(df), "sample", "density", "mean", "distance") == [
        (1, 5, 11.0, -10),
        (2, 4, None, 0),
    ]


def test_axis_summary_mode_and_strict_length(spark, rows):
    swaths = spark.createDataFrame(
        [(1, 5.0, 2), (1, 5.0, 1), (1, 5.0, None), (2, None, None), (2, 1.0, 4)],
        "axis long, length double, gid_region int",
    )
    reaches = spark.createDataFrame(
        [(7, 1, "late"), (3, 1, None), (9, 2, "two")], "fid long, axis long, toponyme string"
    )
    # the lowest fid decides, even with a null name; a tie goes to the smallest region
    assert rows(axis_summary(swaths, reaches)) == [(1, None, 15.0, 1), (2, "two", None, 4)]
