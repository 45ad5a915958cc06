"""Links from metric rows to swaths."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riverloom.operators.joins import grown, keyed_join

LINK = "hydro_swaths_gid"
POSITION = ["axis", "measure_medial_axis"]


def link_swaths(metric: DataFrame, swaths: DataFrame) -> DataFrame:
    """Set the swath id by equal (axis, measure); null where there is none.

    The pair is unique among swaths, so rows are never multiplied; ids held
    from an earlier load are recomputed. The join is on the plain pair, so that
    sums by position need no further shuffle; a hot position, or many rows
    without one, are split by the adaptive skew join.
    """
    by_position = swaths.filter("axis IS NOT NULL AND measure_medial_axis IS NOT NULL").selectExpr(
        "bigint(axis) AS axis", "bigint(measure_medial_axis) AS measure_medial_axis", f"gid AS {LINK}"
    )
    bare = [c for c in metric.columns if c != LINK]
    typed = metric.selectExpr(*[f"bigint({c}) AS {c}" if c in POSITION else f"`{c}`" for c in bare])
    return typed.join(grown(by_position), POSITION, "left").select(*bare, LINK)


def unlink_deleted(metric: DataFrame, swaths: DataFrame) -> DataFrame:
    """Null the link of rows whose swath is gone."""
    kept = swaths.select(F.col("gid").alias(LINK)).distinct().withColumn("__kept", F.lit(True))
    joined = keyed_join(metric, kept, [LINK], "left")
    return joined.withColumn(LINK, F.when(F.col("__kept"), F.col(LINK))).drop("__kept")
