"""Group summaries of elevation profiles and axes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riverloom.functions.columns import flip_sign, strict_sum
from riverloom.operators.joins import grown


def elevation_profile(df: DataFrame) -> DataFrame:
    """Median profile per sample with both banks summed.

    The sums are null when one bank is null. The other columns come from the
    left bank where there is one (ordering by a number keeps the aggregate in
    fixed-width buffers). Samples without density go, and the distance is
    mirrored so that the left bank is negative.
    """
    bank = F.when(F.col("side") == "left", 0).when(F.col("side") == "right", 1).otherwise(2)
    firsts = ["quantile", "profile", "axis", "measure", "distance"]
    grouped = (
        df.filter(F.col("quantile") == 50)
        .groupBy("sample")
        .agg(
            strict_sum(F.col("density")).alias("density"),
            strict_sum(F.col("mean")).alias("mean"),
            *[F.min_by(c, bank).alias(c) for c in firsts],
        )
    )
    return grouped.filter(F.col("density") > 0).select(
        "sample",
        "quantile",
        F.col("density").cast("int").alias("density"),
        "mean",
        "profile",
        "axis",
        F.col("measure").alias("measure_medial_axis"),
        flip_sign(F.col("distance")).alias("distance"),
    )


def first_toponyme(reaches: DataFrame, axis: str = "axis") -> DataFrame:
    """One name per axis: that of the lowest ``fid``, even if it is null."""
    return reaches.groupBy(F.col(axis).alias("axis")).agg(
        F.min_by("toponyme", "fid").alias("toponyme")
    )


def axis_summary(swaths: DataFrame, reaches: DataFrame) -> DataFrame:
    """Length, modal region and name per axis.

    The length is null when one swath has none. Regions are counted per
    (axis, region) first, so that no task holds more than one partial row per
    region of an axis; ties go to the smallest region id.
    """
    counted = swaths.groupBy("axis", "gid_region").agg(
        F.sum("length").alias("length"),
        F.count("length").alias("known"),
        F.count(F.lit(1)).alias("n"),
    )
    rank = F.when(
        F.col("gid_region").isNotNull(), F.struct(F.col("n"), -F.col("gid_region").cast("long"))
    )
    attributes = counted.groupBy("axis").agg(
        F.when(F.sum("known") == F.sum("n"), F.sum("length")).alias("length"),
        F.max_by("gid_region", rank).alias("gid_region"),
    )
    return attributes.join(grown(first_toponyme(reaches)), "axis", "left").select(
        "axis", "toponyme", "length", "gid_region"
    )


def rows_per_axis(df: DataFrame, axis: str = "axis") -> DataFrame:
    return df.groupBy(axis).agg(F.count(F.lit(1)).alias("n"))
