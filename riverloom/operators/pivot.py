"""Labelled rows to one wide row per bank and position."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riverloom.functions.columns import hectares

KEYS = ["side", "axis", "measure"]


def pivot_labels(df: DataFrame, value: Column, labels: list[str], total: str) -> DataFrame:
    """One column per label, their sum (nulls count as 0) and percentages.

    Expressions are SQL text, as building them one by one takes longer than
    running them on small data. The listed labels are conditional aggregates of a single group-by: one
    shuffle, by position, so that links to swaths and sums over the banks need no other. A position
    has one row a bank and label, so none is large. A label outside the list, or two rows
    for one cell, raises: the rows of a group must be as many as its distinct
    listed labels.
    """
    arms = " ".join(f"WHEN {_text(label)} THEN {i}" for i, label in enumerate(labels))
    rows = df.select(*KEYS, F.expr(f"CASE label {arms} END AS __i"), value.alias("__v"))
    rows = rows.repartition("axis", "measure")
    cells = [f"max(CASE WHEN __i = {i} THEN __v END) AS `{c}`" for i, c in enumerate(labels)]
    checks = [
        "count(1) AS __rows",
        "bit_count(coalesce(bit_or(shiftleft(1L, __i)), 0L)) AS __labels",
    ]
    grouped = rows.groupBy(*KEYS).agg(*map(F.expr, cells + checks))
    place = "concat('axis ', coalesce(string(axis), 'null'), ', measure ', coalesce(string(measure), 'null'))"
    sound = (
        "CASE WHEN __rows = __labels THEN true ELSE"
        f" boolean(raise_error(concat('repeated or unlisted label at ', {place}))) END"
    )
    summed = " + ".join(f"coalesce(`{c}`, 0D)" for c in labels)
    wide = grouped.filter(sound).selectExpr("*", f"{summed} AS `{total}`")
    shares = [
        f"CASE WHEN `{c}` IS NOT NULL AND `{total}` != 0 THEN `{c}` / `{total}` * 100 END AS `{c}_pc`"
        for c in labels
    ]
    return wide.selectExpr(*KEYS, *[f"`{c}`" for c in labels], f"`{total}`", *shares)


def _text(label: str) -> str:
    """SQL literal of a label."""
    return "'" + label.replace("\\", "\\\\").replace("'", "\\'") + "'"


def pivot_area(df: DataFrame, labels: list[str]) -> DataFrame:
    """Areas in hectares per label, ``sum_area`` and percentages."""
    return pivot_labels(df, hectares(F.col("area")), labels, "sum_area")


def pivot_width(df: DataFrame, labels: list[str]) -> DataFrame:
    """Widths per label, ``sum_width`` and percentages."""
    return pivot_labels(df, F.col("width1").cast("double"), labels, "sum_width")
