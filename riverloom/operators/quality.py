"""Duplicate detection, key constraints and schema conformance."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riverloom.operators.joins import hot_join, keyed_join


class Duplicates(NamedTuple):
    rows: DataFrame
    summary: DataFrame


@dataclass(frozen=True)
class SideCheck:
    """A table, and the rows of it that share a position within one bank."""

    table: DataFrame
    checked: DataFrame
    keys: list[str]

    @cached_property
    def duplicates(self) -> DataFrame:
        banks = self.checked.filter(F.col("side").isin("left", "right"))
        repeated = repeated_keys(banks, self.keys).select(*self.keys)
        rows = banks.filter(_complete(self.keys)).join(repeated, self.keys, "left_semi")
        return rows.select(*self.checked.columns)


def _complete(keys: list[str]) -> str:
    return " AND ".join(f"`{k}` IS NOT NULL" for k in keys)


def repeated_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Non-null keys held by more than one row, with the row count ``n``.

    Counting combines on the map side, so a key held by a large share of the
    rows costs one partial row per task.
    """
    return (
        df.filter(_complete(keys))
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") > 1)
    )


unique_violations = repeated_keys


def find_duplicates(df: DataFrame, axis: str = "axis", measure: str = "measure") -> Duplicates:
    """All rows sharing a non-null (axis, measure), and per axis the surplus."""
    keys = [axis, measure]
    repeated = repeated_keys(df, keys)
    rows = df.filter(_complete(keys)).join(repeated.select(*keys), keys, "left_semi")
    summary = (
        repeated.groupBy(F.col(axis).alias("axis"))
        .agg(F.sum(F.col("n") - 1).alias("num_duplicate"))
    )
    return Duplicates(rows.select(*df.columns), summary)


def drop_duplicate_keys(
    df: DataFrame, duplicates: DataFrame, axis: str = "axis", measure: str = "measure"
) -> DataFrame:
    """Remove every row whose key is among the duplicates; no copy survives."""
    keys = [axis, measure]
    return hot_join(df, duplicates.select(*keys).distinct(), keys, "left_anti")


def without_duplicates(df: DataFrame, axis: str = "axis", measure: str = "measure") -> DataFrame:
    """Detection and removal in one; takes the repeated keys straight from the count."""
    keys = [axis, measure]
    return keyed_join(df, repeated_keys(df, keys).select(*keys), keys, "left_anti")


def check_sides(
    df: DataFrame,
    axis: str = "axis",
    measure: str = "measure_medial_axis",
    drop: bool = False,
) -> SideCheck:
    """Duplicates within the left and the right bank.

    They are reported and the table is left as it is; ``drop=True`` also takes
    their positions out, on both banks.
    """
    keys = ["side", axis, measure]
    table = df
    if drop:
        banks = df.filter(F.col("side").isin("left", "right"))
        table = drop_duplicate_keys(df, repeated_keys(banks, keys), axis, measure)
    return SideCheck(table, df, keys)


def fk_violations(
    child: DataFrame, parent: DataFrame, key: str, parent_key: str | None = None
) -> DataFrame:
    """Child rows whose non-null key has no parent."""
    parents = parent.select(F.col(parent_key or key).alias(key)).distinct()
    return child.filter(F.col(key).isNotNull()).join(parents, key, "left_anti").select(
        *child.columns
    )


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Order, cast and default the columns as the table declares them.

    A missing column becomes null, a missing or null flag becomes false, and a
    column that the table does not have is an error.
    """
    unknown = [c for c in df.columns if c not in schema.fieldNames()]
    if unknown:
        raise ValueError(f"columns not in the table: {unknown}")
    out = []
    for field in schema.fields:
        c = F.col(field.name) if field.name in df.columns else F.lit(None)
        c = c.cast(field.dataType)
        if isinstance(field.dataType, T.BooleanType):
            c = F.coalesce(c, F.lit(False))
        metadata = df.schema[field.name].metadata if field.name in df.columns else {}
        out.append(c.alias(field.name, metadata=metadata))
    return df.select(*out)
