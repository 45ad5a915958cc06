"""Comparing the rows of a key with each other in tasks of bounded size."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def block_units(rows: DataFrame, keys: list[str], row_id: str, limit: int) -> DataFrame:
    """Deal the rows of each key into blocks of about ``limit`` rows, and copy each row
    to every pair of blocks that holds its own: any two rows of a key meet in exactly
    one unit (keys, lo, hi), unless both are in one block, which meets in (lo = hi).

    A unit holds about 2 * limit rows however many a key has. Adds block, lo, hi; rows
    are laid out so that each unit is consecutive in one partition.
    """
    counts = rows.groupBy(*keys).agg(F.ceil(F.count("*") / limit).cast("int").alias("blocks"))
    block = F.pmod(F.xxhash64(F.col(row_id)), F.col("blocks")).cast("int")
    spread = (
        rows.join(counts.where("blocks > 1"), keys, "left")
        .withColumn("blocks", F.coalesce("blocks", F.lit(1)))
        .withColumn("block", block)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("lo", F.least("block", "other"))
        .withColumn("hi", F.greatest("block", "other"))
        .drop("other", "blocks")
    )
    unit = [*keys, "lo", "hi"]
    return spread.repartition(*unit).sortWithinPartitions(*unit)


def whole_runs(
    batches: Iterable[pa.RecordBatch], keys: list[str]
) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables that hold whole runs of rows with equal keys, and where each run begins
    (one more at the end). ``keys`` are integer columns without nulls."""
    kept: list[pa.RecordBatch] = []

    def cuts(table: pa.Table) -> np.ndarray:
        new = np.zeros(len(table), bool)
        for k in keys:
            values = table[k].to_numpy()
            new[1:] |= values[1:] != values[:-1]
        return np.concatenate(([0], np.flatnonzero(new), [len(table)]))

    for batch in batches:
        if not batch.num_rows:
            continue
        kept.append(batch)
        table = pa.Table.from_batches(kept)
        starts = cuts(table)
        if len(starts) > 2:
            last = int(starts[-2])
            yield table.slice(0, last), starts[:-1]
            kept = table.slice(last).combine_chunks().to_batches()
    if kept:
        table = pa.Table.from_batches(kept)
        yield table, cuts(table)


def local_roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index in the component of each of n nodes under the links (a, b)."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        if (new == root).all():
            return root
        root = new
