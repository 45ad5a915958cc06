"""Replace-by-key writes, network replacement and rebuilding of serving tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riverloom.operators.joins import hot_join, hot_keys
from riverloom.operators.link import link_swaths
from riverloom.operators.profiles import rows_per_axis
from riverloom.session import drop_folder, exists, saved

BUCKET = "key_bucket"


class Replaced(NamedTuple):
    table: DataFrame
    deleted: DataFrame
    inserted: DataFrame


def replace_by_key(target: DataFrame, new: DataFrame, key: str) -> Replaced:
    """Drop all target rows whose key occurs in ``new``, then append ``new``.

    This is not a row-level merge: an old row of a replaced key goes even if
    ``new`` has no successor for it. Empty ``new`` deletes nothing. A null key
    matches nothing. The table keeps its types. ``deleted`` and ``inserted`` are one-row counts.
    """
    new = new.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in target.schema.fields])
    keys = new.select(key).filter(F.col(key).isNotNull()).distinct()
    hot = hot_keys(target, [key])
    kept = hot_join(target, keys, [key], "left_anti", hot)
    gone = hot_join(target, keys, [key], "left_semi", hot)
    return Replaced(
        kept.unionByName(new),
        gone.agg(F.count(F.lit(1)).alias("n")),
        new.agg(F.count(F.lit(1)).alias("n")),
    )


def bucket_of(key: str, buckets: int):
    return F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(buckets)).cast("int")


def _write(df: DataFrame, path: str, swap: str) -> None:
    # rebalance: one file set per bucket, and a bucket with a hot key is split
    (
        df.hint("rebalance", BUCKET)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", swap)
        .partitionBy(BUCKET)
        .parquet(path)
    )


ROWS_PER_BUCKET = 1_000_000


def buckets_for(rows: int) -> int:
    """Buckets for a table that is to have so many rows."""
    return max(16, -(-rows // ROWS_PER_BUCKET))


LAYOUT = "key string, buckets int, sized boolean"


def create_table(df: DataFrame, path: str, key: str, buckets: int | None = None) -> int:
    """Write a table in key buckets, so that later loads rewrite only a few.

    The number of buckets, by default from the number of rows, is kept beside
    the table; a table that grows far beyond its first size is better created
    anew. Returns it. A table of that path is replaced. An empty table for which
    no number is given gets one from the rows of its first load.
    """
    rows = None if buckets else df.count()
    buckets = buckets or buckets_for(rows)
    _write(df.withColumn(BUCKET, bucket_of(key, buckets)), path, "static")
    layout = df.sparkSession.createDataFrame([(key, buckets, rows != 0)], LAYOUT)
    layout.coalesce(1).write.mode("overwrite").parquet(f"{path}.layout")
    return buckets


def buckets_of(spark: SparkSession, path: str, key: str, buckets: int | None = None) -> int:
    """Number of buckets of a stored table; an error if it has another key or number."""
    stored = spark.read.parquet(f"{path}.layout").first()
    if stored["key"] != key or buckets not in (None, stored["buckets"]):
        raise ValueError(
            f"{path} has {stored['buckets']} buckets by {stored['key']}, not {buckets or 'any'} by {key}"
        )
    return stored["buckets"]


def _read(spark: SparkSession, path: str, schema: T.StructType | None) -> DataFrame:
    if schema is None:
        return spark.read.parquet(path)
    stored = T.StructType([*schema.fields, T.StructField(BUCKET, T.IntegerType())])
    return spark.read.schema(stored).parquet(path)


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A stored table; the schema is needed as long as it may be empty."""
    return _read(spark, path, schema).drop(BUCKET)


def upsert_table(
    new: DataFrame, path: str, key: str, buckets: int | None = None, schema: T.StructType | None = None
) -> tuple[int, int]:
    """Replace by key in a stored table; returns rows deleted and inserted.

    ``buckets`` is only compared with the table's own number; ``schema`` is
    needed as long as the table may be empty.

    Only the buckets that hold one of the new keys are read and rewritten, in
    one job whose commit swaps them. The new rows are first written to the
    shared folder, so that they are computed once and a re-run of the job
    after lost executors sees the same rows.
    """
    buckets = buckets_of(new.sparkSession, path, key, buckets)
    table = _read(new.sparkSession, path, schema)
    sized = new.sparkSession.read.schema(LAYOUT).parquet(f"{path}.layout").first()["sized"]
    fields = [f for f in table.schema.fields if f.name != BUCKET]
    # the bucket depends on the key as the table types it
    typed = new.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in fields])
    rows = saved(typed.withColumn(BUCKET, bucket_of(key, buckets)), "staged")
    inserted = rows.count()
    if not inserted:
        return 0, 0
    if sized is False:  # null in tables of before
        create_table(rows.drop(BUCKET), path, key, buckets_for(inserted))
        return 0, inserted
    # at most ``buckets`` small numbers
    touched = [r[0] for r in rows.select(BUCKET).distinct().collect()]
    old = table.filter(F.col(BUCKET).isin(touched))
    replaced = replace_by_key(old, rows, key)
    deleted = replaced.deleted.first()["n"]
    _write(replaced.table, path, "dynamic")
    return deleted, inserted


def delete_matching(
    keys: DataFrame, path: str, column: str, schema: T.StructType | None = None
) -> int:
    """Delete the rows of a stored table whose ``column`` is among the keys.

    Rewrites the buckets that hold such rows, and removes those left empty.
    """
    spark = keys.sparkSession
    table = _read(spark, path, schema)
    keys = keys.select(column).distinct()
    hot = hot_keys(table, [column])
    doomed = hot_join(table, keys, [column], "left_semi", hot)
    counts = {r[BUCKET]: r["count"] for r in doomed.groupBy(BUCKET).count().collect()}
    if not counts:
        return 0
    held = table.filter(F.col(BUCKET).isin(list(counts)))
    sizes = {r[BUCKET]: r["count"] for r in held.groupBy(BUCKET).count().collect()}
    kept = hot_join(held, keys, [column], "left_anti", hot)
    _write(kept.select(*table.columns), path, "dynamic")
    # a dynamic overwrite leaves a bucket alone for which it has no row
    for bucket in (b for b in counts if counts[b] == sizes[b]):
        drop_folder(f"{path}/{BUCKET}={bucket}")
    return sum(counts.values())


class Network(NamedTuple):
    axes: DataFrame
    swaths: DataFrame
    obstacles: DataFrame | None
    metrics: dict[str, DataFrame]
    deleted_per_axis: DataFrame


def replace_network(
    new_axes: DataFrame, new_swaths: DataFrame, tables: Mapping[str, DataFrame]
) -> Network:
    """Replace whole axes with their swaths.

    Deleting an axis takes along its swaths **and its obstacles**, whichever
    rows come in afterwards; obstacles have to be loaded again. All metric
    tables present in ``tables`` are linked anew: rows of a vanished swath lose
    their link, rows at a new position get one.
    """
    replaced = new_axes.select("axis").filter(F.col("axis").isNotNull()).distinct()
    old_swaths = tables["hydro_swaths"]
    hot = hot_keys(old_swaths, ["axis"])
    swaths = hot_join(old_swaths, replaced, ["axis"], "left_anti", hot).unionByName(
        new_swaths.select(*old_swaths.columns)
    )
    obstacles = tables.get("roe")
    if obstacles is not None:
        obstacles = hot_join(obstacles, replaced, ["axis"], "left_anti")
    fixed = ("hydro_axis", "hydro_swaths", "roe")
    return Network(
        replace_by_key(tables["hydro_axis"], new_axes, "axis").table,
        swaths,
        obstacles,
        {n: link_swaths(t, swaths) for n, t in tables.items() if n not in fixed},
        rows_per_axis(hot_join(old_swaths, replaced, ["axis"], "left_semi", hot)),
    )


Builder = Callable[[Callable[[str], DataFrame]], DataFrame]


def refresh(
    spark: SparkSession, names: list[str], catalog: Mapping[str, Builder], folder: str
) -> list[str]:
    """Rebuild the named serving tables under ``folder``, in the given order.

    Every table is written to a folder of its own run. Only when all are there
    does one small append name them as those to be served, so readers, who use
    :func:`served`, see either all old or all new tables, and a job that fails
    changes nothing. Versions before the last one are dropped.

    A builder gets a function that reads a served table, or one of this run, so
    a table must come after those it reads. Rows are range-partitioned by axis
    and position where the table has them, which also splits a long axis and
    lets a reader skip files by axis.
    """
    run, written = uuid.uuid4().hex, {}
    old = _versions(spark, folder)

    def read(name: str) -> DataFrame:
        return spark.read.parquet(written[name]) if name in written else served(spark, folder, name)

    for name in names:
        df = catalog[name](read)
        order = [c for c in ("axis", "measure_medial_axis") if c in df.columns]
        if order:
            df = df.repartitionByRange(*order).sortWithinPartitions(*order)
        written[name] = f"{folder}/{name}/{run}"
        df.write.parquet(written[name])
    number = 1 + max([n for _, n, _ in old], default=0)
    rows = [(name, number, path) for name, path in written.items()]
    spark.createDataFrame(rows, VERSION).coalesce(1).write.mode("append").parquet(f"{folder}/versions")
    for name in names:
        for _, _, path in sorted((v for v in old if v[0] == name), key=lambda v: v[1])[:-1]:
            drop_folder(path)
    return list(written.values())


VERSION = "name string, number long, path string"


def _versions(spark: SparkSession, folder: str) -> list[tuple]:
    """(name, number, path) of every refresh; a few rows."""
    if not exists(f"{folder}/versions"):
        return []
    return [tuple(r) for r in spark.read.schema(VERSION).parquet(f"{folder}/versions").collect()]


def served(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A serving table as last refreshed."""
    _, path = max((number, path) for n, number, path in _versions(spark, folder) if n == name)
    return spark.read.parquet(path)
