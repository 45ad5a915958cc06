"""Micro-batch loading of metric rows."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from riverloom.operators.joins import hot_join
from riverloom.operators.link import link_swaths
from riverloom.session import drop_folder
from riverloom.sources.tables import bucket_of, upsert_table

BUCKETS = 256


def _rows_folder(checkpoint: str, load: str) -> str:
    return f"{checkpoint}-rows/{load}"


def close_load(checkpoint: str, load: str) -> None:
    """Free the raw rows of a load that is not to be continued."""
    drop_folder(_rows_folder(checkpoint, load))


def stream_metrics(
    stream: DataFrame,
    swaths: DataFrame,
    path: str,
    checkpoint: str,
    key: str = "axis",
    prepare=None,
    schema: T.StructType | None = None,
    load: str | None = None,
) -> StreamingQuery:
    """Link arriving metric rows to their swath and replace them by key.

    ``prepare`` turns raw rows into table rows first. All that one load brings
    for a key replaces what the table had of it before: a load keeps its raw
    rows beside the checkpoint, and a batch is prepared together with the
    rows of its keys that the load brought earlier, so a key may be spread
    over any number of batches. A batch that is run again after a failure
    writes its own rows again. A call is a load of its own; give it a name in
    ``load`` to go on with it in a later call, until :func:`close_load` frees its
    rows. ``schema`` is that of the table, needed as long as it may be empty.

    The raw rows are kept in ``BUCKETS`` buckets by key, so a batch reads those of
    its own keys, not all that have arrived.
    """
    arrived = _rows_folder(checkpoint, load or uuid.uuid4().hex)

    def replace(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        bucketed = batch.withColumn("bucket", bucket_of(key, BUCKETS))
        bucketed.write.mode("overwrite").partitionBy("bucket").parquet(f"{arrived}/batch={number}")
        extra = [T.StructField("batch", T.LongType()), T.StructField("bucket", T.IntegerType())]
        fields = T.StructType([*batch.schema.fields, *extra])
        every = spark.read.schema(fields).parquet(arrived).where(F.col("batch") <= number)
        own = every.where(F.col("batch") == number)
        # at most BUCKETS small numbers
        touched = [r[0] for r in own.select("bucket").distinct().collect()]
        every = every.where(F.col("bucket").isin(touched))
        rows = hot_join(every, own.select(key).distinct(), [key], "left_semi").drop("batch", "bucket")
        nameless = own.where(F.col(key).isNull()).drop("batch", "bucket")
        rows = rows.unionByName(nameless)
        rows = prepare(rows) if prepare else rows
        upsert_table(link_swaths(rows, swaths), path, key, schema=schema)

    return (
        stream.writeStream.foreachBatch(replace)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
