"""Line dedup against levelled sorted runs of line hashes; DataFrame functions only.

Documents come in batches of ascending ids. What earlier batches hold is kept as *runs*:
tables of line hashes, dealt into buckets by hash and sorted within each, so that a batch
is compared with a run by a merge join that neither shuffles nor sorts the run. A batch

1. takes its distinct line keys with the smallest and largest id that holds each, combined
   before they are shuffled, so that a line in a third of all rows is one row for each task;
2. merge-anti-joins them with all runs: keys that none holds are new;
3. adds the new ones as a run of level 0. ``fan`` runs of a level are compacted into one
   of the next, so there are at most fan - 1 runs a level and each key is rewritten once a level.

Lines of a key go where an earlier batch holds it, or the batch itself in a smaller id. The
lines to drop are found by a join of the batch's lines with the repeated keys. Keys with
more than 1/``HEAVY`` of all lines, at most ``HEAVY`` rows, are broadcast; the others are
shuffled by hash, so that no task gets more than that share for one key. Only positions are
shuffled that way; a text takes part in one join, by its id.

Hashes are the first 128 bits of SHA-256 of the key. A key is the line without
``[\\x20\\x09-\\x0D]`` at both ends and with A-Z lower-cased; keys of fewer than ``least`` code
points are kept always. Null and empty texts are one empty line. Rows that repeat an id are
one document: none of them loses lines to another. Rows without an id hold no line for others
and lose none. Empty tables give empty results; other columns are not looked at.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riverloom.operators.joins import keyed_join
from riverloom.session import new_folder, saved, saved_and_counted

LEAST = 10
BATCHES = 6
FAN = 3
HEAVY = 1000
SPACE = " \t\n\x0b\x0c\r"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_ORDERED = "spark.sql.legacy.bucketedTableScan.outputOrdering"


def split_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    bare = F.btrim(line, F.lit(SPACE))
    plain = F.octet_length(bare) == F.char_length(bare)
    return F.when(plain, F.lower(bare)).otherwise(F.translate(bare, _UPPER, _UPPER.lower()))


def id_batches(docs: DataFrame, batches: int) -> list[int]:
    """Ids at which batches end, about as many rows in each; the last has no end."""
    if batches < 2:
        return []
    shares = [i / batches for i in range(1, batches)]
    ends = docs.agg(F.percentile_approx("doc_id", shares, 10_000)).first()[0]
    return sorted(set(ends or []))


def keyed_lines(docs: DataFrame, ends: list[int], least: int = LEAST) -> DataFrame:
    """doc_id, version (of the text), pos, hash and batch of every line with a long key."""
    batch = reduce(lambda total, end: total + (F.col("doc_id") > end).cast("int"), ends, F.lit(0))
    version = F.xxhash64("text").alias("version")
    lines = docs.where("doc_id IS NOT NULL").select(
        "doc_id", version, batch.alias("batch"), F.posexplode(split_lines(F.col("text"))).alias("pos", "line")
    )
    keyed = lines.select("doc_id", "version", "batch", "pos", line_key(F.col("line")).alias("key"))
    digest = F.unhex(F.substring(F.sha2("key", 256), 1, 32)).alias("hash")
    return keyed.where(F.char_length("key") >= least).select("doc_id", "version", "pos", digest, "batch")


class LineRuns:
    """Runs of line hashes, level by level."""

    def __init__(self, spark: SparkSession, fan: int = FAN, buckets: int | None = None):
        self.spark, self.fan = spark, fan
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[DataFrame]] = []
        self.tables: list[str] = []

    def _write(self, rows: DataFrame) -> DataFrame:
        """One sorted file for each bucket."""
        name = f"line_run_{uuid.uuid4().hex}"
        before = self.spark.conf.get(_ORDERED)
        self.spark.conf.set(_ORDERED, "true")  # files are sorted: merge joins need no sort
        try:
            writer = rows.write.format("parquet").bucketBy(self.buckets, "hash").sortBy("hash")
            writer.option("path", new_folder(self.spark, name)).saveAsTable(name)
        finally:
            self.spark.conf.set(_ORDERED, before)
        self.tables.append(name)
        return self.spark.table(name)

    def add(self, lines: DataFrame) -> DataFrame:
        """Enter a batch (doc_id, hash), of ids above all earlier ones. Returns its keys:
        hash, holder (smallest id), last (largest), n (lines), seen (held by an earlier batch)."""
        keys = lines.groupBy("hash").agg(
            F.min("doc_id").alias("holder"), F.max("doc_id").alias("last"), F.count("*").alias("n")
        )
        runs = [run for level in self.levels for run in level]
        for i, run in enumerate(runs):
            keys = keys.join(run.select("hash", F.lit(True).alias(f"in_{i}")), "hash", "left")
        seen = reduce(lambda a, i: a | F.col(f"in_{i}").isNotNull(), range(len(runs)), F.lit(False))
        added = self._write(keys.select("hash", "holder", "last", "n", seen.alias("seen")))
        self._enter(0, added.where("NOT seen").select("hash"))
        return added

    def _enter(self, level: int, run: DataFrame) -> None:
        if level == len(self.levels):
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) == self.fan:
            # no key is in two runs; buckets are merged one by one, without a shuffle
            merged = reduce(DataFrame.unionByName, self.levels[level]).sortWithinPartitions("hash")
            self.levels[level] = []
            self._enter(level + 1, self._write(merged))

    def close(self) -> None:
        """Forget the runs. Their files lie in the run folder."""
        for name in self.tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        self.tables, self.levels = [], []


def repeated_lines(lines: DataFrame, keys: DataFrame, total: int) -> DataFrame:
    """doc_id, version, pos of the lines to drop, each once. ``keys`` are the repeated keys:
    batch, hash, n and holder, null where an earlier batch has the key."""
    on = ["batch", "hash"]
    heavy = F.col("n") * HEAVY > total
    hot, rest = keys.where(heavy).drop("n"), keys.where(~heavy).drop("n")
    hits = lines.join(F.broadcast(hot), on).unionByName(
        lines.join(F.broadcast(hot.select(*on)), on, "left_anti").join(rest, on)
    )
    dropped = hits.where(F.col("holder").isNull() | (F.col("doc_id") > F.col("holder")))
    return dropped.select("doc_id", "version", "pos").distinct()


def without_positions(lines: Column, gone: Column) -> Column:
    """The array without the elements at the ascending places ``gone``, in linear time: the
    slices between them."""
    def cut(s: Column) -> Column:
        # s carries both arrays, so that neither is computed again for each slice
        begin = F.concat(F.array(F.lit(-1)), s["gone"])
        end = F.concat(s["gone"], F.array(F.size(s["lines"])))
        return F.flatten(F.zip_with(begin, end, lambda b, e: F.slice(s["lines"], b + 2, e - b - 1)))

    return F.transform(F.array(F.struct(lines.alias("lines"), gone.alias("gone"))), cut)[0]


def without_repeated_lines(docs: DataFrame, batches: int = BATCHES, least: int = LEAST, fan: int = FAN) -> DataFrame:
    """doc_id, n_lines, n_dropped and kept_text of every row of docs (doc_id, text)."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    ends = id_batches(docs, batches)
    lines, total = saved_and_counted(keyed_lines(docs, ends, least), "lines", F.lit(True))
    runs = LineRuns(spark, fan)
    keys = []
    for batch in range(len(ends) + 1):
        added = runs.add(lines.where(F.col("batch") == batch).select("doc_id", "hash"))
        holder = F.when(~F.col("seen"), F.col("holder")).alias("holder")
        found = added.where("seen OR holder < last").select(F.lit(batch).alias("batch"), "hash", "n", holder)
        keys.append(found)
    repeated = saved(reduce(DataFrame.unionByName, keys), "repeated-lines")
    runs.close()
    gone = repeated_lines(lines, repeated, total).groupBy("doc_id", "version")
    gone = gone.agg(F.sort_array(F.collect_list("pos")).alias("gone"))
    versions = docs.withColumn("version", F.when(F.col("doc_id").isNotNull(), F.xxhash64("text")))
    marked = keyed_join(versions, gone, ["doc_id", "version"], "left")
    text = F.coalesce("text", F.lit(""))
    kept = F.array_join(without_positions(split_lines(F.col("text")), F.col("gone")), "\n")
    return marked.select(
        "doc_id",
        (F.char_length(text) - F.char_length(F.replace(text, F.lit("\n"), F.lit(""))) + 1).cast("long").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped"),
        F.when(F.col("gone").isNull(), text).otherwise(kept).alias("kept_text"),
    )
