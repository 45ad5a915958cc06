"""Mixing sources to target weights by capped water-filling; DataFrame functions only.

Every source gets a share of the wanted total by weight. A source whose share is
above ``max_epochs`` times its own size is clamped there, and what is left is
shared among the others by weight, until no share is above its clamp. A target of
2.4 times a source takes every document twice and a seeded choice of documents,
with 0.4 of the source's words, once more.

The choice is a prefix of the documents in the order of a seeded hash. Where the
prefix ends is found in two histograms of 1024 cells for each source, so no source
is sorted or gathered, however large. Equal rows share a hash and a fate. The
result depends on seed and rows only, neither on partitions nor on order.

Null sources are a source of their own; null texts have size 0, are kept in the
plan and taken as often as their source; sources of size 0 or weight null or not
above 0 have target 0. Empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riverloom.session import saved

CELLS = 1024
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def spot(seed: int) -> Column:
    """Cell of a row in its source's order: the first 20 bits of a digest of the row."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("doc_id").cast("string"), "text"))
    return F.conv(F.substring(digest, 1, 5), 16, 10).cast("long")


def sized(docs: DataFrame, seed: int = 11) -> DataFrame:
    """doc_id, source, size, spot: what the mix must know of each document, written once."""
    size = word_count(F.col("text")).alias("size")
    return saved(docs.select("doc_id", "source", size, spot(seed).alias("spot")), "mix-sizes")


def source_sizes(sizes: DataFrame) -> DataFrame:
    return sizes.groupBy("source").agg(F.sum("size").alias("source_size"))


def cycled_weights(sources: DataFrame, cycle: tuple[int, ...] = (5, 2, 1)) -> DataFrame:
    """Weights for sources in order of code points, nulls last."""
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, cycle)), (F.pmod(place, F.lit(len(cycle))) + 1).cast("int"))
    return sources.withColumn("weight", weight.cast("double"))


def water_fill(weighted: DataFrame, max_epochs: float = 3.0, share: float = 1.0) -> DataFrame:
    """Adds ``target`` to (source, source_size, weight); one small aggregate a round.

    Each round clamps at least one source more or is the last.
    """
    weighted = saved(weighted, "mix-sources")
    weight = F.when((F.col("weight") > 0) & (F.col("source_size") > 0), F.col("weight")).otherwise(0.0)
    cap = F.col("source_size") * F.lit(float(max_epochs))
    level = 0.0
    while True:
        clamped = weight * F.lit(level) >= cap
        wanted, held, open_weight = weighted.agg(
            F.sum("source_size") * F.lit(float(share)),
            F.sum(F.when((weight > 0) & clamped, cap).otherwise(0.0)),
            F.sum(F.when(~clamped, weight).otherwise(0.0)),
        ).first()
        if not open_weight:
            break
        higher = max(0.0, (wanted - held) / open_weight)
        if higher <= level:
            break
        level = higher
    target = F.when(weight > 0, F.least(cap, weight * F.lit(level))).otherwise(0.0)
    return weighted.withColumn("target", target)


def repetitions(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """Per source: ``whole`` repetitions of all its documents, and ``cut``: documents
    whose spot is below it are taken once more."""
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    plan = targets.withColumn("whole", F.floor(ratio + F.lit(1e-12))).withColumn(
        "goal", F.greatest(F.lit(0.0), F.col("target") - F.col("whole") * F.col("source_size"))
    )
    same = F.col("s.source").eqNullSafe(F.col("p.source"))

    def ends(cells: DataFrame, cell: str, order: list) -> DataFrame:
        """Running sizes of the cells of each source up to and with the cell."""
        w = Window.partitionBy(*order).orderBy(cell).rowsBetween(Window.unboundedPreceding, 0)
        return cells.withColumn("upto", F.sum("size").over(w))

    high, low = F.floor(F.col("spot") / CELLS), F.pmod(F.col("spot"), F.lit(CELLS))
    coarse = ends(
        sizes.groupBy("source", high.alias("high")).agg(F.sum("size").alias("size")), "high", ["source"]
    )
    # the cell in which the goal lies: the first whose running size exceeds it
    at = (
        coarse.alias("s")
        .join(plan.alias("p"), same)
        .where(F.col("upto") > F.col("goal"))
        .groupBy("s.source")
        .agg(F.min(F.struct("high", (F.col("goal") - F.col("upto") + F.col("size")).alias("rest"))).alias("a"))
        .select("source", "a.high", "a.rest")
    )
    fine = ends(
        sizes.alias("s")
        .join(at.alias("p"), same & (F.floor(F.col("s.spot") / CELLS) == F.col("p.high")))
        .groupBy("s.source", "high", "rest", low.alias("low"))
        .agg(F.sum("size").alias("size")),
        "low",
        ["source", "high", "rest"],
    )
    # with a cell if that leaves the sum nearer to the goal than without it
    taken = F.when(F.col("upto") - F.col("size") / 2 < F.col("rest"), F.col("low") + 1).otherwise(0)
    cuts = fine.groupBy("source").agg(F.max(F.col("high") * CELLS + taken).alias("cut"))
    return (
        plan.alias("p")
        .join(cuts.alias("s"), same, "left")
        .select(
            F.col("p.source").alias("source"), "source_size", "target", F.col("whole").cast("long").alias("whole"),
            F.when(F.col("goal") > 0, F.coalesce("cut", F.lit(0))).otherwise(0).alias("cut"),
        )
    )


def mixture(sizes: DataFrame, plan: DataFrame) -> DataFrame:
    """Adds source_size, target and ``reps`` to rows with source and spot."""
    reps = F.col("whole") + (F.col("spot") < F.col("cut")).cast("long")
    return (
        sizes.alias("d")
        .join(plan.alias("p"), F.col("d.source").eqNullSafe(F.col("p.source")))
        .select("d.*", "p.source_size", "p.target", reps.alias("reps"))
    )


def plan_mix(sizes: DataFrame, max_epochs: float = 3.0) -> DataFrame:
    weighted = cycled_weights(source_sizes(sizes))
    return saved(repetitions(sizes, water_fill(weighted, max_epochs)), "mix-plan")


def mixed_documents(docs: DataFrame, max_epochs: float = 3.0, seed: int = 11) -> DataFrame:
    """The documents of the mix: rows repeated as often as they are taken."""
    plan = plan_mix(sized(docs, seed), max_epochs)
    rows = docs.select(F.struct("*").alias("row"), "source", spot(seed).alias("spot"))
    taken = mixture(rows, plan).withColumn("copy", F.array_repeat(F.lit(0), F.col("reps").cast("int")))
    return taken.select("row", F.explode("copy")).select("row.*")
