"""Pointer doubling over linked rows (list ranking; Wyllie, 1979)."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from riverloom.operators.joins import grown, keyed_join
from riverloom.session import saved

# Joins between two writes; three of them multiply the hops covered by four.
STEPS = 3


def _step(rows: DataFrame, ahead: DataFrame) -> DataFrame:
    """Move every pointer on by the hops that its target has covered.

    Rows before and after a target with the same smallest key hold that key twice, so the
    row runs into a cycle, as does one whose target does: such a row has no ``last``.
    """
    again = (F.col("low") == F.col("low2")) | F.col("last").isNull() | F.col("last2").isNull()
    turns = F.col("p2").isNotNull() & again
    return keyed_join(rows, ahead, ["p"], "left").select(
        "k",
        F.col("p2").alias("p"),
        F.when(turns, None).otherwise(F.coalesce("last2", "last")).alias("last"),
        (F.col("total") + F.coalesce("total2", F.lit(0.0))).alias("total"),
        F.least("low", "low2").alias("low"),
    )


def _saved(rows: DataFrame, moving: Column, turning: Column) -> tuple[DataFrame, int, int]:
    """Written rows, with how many move and how many turn; never zero if there are any."""
    seen = Observation()
    counts = [F.count(F.when(c, 1)).alias(n) for n, c in (("moving", moving), ("turning", turning))]
    state = saved(rows.observe(seen, *counts), "pointers")
    return state, seen.get["moving"], seen.get["turning"]


def follow_pointers(
    links: DataFrame, key: str, to: str, weight: str, cycles: str = "raise"
) -> DataFrame:
    """Follow ``to`` from every row to the end of its path.

    Returns ``(key, last, total)``: the last key of the path and the sum of
    ``weight`` over the hops. A path ends at a null ``to``, or at a ``to`` that
    names no row. Each round joins the moving rows three times with the state
    (whose shuffle is shared), so that all hops covered so far are covered four
    times over and a path of n rows takes log4(n) rounds. What has moved is written
    to the shared folder once a round, or the plan would grow with it; rows
    that have arrived are written once.

    Rows that pass one key twice, or still move after the rounds a path of all rows
    would take, run into a cycle; the former are moved no more.
    By ``cycles`` that is an error ("raise"), or they get a null
    last and total ("null"), or the smallest key of the cycle becomes its end
    ("break", for links where no two rows share a ``to``).
    """
    name, target = F.col(key).alias("k"), F.col(to).alias("p")
    base = links.select(name, target, F.col(weight).cast("double").alias("w"))
    arrives = F.col("p").isNull()
    moving = ~arrives & F.col("last").isNotNull()
    turning = ~arrives & F.col("last").isNull()
    state, n, turned = _saved(
        base.select(
            "k",
            "p",
            F.coalesce("p", "k").alias("last"),
            F.when(F.col("p").isNotNull(), F.col("w")).otherwise(0.0).alias("total"),
            F.col("k").alias("low"),
        ),
        moving,
        turning,
    )
    rounds = math.ceil(math.log2(n + 2) / 2) + 1
    settled = []
    while n and rounds:
        # rows that have arrived or turn are looked up, but neither shuffled as moving nor written again
        settled.append(state.filter(~moving))
        ahead = reduce(DataFrame.unionByName, settled, state.filter(moving)).select(
            F.col("k").alias("p"),
            F.col("p").alias("p2"),
            F.col("last").alias("last2"),
            F.col("total").alias("total2"),
            F.col("low").alias("low2"),
        )
        moved = state.filter(moving)
        for _ in range(STEPS):
            moved = _step(moved, ahead)
        state, n, more = _saved(moved, moving, turning)
        turned += more
        rounds -= 1
    rows = reduce(DataFrame.unionByName, settled, state)
    result = rows.filter(arrives).select("k", "last", "total")
    left = n + turned
    if left and cycles == "raise":
        raise ValueError(f"{left} rows run into a cycle")
    if left and cycles == "null":
        result = rows.select("k", *[F.when(arrives, F.col(c)).alias(c) for c in ("last", "total")])
    elif left:
        opened = base.join(grown(rows.filter(~arrives).select("k", "low")), "k").select(
            "k", F.when(F.col("k") != F.col("low"), F.col("p")).alias("p"), "w"
        )
        result = result.unionByName(follow_pointers(opened, "k", "p", "w"))
    return result.withColumnRenamed("k", key)
