"""Connected components of links, by alternating stars.

Every round points each node's larger neighbours, then its smaller ones, at its
smallest neighbour. Nodes are never gathered: a node's smallest neighbour is an
aggregate that combines on the map side, and joins back to the links. The number
of links never grows beyond nodes + links. Each round is written to the shared
folder; links that are stars already take one round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riverloom.session import saved


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.least("a", F.min("b")).alias("low"))
    return (
        both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()
    )


def _small_star(links: DataFrame) -> DataFrame:
    """links: a > b."""
    low = links.groupBy("a").agg(F.min("b").alias("low"))
    moved = links.join(low, "a").where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return moved.unionByName(low.select("a", F.col("low").alias("b"))).distinct()


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % 1_000_000_007)).first())


def components(links: DataFrame) -> DataFrame:
    """(id, component) for every node of the links (a, b): the smallest reachable node.

    Links may repeat, point either way or at their own node; a node that only links
    to itself may be missing. Null ends are no links. No links give no rows.
    """
    links = saved(
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"), F.col("a").isNull().alias("n"), F.col("b").isNull().alias("m"))
        .where("a <> b AND NOT n AND NOT m")
        .select("a", "b")
        .distinct(),
        "links",
    )
    before = _state(links)
    while before[0]:
        links = saved(_small_star(_large_star(links)), "links")
        after = _state(links)
        if after == before:
            break
        before = after
    roots = links.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    return links.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(roots)
