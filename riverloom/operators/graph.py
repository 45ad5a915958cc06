"""Undirected graphs of lines: components, and distances from chosen nodes.

Edges have ``e`` (a key), ``a``, ``b`` (nodes) and ``len``; nodes and keys may be of any type
that can be compared. An edge that begins and ends at one node is of no use for distances.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riverloom.operators.joins import grown, hot_join
from riverloom.operators.pointers import follow_pointers
from riverloom.session import saved, saved_and_counted

# Steps of a relaxation between two writes.
STEPS = 3


def _walk(e: Column, back: bool) -> Column:
    return F.struct(e.alias("e"), F.lit(back).alias("back"))


def _both_ways(edges: DataFrame) -> DataFrame:
    arc = F.explode(F.array(F.struct(F.col("a").alias("u"), F.col("b").alias("v")), F.struct(F.col("b").alias("u"), F.col("a").alias("v"))))
    return edges.select(arc.alias("arc"), "len").select("arc.u", "arc.v", "len")


class Chains(NamedTuple):
    """``members``: each edge with the ends of its two walks (``to_b``, ``to_a``: the last walk of
    the chain in that direction) and what is left from its own end to there (``past_b``,
    ``past_a``). ``chains``: one row for each chain, as an edge: e (the smaller of its two last
    walks, which leads to b), other, a, b, len, whether each end is a leaf, and ``inner``,
    whether it may be part of a way between others. ``n_inner`` and ``n`` count these and members."""

    members: DataFrame
    chains: DataFrame
    n_inner: int
    n: int


def contract(edges: DataFrame, stops: DataFrame) -> Chains:
    """Chains of edges over nodes at which just two edges meet; ``stops`` (n) are never passed.

    Every edge is walked in both directions, and a walk goes on to the other edge of its end
    node. A walk is followed by one other at most, so list ranking by pointer doubling tells
    where it ends and how long the rest is. Rings without a stop belong to no chain.
    """
    side = F.explode(
        F.array(
            F.struct(F.col("a").alias("n"), F.lit(False).alias("at_b")),
            F.struct(F.col("b").alias("n"), F.lit(True).alias("at_b")),
        )
    )
    ends = edges.select("e", "len", side.alias("s")).select("s.n", F.struct("e", "s.at_b", "len").alias("end"))
    stop = stops.select("n", F.lit(1).alias("stop")).distinct()
    met = ends.groupBy("n").agg(F.count(F.lit(1)).alias("k"), F.min("end").alias("x"), F.max("end").alias("y"))
    met = saved(met.join(grown(stop), "n", "left"), "graph-nodes")
    through = met.where("k = 2 AND stop IS NULL")
    steps = through.select("x", "y").unionByName(through.select(F.col("y").alias("x"), F.col("x").alias("y")))
    steps = steps.select(
        F.struct(F.col("x.e").alias("e"), (~F.col("x.at_b")).alias("back")).alias("h"),
        F.struct(F.col("y.e").alias("e"), F.col("y.at_b").alias("back")).alias("to"),
        F.col("y.len").alias("hop"),
    )
    walks = edges.select(F.explode(F.array(_walk(F.col("e"), False), _walk(F.col("e"), True))).alias("h"))
    ranked = follow_pointers(walks.join(grown(steps), "h", "left"), "h", "to", "hop", cycles="null")
    back = F.col("h.back")
    totals = ranked.where("last IS NOT NULL").groupBy(F.col("h.e").alias("e")).agg(
        F.max(F.when(~back, F.col("last"))).alias("to_b"), F.max(F.when(~back, F.col("total"))).alias("past_b"),
        F.max(F.when(back, F.col("last"))).alias("to_a"), F.max(F.when(back, F.col("total"))).alias("past_a"),
    )
    members, n = saved_and_counted(edges.join(grown(totals), "e"), "graph-members", F.lit(True))
    whole = F.col("past_a") + F.col("len") + F.col("past_b")
    along, against = _walk(F.col("e"), False), _walk(F.col("e"), True)
    last = members.where(F.col("to_b") == along).select(
        along.alias("t"), F.col("to_a").alias("o"), F.col("b").alias("n"), whole.alias("len")
    ).unionByName(
        members.where(F.col("to_a") == against).select(
            against.alias("t"), F.col("to_b").alias("o"), F.col("a").alias("n"), whole.alias("len")
        )
    )
    leaf = met.where("k = 1 AND stop IS NULL").select("n", F.lit(True).alias("leaf"))
    last = last.join(grown(leaf), "n", "left").select("t", "o", "n", "len", F.coalesce("leaf", F.lit(False)).alias("leaf"))
    far = last.select(F.col("t").alias("o"), F.col("n").alias("a"), F.col("leaf").alias("leaf_a"))
    inner = ~F.col("leaf_a") & ~F.col("leaf") & (F.col("a") != F.col("n"))
    chains = last.where(F.col("t") < F.col("o")).join(grown(far), "o").select(
        F.col("t").alias("e"), F.col("o").alias("other"), "a", F.col("n").alias("b"), "len", "leaf_a",
        F.col("leaf").alias("leaf_b"), inner.alias("inner"),
    )
    chains, n_inner = saved_and_counted(chains, "graph-chains", F.col("inner"))
    return Chains(members, chains, n_inner, n)


def components(links: DataFrame) -> DataFrame:
    """Nodes of links (u, v) with their component: ``(n, component)``, the smallest node in it.

    Every node points to its smallest neighbour if that is smaller, pointers are followed to
    their ends, links are renamed to these, and so on. Each round at least halves the number
    of nodes that still have links, so there are about log2(n) of them.
    """
    both = links.select("u", "v").unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    names = None
    left, n = saved_and_counted(both.where("u != v").distinct(), "graph-links", F.lit(True))
    nodes = saved(both.select(F.col("u").alias("n")).distinct(), "graph-names")
    while n:
        smallest = left.groupBy("u").agg(F.min("v").alias("v"), F.lit(1.0).alias("one"))
        smaller = smallest.select("u", F.when(F.col("v") < F.col("u"), F.col("v")).alias("v"), "one")
        roots = saved(follow_pointers(smaller, "u", "v", "one").select("u", F.col("last").alias("root")), "graph-roots")
        if names is None:
            names = nodes.join(grown(roots.withColumnRenamed("u", "n")), "n", "left").select("n", F.coalesce("root", "n").alias("component"))
        else:
            again = roots.select(F.col("u").alias("component"), "root")
            names = names.join(grown(again), "component", "left").select("n", F.coalesce("root", "component").alias("component"))
        names = saved(names, "graph-names")
        ends = roots.select(F.col("u").alias("v"), F.col("root").alias("to"))
        renamed = left.join(grown(roots), "u").join(grown(ends), "v").where("root != to")
        left, n = saved_and_counted(renamed.select(F.col("root").alias("u"), F.col("to").alias("v")).distinct(), "graph-links", F.lit(True))
    return names if names is not None else nodes.select("n", F.col("n").alias("component"))


def relax(edges: DataFrame, outlets: DataFrame) -> DataFrame:
    """Distance ``d`` of every node ``n`` that can reach an outlet (n), by frontier relaxation.

    Only nodes that have come nearer in the last step hand on their distance; candidates are
    reduced to the least on the map side. For graphs that :func:`contract` has made small: the
    number of steps is that of the edges on the longest of the shortest ways.
    """
    arcs = saved(_both_ways(edges.where("a != b")), "graph-arcs")
    known = saved(outlets.select("n").distinct().select("n", F.lit(0.0).alias("d"), F.lit(True).alias("new")), "graph-known")
    n = 1
    while n:
        for _ in range(STEPS):
            offered = known.where("new").join(grown(arcs), F.col("n") == F.col("u")).select(
                F.col("v").alias("n"), (F.col("d") + F.col("len")).alias("d"), F.lit(False).alias("old")
            )
            had = known.select("n", "d", F.lit(True).alias("old"))
            nearest = offered.unionByName(had).groupBy("n").agg(
                F.min("d").alias("d"), F.min(F.when(F.col("old"), F.col("d"))).alias("before")
            )
            known = nearest.select("n", "d", (F.col("before").isNull() | (F.col("d") < F.col("before"))).alias("new"))
        known, n = saved_and_counted(known, "graph-known", F.col("new"))
    return known.select("n", "d")


def end_distances(edges: DataFrame, outlets: DataFrame, chains: Chains | None = None) -> DataFrame:
    """``(e, d_a, d_b)``: the shortest way from both ends of every edge to the nearest outlet
    (n); null where there is none.

    Rake and compress (Miller and Reif, 1985): chains become single edges, and those that end
    in a leaf are taken off, as no way leads through them; what is left has chains again, and
    so on. A forest is used up in about log(n) rounds, whatever its shape; of other graphs the
    part with rings is left, on which distances are relaxed. Then the rounds are undone.
    Results do not depend on the direction of edges, and neither does the number of rounds.
    """
    chains = chains or contract(edges, outlets)
    rest = chains.chains.where("inner").select("e", "a", "b", "len")
    reached = outlets.select("n", F.lit(0.0).alias("d"))
    if chains.n_inner:
        if chains.n_inner < chains.n:
            inner = end_distances(rest, outlets)
            ends = rest.join(grown(inner), "e").select(F.explode(F.array(F.struct(F.col("a").alias("n"), F.col("d_a").alias("d")), F.struct(F.col("b").alias("n"), F.col("d_b").alias("d")))).alias("x"))
            reached = reached.unionByName(ends.select("x.n", "x.d"))
        else:
            reached = reached.unionByName(relax(rest, outlets))
    reached = saved(reached.where("d IS NOT NULL").groupBy("n").agg(F.min("d").alias("d")), "graph-distances")
    at = chains.chains.join(grown(reached.select(F.col("n").alias("a"), F.col("d").alias("at_a"))), "a", "left")
    at = at.join(grown(reached.select(F.col("n").alias("b"), F.col("d").alias("at_b"))), "b", "left")
    # the chain's own end b is that of its walk e, a that of the other
    at = at.select(F.col("e").alias("chain"), F.col("at_b").alias("d_chain"), F.col("at_a").alias("d_other"))
    first = F.least("to_a", "to_b")
    members = hot_join(chains.members.withColumn("chain", first), at, ["chain"], "left")
    to_b = F.when(F.col("to_b") == first, F.col("d_chain")).otherwise(F.col("d_other")) + F.col("past_b")
    to_a = F.when(F.col("to_a") == first, F.col("d_chain")).otherwise(F.col("d_other")) + F.col("past_a")
    found = members.select("e", F.least(to_a, to_b + F.col("len")).alias("d_a"), F.least(to_b, to_a + F.col("len")).alias("d_b"))
    return edges.select("e").join(grown(found), "e", "left")
