"""Splitting and merging of river lines."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riverloom.functions.columns import null_where
from riverloom.functions.geometry import (
    cut_line,
    first_vertex,
    last_vertex,
    line_length,
    point_at,
    snap_grid,
)
from riverloom.operators.containment import (
    crossing_pairs,
    grid_plan,
    line_edges,
    points_in_polygons,
    ring_edges,
)
from riverloom.operators.grid import total_length
from riverloom.operators.joins import grown, keyed_join
from riverloom.operators.pointers import follow_pointers
from riverloom.session import saved


def _positions() -> str:
    """Position (vertex number plus share) at which an edge cuts its segment."""
    det = "nullif((x2 - x1) * (ey2 - ey1) - (y2 - y1) * (ex2 - ex1), 0D)"
    t = f"(((ex1 - x1) * (ey2 - ey1) - (ey1 - y1) * (ex2 - ex1)) / {det})"
    u = f"(((ex1 - x1) * (y2 - y1) - (ey1 - y1) * (x2 - x1)) / {det})"
    return f"CASE WHEN {t} BETWEEN 0 AND 1 AND {u} BETWEEN 0 AND 1 THEN seg + round({t}, 9) END"


def cut_positions(
    lines: DataFrame, edges: DataFrame, line_id: str, by: list[str], cell: float
) -> DataFrame:
    """Sorted cut positions per line, where polygon edges with equal ``by`` cross it.

    Shares are rounded to 1e-9, so a border through a vertex cuts once. A
    collinear edge does not cut.
    """
    segs = line_edges(lines, [line_id, *by])
    edges = edges.select(*by, "x1", "y1", "x2", "y2")
    return (
        crossing_pairs(segs, edges, by, cell)
        .selectExpr(line_id, f"{_positions()} AS p")
        .filter("p IS NOT NULL")
        .groupBy(line_id)
        .agg(F.sort_array(F.collect_set("p")).alias("cuts"))
    )


class Split(NamedTuple):
    """``pieces``: one row per piece; ``shares``: length per (piece, source line)."""

    pieces: DataFrame
    shares: DataFrame


def chain(ends: DataFrame, key: str, axis: str) -> DataFrame:
    """Chains of lines that touch head to tail: ``(key, head, rank)``.

    ``ends`` has key, axis, start, stop. Two lines are joined where exactly one
    line of the axis ends and exactly one begins. A closed chain is opened at
    its smallest key.
    """
    starts = ends.groupBy(axis, F.col("start").alias("node")).agg(
        F.count(F.lit(1)).alias("n_in"), F.min(key).alias("after")
    )
    stops = ends.groupBy(axis, F.col("stop").alias("node")).agg(
        F.count(F.lit(1)).alias("n_out"), F.min(key).alias("before")
    )
    joints = (
        starts.join(grown(stops), [axis, "node"])
        .filter((F.col("n_in") == 1) & (F.col("n_out") == 1) & (F.col("after") != F.col("before")))
        .select(F.col("after").alias(key), "before")
    )
    links = ends.select(key).join(grown(joints), key, "left").withColumn("__one", F.lit(1.0))
    ranked = follow_pointers(links, key, "before", "__one", cycles="break")
    return ranked.select(key, F.col("last").alias("head"), F.col("total").cast("long").alias("rank"))


def oriented(lines: DataFrame, key: str, axis: str = "axis", geom: str = "geom") -> DataFrame:
    """Reverse lines so that those joined in a chain all run the same way.

    Two lines are joined where they, and no third end of the axis, meet. The way
    most lines of a chain are drawn is kept, on a tie the one that begins with
    the smaller key. Each line is walked both ways, so a chain is two paths of
    the same lines, and the better path tells which of its lines to turn. Where
    all lines already run head to tail, which is usual, nothing but the ends is
    looked at.
    """
    sides = F.explode(
        F.array(
            F.struct(first_vertex(F.col(geom)).alias("node"), F.lit(False).alias("at_end")),
            F.struct(last_vertex(F.col(geom)).alias("node"), F.lit(True).alias("at_end")),
        )
    ).alias("side")
    ends = lines.select(F.col(key).alias("k"), axis, sides).select("k", axis, "side.*")
    joints = saved(
        ends.groupBy(axis, "node")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min(F.struct("k", "at_end")).alias("a"),
            F.max(F.struct("k", "at_end")).alias("b"),
        )
        .filter((F.col("n") == 2) & (F.col("a.k") != F.col("b.k")))
        .select("a", "b"),
        "joints",
    )
    if joints.filter("a.at_end = b.at_end").isEmpty():
        return lines
    # (k, back): the line walked along, or against, its vertices
    step = joints.select("a", "b").unionByName(joints.select(F.col("b").alias("a"), F.col("a").alias("b")))
    step = step.select(
        F.struct(F.col("a.k").alias("k"), (~F.col("a.at_end")).alias("back")).alias("h"),
        F.struct(F.col("b.k").alias("k"), F.col("b.at_end").alias("back")).alias("to"),
    )
    walks = lines.select(
        F.explode(F.array(*[F.struct(F.col(key).alias("k"), F.lit(b).alias("back")) for b in (False, True)])).alias("h")
    )
    links = walks.join(grown(step), "h", "left").withColumn("one", F.lit(1.0))
    paths = follow_pointers(links, "h", "to", "one", cycles="break").select("h", "last")
    votes = paths.groupBy("last").agg(F.count(F.when(~F.col("h.back"), 1)).alias("votes"))
    paths = saved(paths.join(grown(votes), "last"), "paths")
    rank = F.struct(-F.col("votes"), "last")
    along = paths.filter("NOT h.back").select(F.col("h.k").alias(key), rank.alias("along"))
    against = paths.filter("h.back").select(F.col("h.k").alias(key), rank.alias("against"))
    turned = along.join(grown(against), key).filter("against < along").select(key, F.lit(True).alias("__turn"))
    return (
        lines.join(grown(turned), key, "left")
        .withColumn(geom, F.when(F.col("__turn"), F.reverse(geom)).otherwise(F.col(geom)))
        .select(*lines.columns)
    )


def _joined(parts: Column) -> Column:
    """Concatenate lines that touch, each joint vertex once."""
    return F.flatten(
        F.transform(parts, lambda g, i: F.when(i == 0, g).otherwise(F.slice(g, 2, F.size(g))))
    )


def split_lines(
    lines: DataFrame,
    polygons: DataFrame,
    line_id: str = "fid",
    axis: str = "axis",
    measure: str = "m",
    carry: tuple[str, ...] = ("drainage",),
    cell: float | None = None,
) -> Split:
    """Cut the lines of each axis at the borders of its swaths and label the pieces.

    Every line is cut by itself: its cut positions come from an equi-join on
    (axis, grid cell), and the pieces are made inside its row. Pieces that meet
    at a joint of two lines, without a border there, are then joined into one,
    so the result does not depend on how the axis was divided into lines, nor on
    which way each was drawn. Only
    the pieces at line ends take part in that. A piece lies in one swath or in
    none, so one inner point tells which. Pieces outside keep the axis and have
    null swath columns; a piece in two swaths gives two rows.
    """
    lines = lines.select(F.col(line_id).alias("fid"), axis, "geom").filter(F.size("geom") >= 2)
    lines = oriented(lines, "fid", axis)
    edges = ring_edges(polygons, [axis, measure])
    plan = grid_plan(edges, [axis, measure])
    if cell is None:
        n, length = total_length(line_edges(lines, ["fid"]))
        cell = (length + plan.length) / max(n + plan.edges, 1) or 1.0
    cuts = cut_positions(lines, edges, "fid", [axis], cell)
    # used for the joints, the merged geometry, the shares and the labels
    parts = saved(_pieces_of_lines(lines.join(grown(cuts), "fid", "left"), axis), "pieces")

    members = follow_pointers(
        _links_over_joints(parts, axis), "key", "before", "one", cycles="break"
    ).select("key", F.col("last").alias("piece"), F.col("total").cast("long").alias("rank"))
    at_end = (F.col("key.no") == 1) | (F.col("key.no") == F.col("n"))
    columns = ["piece", "rank", axis, "fid", "geom"]
    alone = parts.filter(~at_end).select(
        F.col("key").alias("piece"), F.lit(0).cast("long").alias("rank"), axis, "fid", "geom"
    )
    chained = parts.filter(at_end).join(grown(members), "key").select(*columns)
    # a piece is bounded by its swath, or by the river where there are none
    merged = (
        chained.groupBy("piece", axis)
        .agg(F.sort_array(F.collect_list(F.struct("rank", "geom"))).alias("members"))
        .select("piece", axis, _joined(F.transform("members", lambda s: s["geom"])).alias("geom"))
    )
    pieces = alone.select("piece", axis, "geom").unionByName(merged)

    every = alone.unionByName(chained)
    shares = every.groupBy("piece", "fid").agg(
        F.sum(line_length(F.col("geom"))).alias("length")
    )
    inside = point_at(F.col("geom"), F.lit(0.5))
    probes = every.filter(F.col("rank") == 0).select(
        "piece", axis, inside["x"].alias("x"), inside["y"].alias("y")
    )
    labels = points_in_polygons(
        probes, edges, [axis, measure], by=[axis], plan=plan
    ).join(grown(polygons.select(axis, measure, *carry)), [axis, measure])
    labelled = pieces.join(grown(labels.select("piece", measure, *carry)), "piece", "left")
    return Split(labelled.select("piece", axis, measure, *carry, "geom"), shares)


def _pieces_of_lines(lines: DataFrame, axis: str) -> DataFrame:
    """Cut every line at its ``cuts``, inside its row; numbered from 1 to ``n``.

    ``head_cut`` and ``tail_cut`` tell whether a border runs through an end.
    """
    whole = (F.size("geom") - 1).cast("double")
    none = F.array().cast("array<double>")
    bounded = lines.withColumn("cuts", F.coalesce("cuts", none)).select(
        "fid",
        axis,
        "geom",
        F.concat(
            F.array(F.lit(0.0)), F.filter("cuts", lambda p: (p > 0) & (p < whole)), F.array(whole)
        ).alias("b"),
        F.array_contains("cuts", F.lit(0.0)).alias("head_cut"),
        F.array_contains("cuts", whole).alias("tail_cut"),
    )
    n = F.size("b") - 1
    made = F.transform(
        F.sequence(F.lit(1), n),
        lambda k: F.struct(
            k.alias("no"), cut_line(F.col("geom"), F.get("b", k - 1), F.get("b", k)).alias("geom")
        ),
    )
    return bounded.select(
        "fid", axis, n.alias("n"), "head_cut", "tail_cut", F.explode(made).alias("p")
    ).select(
        F.struct("fid", F.col("p.no").alias("no")).alias("key"),
        "fid",
        axis,
        "n",
        "head_cut",
        "tail_cut",
        "p.geom",
    )


def _links_over_joints(parts: DataFrame, axis: str) -> DataFrame:
    """End pieces ``key`` with the piece ``before`` them across a joint, if any.

    A joint is a node where, on this axis, one line ends and one other line
    begins, and through which no border runs. Inner pieces have no part in it.
    """
    first, last = F.col("key.no") == 1, F.col("key.no") == F.col("n")
    heads = parts.filter(first).groupBy(
        axis, first_vertex(F.col("geom")).alias("node")
    ).agg(F.count(F.lit(1)).alias("n_in"), F.min(F.struct("key", "head_cut")).alias("a"))
    tails = parts.filter(last).groupBy(
        axis, last_vertex(F.col("geom")).alias("node")
    ).agg(F.count(F.lit(1)).alias("n_out"), F.min(F.struct("key", "tail_cut")).alias("b"))
    joints = (
        heads.join(grown(tails), [axis, "node"])
        .filter(
            (F.col("n_in") == 1)
            & (F.col("n_out") == 1)
            & (F.col("a.key.fid") != F.col("b.key.fid"))
            & ~F.col("a.head_cut")
            & ~F.col("b.tail_cut")
        )
        .select(F.col("a.key").alias("key"), F.col("b.key").alias("before"))
    )
    ends = parts.filter(first | last).select("key")
    return ends.join(grown(joints), "key", "left").withColumn("one", F.lit(1.0))


def keep_longest(
    pieces: DataFrame, axis: str = "axis", measure: str = "m", length: str = "leng"
) -> DataFrame:
    """Of pieces that share (axis, measure), only the longest keep their measure.

    Shorter ones get a null measure and stay; ties at the maximum all keep it.
    The maximum per position is an aggregate joined back, so null measures,
    which are most of the rows of an axis without swaths, are never gathered.
    """
    longest = (
        pieces.filter(F.col(axis).isNotNull() & F.col(measure).isNotNull())
        .groupBy(axis, measure)
        .agg(F.max(length).alias("__max"), F.count(F.lit(1)).alias("__n"))
        .filter(F.col("__n") > 1)
        .drop("__n")
    )
    marked = keyed_join(pieces, longest, [axis, measure], "left")
    return marked.withColumn(
        measure, null_where(F.col(measure), F.col(length) < F.col("__max"))
    ).drop("__max")


def largest_overlap(
    shares: DataFrame,
    reaches: DataFrame,
    value: str = "strahler",
    piece: tuple[str, ...] = ("piece",),
) -> DataFrame:
    """Value of the reach that makes up most of each piece; lowest ``fid`` on a tie."""
    weighed = (
        shares.groupBy(*piece, "fid")
        .agg(F.sum("length").alias("length"))
        .join(grown(reaches.select("fid", value)), "fid", "left")
    )
    return weighed.groupBy(*piece).agg(
        F.max_by(value, F.struct(F.col("length"), -F.col("fid"))).alias(value)
    )


def merge_lines(
    lines: DataFrame, key: str, axis: str = "axis", geom: str = "geom", size: float = 1e-5
) -> DataFrame:
    """Join the lines of an axis that touch at their ends, after snapping to a grid.

    Which way a line was drawn does not matter, see :func:`oriented`. Returns ``(axis, line_no, geom)``. ``line_no`` numbers nothing in order: it
    is derived from the head of the chain. A row is as long as its river.
    """
    snapped = lines.select(key, axis, snap_grid(F.col(geom), size).alias("geom")).filter(
        F.size("geom") >= 2
    )
    snapped = oriented(snapped, key, axis)
    ends = snapped.select(
        key,
        axis,
        first_vertex(F.col("geom")).alias("start"),
        last_vertex(F.col("geom")).alias("stop"),
    )
    ranked = chain(ends, key, axis)
    return (
        snapped.join(grown(ranked), key)
        .groupBy(axis, "head")
        .agg(
            F.transform(
                F.sort_array(F.collect_list(F.struct("rank", "geom"))), lambda s: s["geom"]
            ).alias("geoms")
        )
        .select(
            axis,
            F.xxhash64(axis, "head").alias("line_no"),
            _joined(F.col("geoms")).alias("geom"),
        )
    )
