"""Directed line network: nodes, distance from the outlet, points along lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riverloom.functions.geometry import distance, first_vertex, last_vertex, line_length, line_segments
from riverloom.operators import graph
from riverloom.operators.grid import SHIFT, SLACK, cell_of, segment_cells, total_length
from riverloom.operators.joins import grown, hot_join
from riverloom.operators.pointers import follow_pointers
from riverloom.session import saved

NODE_CELL = 1e-3


def node(vertex: Column, cell: float = NODE_CELL) -> Column:
    """Node id: the quantised position itself, so that ids never collide."""
    return F.struct(
        F.round(vertex["x"] / cell).cast("long").alias("qx"),
        F.round(vertex["y"] / cell).cast("long").alias("qy"),
    )


def identify_nodes(lines: DataFrame, geom: str = "geom", cell: float = NODE_CELL) -> DataFrame:
    """Add ``node_a`` and ``node_b``; line ends within one cell share a node."""
    return lines.withColumns(
        {
            "node_a": node(first_vertex(F.col(geom)), cell),
            "node_b": node(last_vertex(F.col(geom)), cell),
        }
    )


def drop_degenerate(edges: DataFrame) -> DataFrame:
    """Remove edges that begin and end at one node."""
    return edges.filter(F.col("node_a") != F.col("node_b"))


def measure_from_outlet(
    edges: DataFrame,
    edge_id: str = "edge_id",
    axis: str = "axis",
    length: str = "length",
    rising: str | None = None,
    outlets: DataFrame | None = None,
) -> DataFrame:
    """Add ``measure``: the shortest way from an edge's lower end to the nearest outlet of its
    axis, and ``along``: whether ``node_b`` is the lower end.

    Ways run over edges of the axis in either direction, so that neither depends on how a line
    was drawn, through forks, braids and rings. The edge at an outlet has measure 0. Edges that
    no way joins to an outlet, with a null axis or node, or degenerate, have a null measure.

    ``outlets`` (axis, node) names the outlets. Without it they are found: ``rising`` is a column
    that grows downstream, such as the drained area. Where the leaves of a connected part
    differ in it (by the first edge with a value from the leaf on, or at the first fork), the
    leaf with the largest value is the outlet. Elsewhere vertex order decides: an outlet is a node at which edges end and
    none begins.
    """
    end = {n: F.struct(F.col(axis).alias("axis"), F.col(n).alias("node")) for n in ("node_a", "node_b")}
    value = F.lit(None).cast("double") if rising is None else F.col(rising).cast("double")
    net = edges.filter(" AND ".join(f"{c} IS NOT NULL" for c in (axis, "node_a", "node_b"))).select(
        F.col(edge_id).alias("e"), end["node_a"].alias("a"), end["node_b"].alias("b"),
        F.col(length).cast("double").alias("len"), value.alias("value"),
    )
    net = saved(net.filter("a != b"), "network")
    if outlets is not None:
        stops = outlets.select(F.struct(F.col(axis).alias("axis"), "node").alias("n")).distinct()
        found = _undirected(net, stops, None)
    else:
        downstream, doubtful = _downstream(net, rising is not None)
        found = downstream.select("e", "measure", F.lit(True).alias("along"))
        if not doubtful.isEmpty():
            rest = hot_join(net.withColumn("axis", F.col("a.axis")), doubtful, ["axis"], "left_semi").drop("axis")
            begins = rest.select(F.col("a").alias("n"), F.lit(1).alias("out"))
            sinks = rest.select(F.col("b").alias("n"), F.lit(0).alias("out")).unionByName(begins)
            sinks = saved(sinks.groupBy("n").agg(F.max("out").alias("out")).filter("out = 0").select("n"), "sinks")
            sure = found.join(grown(net.select("e", F.col("a.axis").alias("axis"))), "e").join(doubtful, "axis", "left_anti")
            found = sure.drop("axis").unionByName(_undirected(rest, sinks, rising))
    return edges.join(grown(found.withColumnRenamed("e", edge_id)), edge_id, "left")


def _downstream(net: DataFrame, valued: bool) -> tuple[DataFrame, DataFrame]:
    """Ways along vertex order (e, measure), and the axes where these may not be the shortest
    to the right outlet: those with forks, and with ``valued`` those where a part has a higher
    value anywhere than next to its outlet, or no outlet.

    Where one edge at most leaves each node there is only one way. Edges that run into a ring
    have a null measure.
    """
    leaving = net.groupBy(F.col("a").alias("n")).agg(
        F.min(F.struct("e", "len")).alias("next"), F.count(F.lit(1)).alias("k")
    )
    leaving = saved(leaving, "leaving")
    onward = net.select("e", F.col("b").alias("n")).join(grown(leaving), "n", "left")
    links = onward.select("e", F.col("next.e").alias("to"), F.col("next.len").alias("hop"))
    ranked = follow_pointers(links, "e", "to", "hop", cycles="null").withColumnRenamed("total", "measure")
    doubtful = leaving.filter("k > 1").select("n.axis")
    if valued:
        at = net.select("e", F.col("a.axis").alias("axis"), "value").join(grown(ranked), "e")
        parts = at.groupBy("axis", "last").agg(
            F.min_by("value", F.when(F.col("value").isNotNull(), F.col("measure"))).alias("lowest"), F.max("value").alias("most")
        )
        doubtful = doubtful.unionByName(parts.filter("lowest < most OR last IS NULL").select("axis"))
    return ranked.select("e", "measure"), saved(doubtful.distinct(), "doubtful-axes")


def _undirected(net: DataFrame, stops: DataFrame, rising: str | None) -> DataFrame:
    """(e, measure, along) by the shortest way to any of the stops, or to the outlets by value."""
    chains = None
    if rising is not None:
        chains = graph.contract(net, stops.limit(0))
        stops, usable = _outlets_by_value(chains, stops)
        chains = chains if usable else None
    found = graph.end_distances(net, stops, chains)
    return found.select("e", F.least("d_a", "d_b").alias("measure"), (F.col("d_b") <= F.col("d_a")).alias("along"))


def _outlets_by_value(chains: graph.Chains, sinks: DataFrame) -> tuple[DataFrame, bool]:
    """Outlets (n) by the values of leaves, or the sinks where these do not tell; and whether
    they all are ends of the chains."""
    ends = chains.chains
    # an alone chain is a part of its own
    parts = ends.filter("leaf_a AND leaf_b").select(F.explode(F.array("a", "b")).alias("n"), F.least("a", "b").alias("component"))
    joined = ends.filter("NOT (leaf_a AND leaf_b)").select(F.col("a").alias("u"), F.col("b").alias("v"))
    parts = saved(parts.unionByName(graph.components(joined)), "network-parts")
    walked = F.explode(
        F.array(
            F.struct(F.col("to_b").alias("t"), F.col("past_b").alias("past")),
            F.struct(F.col("to_a").alias("t"), F.col("past_a").alias("past")),
        )
    )
    first = (
        chains.members.filter("value IS NOT NULL")
        .select("value", walked.alias("w"))
        .groupBy("w.t")
        .agg(F.min_by("value", F.struct("w.past", "value")).alias("value"))
    )
    tips = ends.select(F.col("b").alias("n"), F.col("e").alias("t"), F.col("a").alias("far"), F.col("leaf_b").alias("leaf"))
    tips = tips.unionByName(ends.select(F.col("a").alias("n"), F.col("other").alias("t"), F.col("b").alias("far"), F.col("leaf_a").alias("leaf")))
    tips = saved(tips.join(grown(first), "t", "left"), "network-tips")
    # a chain without a value takes what is highest where it begins
    beyond = tips.groupBy(F.col("n").alias("far")).agg(F.max("value").alias("beyond"))
    leaves = tips.filter("leaf").join(grown(beyond), "far").select("n", F.coalesce("value", "beyond").alias("value"))
    valued = leaves.filter("value IS NOT NULL").join(grown(parts), "n").join(grown(sinks.withColumn("sink", F.lit(True))), "n", "left")
    told = saved(
        valued.groupBy("component")
        .agg(
            F.min("value").alias("least"), F.max("value").alias("most"),
            F.max_by("n", F.struct("value", F.coalesce("sink", F.lit(False)), "n")).alias("n"),
        )
        .filter("least < most")
        .select("component", "n"),
        "network-outlets",
    )
    # sinks lie on chains of a part that is told, or decide themselves
    at_b = chains.members.select(F.col("b").alias("n"), F.least("to_a", "to_b").alias("e")).join(grown(sinks), "n")
    of_told = at_b.join(grown(ends.select("e", "a")), "e").join(grown(parts.withColumnRenamed("n", "a")), "a").join(grown(told.select("component")), "component")
    undecided = saved(sinks.join(grown(of_told.select("n").distinct()), "n", "left_anti"), "network-sinks")
    usable = undecided.join(grown(parts), "n", "left_anti").isEmpty()
    return told.select("n").unionByName(undecided), usable


#: segments that are handled within one row
CHUNK = 128


def measured_segments(
    lines: DataFrame, line_id: str, axis: str = "axis", geom: str = "geom", measure: str = "measure"
) -> DataFrame:
    """Segments with ``low``, the measure at their lower (last) vertex.

    Lines run downstream and ``measure`` is that of their lower end. A line is taken apart
    into chunks of ``CHUNK`` segments, and lengths are summed within the row of a chunk. The
    lengths of whole chunks are summed over the chunks of a line, so no task holds a long line;
    a line of one chunk needs no shuffle.
    """
    n = F.size(geom) - 1
    parts = F.transform(
        F.sequence(F.lit(0), F.floor((n - 1) / CHUNK).cast("int")),
        lambda k: F.slice(F.col(geom), k * CHUNK + 1, CHUNK + 1),
    )
    chunks = lines.filter(n >= 1).select(
        F.col(line_id).alias("line_id"), F.col(axis).alias(axis), F.col(measure).alias("__measure"),
        n.alias("__n"), F.posexplode(parts).alias("__chunk", "__part"),
    )
    chunks = chunks.withColumn("__length", line_length(F.col("__part")))
    short = chunks.filter(F.col("__n") <= CHUNK).withColumn("__below", F.lit(0.0))
    long = chunks.filter(F.col("__n") > CHUNK)
    after = Window.partitionBy("line_id").orderBy(F.col("__chunk").desc()).rowsBetween(Window.unboundedPreceding, -1)
    below = long.select("line_id", "__chunk", F.coalesce(F.sum("__length").over(after), F.lit(0.0)).alias("__below"))
    whole = short.unionByName(long.join(grown(below), ["line_id", "__chunk"]))
    # what is left of the chunk after each segment
    lengths = F.transform(line_segments(F.col("__part")), lambda s: distance(s["x1"], s["y1"], s["x2"], s["y2"]))
    rest = F.aggregate(
        F.reverse(lengths), F.array(F.lit(0.0)), lambda acc, d: F.concat(F.array(acc[0] + d), acc)
    )
    rows = whole.select(
        "line_id", axis, "__measure", "__below", "__chunk",
        F.posexplode(F.arrays_zip(line_segments(F.col("__part")).alias("s"), lengths.alias("d"), F.slice(rest, F.lit(2), F.size(lengths)).alias("r"))).alias("__i", "__s"),
    )
    return rows.select(
        "line_id", axis, (F.col("__chunk") * CHUNK + F.col("__i")).alias("seg"), "__s.s.x1", "__s.s.y1", "__s.s.x2", "__s.s.y2",
        F.col("__s.d").alias("leng"), (F.col("__measure") + F.col("__below") + F.col("__s.r")).alias("low"),
    )


def _foot() -> Column:
    """Share along the segment at which the point's foot lies."""
    x1, y1, x2, y2 = (F.col(c) for c in ("x1", "y1", "x2", "y2"))
    dx, dy = x2 - x1, y2 - y1
    square = dx * dx + dy * dy
    f = ((F.col("px") - x1) * dx + (F.col("py") - y1) * dy) / F.when(square != 0, square)
    return F.least(F.greatest(F.coalesce(f, F.lit(0.0)), F.lit(0.0)), F.lit(1.0))


def _feet(pairs: DataFrame, carry: list[str]) -> Column:
    """What is known of a point's foot on a segment, nearest first."""
    foot_x = F.col("x1") + F.col("f") * (F.col("x2") - F.col("x1"))
    foot_y = F.col("y1") + F.col("f") * (F.col("y2") - F.col("y1"))
    return F.struct(
        distance(F.col("px"), F.col("py"), foot_x, foot_y).alias("distance"),
        "line_id",
        "seg",
        "f",
        foot_x.alias("x"),
        foot_y.alias("y"),
        *carry,
    )


def _nearer_end() -> Column:
    ends = [
        F.struct(
            distance(F.col("px"), F.col("py"), F.col(f"x{k}"), F.col(f"y{k}")).alias("distance"),
            F.col(f"x{k}").alias("x"),
            F.col(f"y{k}").alias("y"),
        )
        for k in (1, 2)
    ]
    return F.least(*ends)


def _finite(*columns: str) -> Column:
    return F.expr(" AND ".join(f"{c} IS NOT NULL AND NOT isnan({c}) AND abs({c}) < 1e300" for c in columns))


def snap_to_lines(
    points: DataFrame,
    segments: DataFrame,
    tolerance: float = 100.0,
    x: str = "x",
    y: str = "y",
    prefer_vertices: bool = False,
) -> DataFrame:
    """Move points onto the nearest line; those beyond the tolerance go.

    ``segments`` has line_id, seg, x1..y2. The smallest line id decides ties.
    With ``prefer_vertices`` a point goes to the nearest vertex of a line if one
    lies within the tolerance. Points are looked up by position, once for equal
    ones; rows keep their number. Points without finite coordinates go.

    A point's candidates are the segments in the 3 x 3 cells around it. The
    points, being few and narrow, are copied to the nine cells; each candidate
    is reduced on the map side to the best so far.
    """
    p = points.select(F.col(x).alias("px"), F.col(y).alias("py")).filter(_finite("px", "py")).distinct()
    s = segments.select("line_id", "seg", "x1", "y1", "x2", "y2")

    def around(value: str) -> Column:
        c = cell_of(F.col(value), tolerance)
        return F.explode(F.sequence(c - 1, c + 1))

    copied = p.withColumn("cx", around("px")).withColumn("cy", around("py"))
    pairs = copied.join(grown(segment_cells(s, tolerance)), ["cx", "cy"]).withColumn("f", _foot())
    best = pairs.groupBy("px", "py").agg(
        F.min(_feet(pairs, [])).alias("b"), F.min(_nearer_end()).alias("v")
    )
    near = best.filter(F.col("b.distance") <= tolerance)
    at = F.col("b")
    if prefer_vertices:
        at = F.when(F.col("v.distance") <= tolerance, F.col("v")).otherwise(
            F.struct("b.distance", "b.x", "b.y")
        )
    moved = near.select("px", "py", at.alias("to")).select(
        "px", "py", F.col("to.x").alias("__x"), F.col("to.y").alias("__y"),
        F.col("to.distance").alias("snap_distance"),
    )
    return (
        points.join(grown(moved), (F.col(x) == F.col("px")) & (F.col(y) == F.col("py")))
        .withColumns({x: F.col("__x"), y: F.col("__y")})
        .select(*points.columns, "snap_distance")
    )


# Cells of a level lie in cells of this many times their size in the next.
FANOUT = 8


def _hopeful(candidates: DataFrame, cell: float, level: int) -> DataFrame:
    """Of each point's candidate cells, those that may hold its nearest segment.

    Every cell holds a piece of a segment, so the nearest one is at most as far
    as the farthest corner of any candidate.
    """
    near, far = [], []
    for p, c in (("px", "cx"), ("py", "cy")):
        low, high = ((F.col(c) + k) * FANOUT**level * cell + SHIFT * cell for k in (0, 1))
        near.append(F.greatest(low - F.col(p), F.col(p) - high, F.lit(0.0)))
        far.append(F.greatest(high - F.col(p), F.col(p) - low))
    slack = 4 * SLACK * cell
    of_point = Window.partitionBy("axis", "px", "py")
    return (
        candidates.withColumn("__near", F.hypot(*near) - slack)
        .withColumn("__least", F.min(F.hypot(*far) + slack).over(of_point))
        .filter("__near <= __least")
        .drop("__near", "__least")
    )


def locate_points(
    points: DataFrame,
    segments: DataFrame,
    cell: float = 100.0,
    axis: str = "axis",
    x: str = "x",
    y: str = "y",
) -> DataFrame:
    """Add ``distance_axis``: position of each point along its own axis.

    ``segments`` come from :func:`measured_segments`; they are read several
    times, so a computed table is better saved first. The cells that an axis
    passes form a pyramid. A point starts with the few top cells of its axis and
    goes down level by level; cells that are farther away than some other is at
    most are left behind. So a point meets a few cells on each level, and the
    segments of the last few only, however far it lies from its axis. Cells are
    ``cell`` wide at least, and half a segment of mean length, so that there are
    a few for each segment, however long they are. Points
    are looked up by position, once for equal ones; rows keep their number.
    Points without finite coordinates, or without an axis in ``segments``, keep
    null.
    """
    s = segments.withColumnRenamed(axis, "axis")
    p = points.select(F.col(axis).alias("axis"), F.col(x).alias("px"), F.col(y).alias("py"))
    p = p.filter(_finite("px", "py")).distinct()
    n, length = total_length(s)
    cell = max(cell, length / (2 * max(n, 1)))
    pieces = segment_cells(s, cell)
    leaves = saved(pieces.select("axis", "cx", "cy").distinct(), "axis-cells")
    spans = leaves.groupBy("axis").agg(
        F.greatest(F.max("cx") - F.min("cx"), F.max("cy") - F.min("cy")).alias("span")
    )
    longest = spans.agg(F.max("span")).first()[0] or 0
    levels = 0
    while FANOUT**levels <= longest:
        levels += 1

    def upper(c: str, level: int) -> Column:
        return F.floor(F.col(c) / FANOUT**level).alias(c)

    top = leaves.select("axis", upper("cx", levels), upper("cy", levels)).distinct()
    cells = _hopeful(p.join(grown(top), "axis"), cell, levels)
    for level in range(levels - 1, -1, -1):
        below = leaves.select("axis", upper("cx", level), upper("cy", level)).distinct()
        below = below.select(
            "axis", upper("cx", 1).alias("ux"), upper("cy", 1).alias("uy"), "cx", "cy"
        )
        above = cells.withColumnsRenamed({"cx": "ux", "cy": "uy"})
        cells = _hopeful(above.join(grown(below), ["axis", "ux", "uy"]).drop("ux", "uy"), cell, level)
    pairs = cells.join(grown(pieces), ["axis", "cx", "cy"]).withColumn("f", _foot())
    best = pairs.groupBy("axis", "px", "py").agg(F.min(_feet(pairs, ["leng", "low"])).alias("b"))
    placed = best.select(
        F.col("axis").alias("__axis"), "px", "py",
        (F.col("b.low") + (1 - F.col("b.f")) * F.col("b.leng")).alias("distance_axis"),
    )
    same = (F.col(axis) == F.col("__axis")) & (F.col(x) == F.col("px")) & (F.col(y) == F.col("py"))
    return points.join(grown(placed), same, "left").drop("__axis", "px", "py")
