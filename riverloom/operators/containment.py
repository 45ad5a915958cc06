"""Points and lines in polygons.

Polygons come as edges (one row per ring edge); holes and parts need no care,
as only the parity of crossings counts. A grid is laid over the polygons. A
cell that no edge passes is inside or outside as a whole; for the others the
table keeps the edges within the cell and whether the cell's reference point
is inside. A point then needs its own cell only: it starts with the state of
the reference point and flips it at every edge crossed on the way, up or down
the cell's left side and then to the right.

So a point meets a few edges instead of all edges of its polygon, each point
row is joined once, and nothing is regrouped after the join.
"""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riverloom.functions.geometry import distance, line_segments
from riverloom.operators.grid import (
    cell_of,
    cell_text,
    cover_cells,
    extent_text,
    rows_text,
    segment_cells,
    start_text,
)
from riverloom.operators.joins import grown
from riverloom.session import saved

# A point this close to an edge (metres) lies on it, where borders count.
TOUCH = 1e-6
# A grid table of at most so many rows and edge copies has some 20 MB.
BROADCAST_ROWS = 200_000


def ring_edges(polygons: DataFrame, keys: list[str], geom: str = "geom") -> DataFrame:
    """Edges of polygons with vertex arrays."""
    rings = polygons.select(*keys, F.explode(geom).alias("__ring"))
    return rings.select(*keys, F.explode(line_segments(F.col("__ring"))).alias("e")).select(
        *keys, "e.*"
    )


def line_edges(lines: DataFrame, keys: list[str], geom: str = "geom") -> DataFrame:
    """Segments of lines with vertex arrays, numbered from 0 along the line."""
    return lines.select(
        *keys, F.posexplode(line_segments(F.col(geom))).alias("seg", "e")
    ).select(*keys, "seg", "e.*")


def vertex_edges(vertices: DataFrame, keys: list[str], seq: str = "seq") -> DataFrame:
    """Edges from vertex rows: each vertex joined to the next of its ring.

    The vertices of a ring are never gathered, so a ring of any size will do;
    a ring id belongs to ``keys``.
    """
    a = vertices.select(*keys, F.col(seq).alias("seg"), F.col("x").alias("x1"), F.col("y").alias("y1"))
    b = vertices.select(
        *keys, (F.col(seq) - 1).alias("seg"), F.col("x").alias("x2"), F.col("y").alias("y2")
    )
    return a.join(grown(b), [*keys, "seg"]).select(*keys, "seg", "x1", "y1", "x2", "y2")


def _turn(e: str, x: str, y: str) -> str:
    """Positive where (x, y) lies left of the directed edge; SQL text like all below."""
    return f"(({e}x2 - {e}x1) * ({y} - {e}y1) - ({e}y2 - {e}y1) * ({x} - {e}x1))"


def _on_edge(x: str, y: str) -> str:
    reach = "sqrt((e.x2 - e.x1) * (e.x2 - e.x1) + (e.y2 - e.y1) * (e.y2 - e.y1))"
    spans = [
        f"{v} BETWEEN least(e.{k}1, e.{k}2) - {TOUCH}D AND greatest(e.{k}1, e.{k}2) + {TOUCH}D"
        for k, v in (("x", x), ("y", y))
    ]
    return f"abs({_turn('e.', x, y)}) <= {reach} * {TOUCH}D AND {' AND '.join(spans)}"


class GridPlan(NamedTuple):
    """What is known of the polygons before the grid is built.

    ``rows`` bounds the size of the grid table: an edge passes at most three
    cells per cell length and three more, and no polygon has more cells than
    its box.
    """

    cell: float
    edges: int
    length: float
    rows: float


def grid_plan(edges: DataFrame, poly: list[str], cell: float | None = None) -> GridPlan:
    """Measure the polygons in one pass; about as many grid cells as edges are aimed at."""
    xs, ys = (F.least("x1", "x2"), F.greatest("x1", "x2")), (F.least("y1", "y2"), F.greatest("y1", "y2"))
    d = distance(F.col("x1"), F.col("y1"), F.col("x2"), F.col("y2"))
    per_polygon = edges.groupBy(*poly).agg(
        F.count(F.lit(1)).alias("n"),
        ((F.max(xs[1]) - F.min(xs[0])) * (F.max(ys[1]) - F.min(ys[0]))).alias("area"),
        F.sum(d).alias("length"),
    )
    polygons, n, area, length = per_polygon.agg(
        F.count(F.lit(1)), F.sum("n"), F.sum("area"), F.sum("length")
    ).first()
    if not polygons:
        return GridPlan(cell or 1.0, 0, 0.0, 0)
    if cell is None:
        cells = max(n, 16 * polygons)
        cell = max(math.sqrt(area / cells), length / (8 * cells)) or 1.0
    rows = 3 * n + 3 * length / cell + area / cell**2
    return GridPlan(cell, n, length, rows)


def _polygon_cells(edges: DataFrame, poly: list[str], cell: float) -> DataFrame:
    """Rows (poly, cx, cy, base, edges): all cells that are not fully outside.

    ``base`` is 1 if the reference point (left side, mid height) is inside. A
    list holds the edges of one polygon within one cell, few on average; it is
    as long as the polygon is detailed there.
    """
    mid = start_text("cy + 0.5D", cell)
    crosses = f"(y1 <= {mid}) != (y2 <= {mid})"
    x_mid = f"CASE WHEN {crosses} THEN x1 + ({mid} - y1) / (y2 - y1) * (x2 - x1) END"
    first, last = extent_text(cell)
    cells = (
        edges.selectExpr("*", f"explode({rows_text(cell)}) AS cy")
        .selectExpr("*", f"{cell_text(x_mid, cell)} AS cm")
        .selectExpr("*", f"explode(sequence(least({first}, cm), greatest({last}, cm))) AS cx")
    )
    edge = F.struct("x1", "y1", "x2", "y2")
    key = [*poly, "cy", "cx"]
    mids = F.expr("sum(CASE WHEN cm = cx THEN 1 ELSE 0 END) AS mids")
    marked = cells.groupBy(*key).agg(mids, F.collect_list(edge).alias("edges"))
    # one grid row of one polygon at a time: at most one entry per column
    w = Window.partitionBy(*poly, "cy").orderBy("cx")
    before = F.coalesce(
        F.sum("mids").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    scanned = marked.withColumns(
        {"base": (before % 2).cast("int"), "after": (before + F.col("mids")) % 2, "nxt": F.lead("cx").over(w)}
    )
    empty = F.array().cast("array<struct<x1:double,y1:double,x2:double,y2:double>>")

    def entry(cx, base, held):
        return F.struct(cx.alias("cx"), base.alias("base"), held.alias("edges"))

    own = F.array(entry(F.col("cx"), F.col("base"), F.col("edges")))
    inner = F.when(
        (F.col("after") == 1) & (F.col("nxt") > F.col("cx") + 1),
        F.transform(
            F.sequence(F.col("cx") + 1, F.col("nxt") - 1), lambda c: entry(c, F.lit(1), empty)
        ),
    ).otherwise(F.slice(own, 1, 0))
    return scanned.select(*poly, "cy", F.explode(F.concat(own, inner)).alias("c")).select(
        *poly, "cy", "c.*"
    )


def points_in_polygons(
    points: DataFrame,
    edges: DataFrame,
    poly: list[str],
    by: list[str] = (),
    x: str = "x",
    y: str = "y",
    cell: float | None = None,
    plan: GridPlan | None = None,
    border: bool = False,
) -> DataFrame:
    """Pair each point with the polygons that contain it; others are dropped.

    ``poly`` are the edge columns that identify a polygon, and ``by`` those
    among them that the points have too and that must agree. A point in two
    polygons gives two rows. A border belongs to at most one side: a point on
    a shared border is never in both neighbours by the same edge. With
    ``border`` points on an edge (to a micrometre) count as inside, too.

    ``plan`` spares a pass over the edges where :func:`grid_plan` was called
    before. Every point row is judged by itself, so equal rows stay as many.
    """
    by = list(by)
    keys = [*by, *[c for c in poly if c not in by]]
    edges = edges.select(*keys, "x1", "y1", "x2", "y2")
    plan = plan or grid_plan(edges, keys, cell)
    cell = float(plan.cell)
    table = _polygon_cells(edges, keys, cell)
    table = F.broadcast(table) if plan.rows <= BROADCAST_ROWS else grown(table)
    located = points.withColumns(
        {"cx": cell_of(F.col(x), cell), "cy": cell_of(F.col(y), cell)}
    )
    joined = located.join(table, [*by, "cx", "cy"])
    px, py = f"`{x}`", f"`{y}`"
    left, mid = start_text("cx", cell), start_text("cy + 0.5D", cell)
    corner = f"{_turn('e.', left, py)} > 0"
    level = f"(e.y1 <= {py}) != (e.y2 <= {py}) AND ({corner}) != ({_turn('e.', px, py)} > 0)"
    upright = f"(e.x1 <= {left}) != (e.x2 <= {left}) AND ({corner}) != ({_turn('e.', left, mid)} > 0)"
    crossings = f"aggregate(edges, base, (n, e) -> n + int({level}) + int({upright}))"
    touches = f"exists(edges, e -> {_on_edge(px, py)})" if border else "false"
    own = [c for c in keys if c not in by]
    inside = joined.filter(f"{crossings} % 2 = 1 OR {touches}")
    return inside.select(*points.columns, *own)


def crossing_pairs(
    segments: DataFrame, edges: DataFrame, by: list[str], cell: float
) -> DataFrame:
    """Segment and edge pairs that share a grid cell, edge columns as ``ex1``..``ey2``.

    A pair occurs once per shared cell; callers dedupe what they derive.
    """
    return segment_cells(segments, cell).join(grown(_edge_cells(edges, cell)), [*by, "cx", "cy"])


def _edge_cells(edges: DataFrame, cell: float) -> DataFrame:
    return segment_cells(edges, cell).withColumnsRenamed(
        {"x1": "ex1", "y1": "ey1", "x2": "ex2", "y2": "ey2"}
    )


def border_pairs(segments: DataFrame, edges: DataFrame, cell: float) -> DataFrame:
    """Like :func:`crossing_pairs` without ``by``, for segments that mostly lie far from edges:
    only cells that hold edges are looked at, see :func:`cover_cells`."""
    e = saved(_edge_cells(edges, cell), "border-edges")
    leaves = saved(e.select("cx", "cy").distinct(), "border-cells")
    return cover_cells(segments, leaves, cell).join(grown(e), ["cx", "cy"])


def proper_crossing() -> str:
    """Whether segment and edge cross in the inside of both."""
    sides = [f"signum({_turn('e', f'x{k}', f'y{k}')})" for k in (1, 2)]
    other = [f"signum({_turn('', f'ex{k}', f'ey{k}')})" for k in (1, 2)]
    return f"{' * '.join(sides)} < 0 AND {' * '.join(other)} < 0"


def lines_in_polygons(
    lines: DataFrame,
    edges: DataFrame,
    line_id: str,
    poly: str,
    geom: str = "geom",
    cell: float | None = None,
) -> DataFrame:
    """Left join of lines to the polygon that wholly contains them, else null.

    All vertices and segment middles must be inside or on the border, and no
    segment may cross an edge: a line may touch the border from within. The
    probes are counted per line, which combines on the map side. Segments meet the
    edges through a cover of the borders by cells of several sizes, so those
    deep inside a region are left behind early.
    """
    borders = edges.select(poly, "x1", "y1", "x2", "y2")
    plan = grid_plan(borders, [poly], cell)
    middles = F.transform(
        line_segments(F.col(geom)),
        lambda s: F.struct(
            ((s["x1"] + s["x2"]) / 2).alias("x"), ((s["y1"] + s["y2"]) / 2).alias("y")
        ),
    )
    probes = lines.select(
        line_id, (F.size(geom) * 2 - 1).alias("n"), F.explode(F.concat(F.col(geom), middles)).alias("v")
    ).select(line_id, "n", "v.x", "v.y")
    inside = (
        points_in_polygons(probes, borders, [poly], plan=plan, border=True)
        .groupBy(line_id, "n", poly)
        .agg(F.count(F.lit(1)).alias("m"))
        .filter(F.col("m") == F.col("n"))
        .select(line_id, poly)
    )
    segments = line_edges(lines, [line_id], geom)
    size = cell or (plan.length / plan.edges if plan.length else 1.0)
    crossing = (
        border_pairs(segments, borders, size)
        .filter(proper_crossing())
        .select(line_id, poly)
        .distinct()
    )
    within = inside.join(grown(crossing), [line_id, poly], "left_anti")
    return lines.join(grown(within), line_id, "left").select(*lines.columns, poly)
