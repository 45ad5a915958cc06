"""Uniform grid: which cells a segment passes, and how large cells should be."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riverloom.functions.geometry import distance
from riverloom.operators.joins import grown

# Grid lines are shifted by this share of a cell, away from round coordinates.
SHIFT = 0.381966011250105
# Cells are covered with this margin (share of a cell) against rounding.
SLACK = 1e-6


def cell_of(v: Column, size: float) -> Column:
    return F.floor(v / size - SHIFT).cast("long")


def cell_text(v: str, size: float) -> str:
    """:func:`cell_of` as SQL text; long expressions are quicker to build that way."""
    return f"bigint(floor(({v}) / {size!r}D - {SHIFT}D))"


def start_text(cell: str, size: float) -> str:
    return f"(({cell}) + {SHIFT}D) * {size!r}D"


def rows_text(size: float) -> str:
    """Grid rows that the segment x1..y2 passes."""
    margin = f"{size * SLACK!r}D"
    first = cell_text(f"least(y1, y2) - {margin}", size)
    return f"sequence({first}, {cell_text(f'greatest(y1, y2) + {margin}', size)})"


def extent_text(size: float) -> tuple[str, str]:
    """First and last cell that the segment x1..y2 passes in grid row ``cy``."""

    def x_at(y: str) -> str:
        share = f"CASE WHEN y2 != y1 THEN ({y} - y1) / (y2 - y1) END"
        return f"(x1 + least(greatest({share}, 0D), 1D) * (x2 - x1))"

    a, b = x_at(start_text("cy", size)), x_at(start_text("cy + 1", size))
    low = f"CASE WHEN y1 = y2 THEN least(x1, x2) ELSE least({a}, {b}) END"
    high = f"CASE WHEN y1 = y2 THEN greatest(x1, x2) ELSE greatest({a}, {b}) END"
    margin = f"{size * SLACK!r}D"
    return cell_text(f"{low} - {margin}", size), cell_text(f"{high} + {margin}", size)


def segment_cells(segments: DataFrame, size: float) -> DataFrame:
    """One row per cell (cx, cy) that the segment x1..y2 passes.

    Row by row of the grid, so the number of cells grows with the length of
    the segment, not with the area of its box.
    """
    size = float(size)
    first, last = extent_text(size)
    return segments.selectExpr("*", f"explode({rows_text(size)}) AS cy").selectExpr(
        "*", f"explode(sequence({first}, {last})) AS cx"
    )


# Cells of a level lie in cells of this many times their size in the next.
FANOUT = 16


def _passed(size: float, level: int, within: bool) -> tuple[str, str]:
    """Grid rows and, for row ``cy``, the cells that the segment x1..y2 passes on a level of the
    pyramid over cells of ``size``; ``within`` keeps to the cell (ux, uy) of the level above."""
    wide, shift = size * FANOUT**level, SHIFT / FANOUT**level
    margin = f"{size * SLACK!r}D"

    def cell(v: str) -> str:
        return f"bigint(floor(({v}) / {wide!r}D - {shift!r}D))"

    def x_at(row: str) -> str:
        y = f"(({row}) + {shift!r}D) * {wide!r}D"
        share = f"CASE WHEN y2 != y1 THEN ({y} - y1) / (y2 - y1) END"
        return f"(x1 + least(greatest({share}, 0D), 1D) * (x2 - x1))"

    a, b = x_at("cy"), x_at("cy + 1")
    first, last = cell(f"least(y1, y2) - {margin}"), cell(f"greatest(y1, y2) + {margin}")
    left = cell(f"CASE WHEN y1 = y2 THEN least(x1, x2) ELSE least({a}, {b}) END - {margin}")
    right = cell(f"CASE WHEN y1 = y2 THEN greatest(x1, x2) ELSE greatest({a}, {b}) END + {margin}")
    if within:
        first, last = f"greatest({first}, uy * {FANOUT})", f"least({last}, uy * {FANOUT} + {FANOUT - 1})"
        left, right = f"greatest({left}, ux * {FANOUT})", f"least({right}, ux * {FANOUT} + {FANOUT - 1})"

    def between(low: str, high: str) -> str:
        return f"explode(CASE WHEN {low} <= {high} THEN sequence({low}, {high}) END)"

    return between(first, last), between(left, right)


def cover_cells(segments: DataFrame, cells: DataFrame, size: float) -> DataFrame:
    """One row per cell (cx, cy) of ``cells`` that the segment x1..y2 passes.

    ``cells``, distinct and stored, are the leaves of a pyramid whose levels hold the cells
    above them. A segment begins with the few top cells that it passes and goes down only
    where there are cells of the level, so a long one far from all of them makes a few rows,
    however small the cells are.
    """
    size = float(size)
    extent = [F.max(c) - F.min(c) for c in ("cx", "cy")]
    span = cells.agg(F.greatest(*extent)).first()[0] or 0
    levels = 0
    while FANOUT**levels <= span:
        levels += 1

    def above(level: int) -> DataFrame:
        up = [F.floor(F.col(c) / FANOUT**level).cast("long").alias(c) for c in ("cx", "cy")]
        return cells.select(*up).distinct()

    found = segments
    for level in range(levels, -1, -1):
        rows, columns = _passed(size, level, level < levels)
        if level < levels:
            found = found.withColumnsRenamed({"cx": "ux", "cy": "uy"})
        found = found.selectExpr("*", f"{rows} AS cy").selectExpr("*", f"{columns} AS cx")
        found = found.join(grown(above(level)), ["cx", "cy"], "left_semi").drop("ux", "uy")
    return found


def total_length(segments: DataFrame) -> tuple[int, float]:
    """Number and total length of segments."""
    d = distance(F.col("x1"), F.col("y1"), F.col("x2"), F.col("y2"))
    n, total = segments.agg(F.count(F.lit(1)), F.coalesce(F.sum(d), F.lit(0.0))).first()
    return n, total
