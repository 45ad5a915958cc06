"""Expressions on vertex arrays ``array<struct<x, y>>``.

All of them work inside one row, on the JVM side.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def xy(x: Column, y: Column) -> Column:
    return F.struct(x.alias("x"), y.alias("y"))


def distance(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    dx, dy = x2 - x1, y2 - y1
    return F.sqrt(dx * dx + dy * dy)


def line_segments(line: Column) -> Column:
    """Consecutive vertex pairs as ``array<struct<x1, y1, x2, y2>>``."""
    n = F.size(line)
    return F.when(
        n >= 2,
        F.zip_with(
            F.slice(line, F.lit(1), F.greatest(n - 1, F.lit(0))),
            F.slice(line, F.lit(2), F.greatest(n - 1, F.lit(0))),
            lambda a, b: F.struct(
                a["x"].alias("x1"), a["y"].alias("y1"), b["x"].alias("x2"), b["y"].alias("y2")
            ),
        ),
    ).otherwise(F.array().cast("array<struct<x1:double,y1:double,x2:double,y2:double>>"))


def line_length(line: Column) -> Column:
    return F.aggregate(
        line_segments(line),
        F.lit(0.0),
        lambda acc, s: acc + distance(s["x1"], s["y1"], s["x2"], s["y2"]),
    )


def ring_area(ring: Column) -> Column:
    """Area of a closed ring, below 0 if it runs clockwise."""
    # from the first vertex, so that far coordinates keep their digits
    o = F.get(ring, 0)
    twice = F.aggregate(
        line_segments(ring),
        F.lit(0.0),
        lambda acc, s: acc
        + (s["x1"] - o["x"]) * (s["y2"] - o["y"])
        - (s["x2"] - o["x"]) * (s["y1"] - o["y"]),
    )
    return twice / 2


def parts_area(parts: Column) -> Column:
    """Area of a list of parts, holes taken off."""
    rings = F.transform(F.flatten(parts), ring_area)
    return F.aggregate(rings, F.lit(0.0), lambda acc, a: acc + a)


def first_vertex(line: Column) -> Column:
    return F.get(line, 0)


def last_vertex(line: Column) -> Column:
    return F.get(line, F.size(line) - 1)


def drop_z(line: Column) -> Column:
    """Keep x and y of vertices that carry more."""
    return F.transform(line, lambda v: xy(v["x"], v["y"]))


def drop_z_rings(rings: Column) -> Column:
    return F.transform(rings, drop_z)


def snap(value: Column, size: float) -> Column:
    return F.round(value / size) * size


def _without_repeats(line: Column) -> Column:
    return F.filter(
        line,
        lambda v, i: (i == 0) | (F.get(line, i - 1)["x"] != v["x"]) | (F.get(line, i - 1)["y"] != v["y"]),
    )


def snap_grid(line: Column, size: float) -> Column:
    """Round vertices to a grid and drop those equal to their predecessor."""
    return _without_repeats(F.transform(line, lambda v: xy(snap(v["x"], size), snap(v["y"], size))))


def snap_grid_rings(rings: Column, size: float) -> Column:
    return F.transform(rings, lambda r: snap_grid(r, size))


def round_coordinates(line: Column, digits: int = 3) -> Column:
    """Rounding to a number of decimals, for compact storage (off by default in loads)."""
    return F.transform(line, lambda v: xy(F.round(v["x"], digits), F.round(v["y"], digits)))


def point_at(line: Column, position: Column) -> Column:
    """Point at a fractional vertex position: 2.25 is a quarter into segment 2."""
    i = F.floor(position).cast("int")
    a, b, f = F.get(line, i), F.get(line, i + 1), position - i
    return F.when(f == 0, a).otherwise(
        xy(a["x"] + f * (b["x"] - a["x"]), a["y"] + f * (b["y"] - a["y"]))
    )


def cut_line(line: Column, start: Column, stop: Column) -> Column:
    """Part of a line between two fractional vertex positions."""
    first = F.floor(start).cast("int") + 1
    last = F.ceil(stop).cast("int") - 1
    between = F.slice(line, first + 1, F.greatest(last - first + 1, F.lit(0)))
    return F.concat(F.array(point_at(line, start)), between, F.array(point_at(line, stop)))
