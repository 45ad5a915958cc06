"""Line thinning (Douglas & Peucker, 1973)."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riverloom.session import ship_package


def kept_vertices(x: np.ndarray, y: np.ndarray, tolerance: float) -> np.ndarray:
    """Indices kept; both ends always are."""
    keep = np.zeros(len(x), dtype=bool)
    keep[[0, -1]] = True
    stack = [(0, len(x) - 1)]
    while stack:
        a, b = stack.pop()
        if b - a < 2:
            continue
        dx, dy = x[b] - x[a], y[b] - y[a]
        px, py = x[a + 1 : b] - x[a], y[a + 1 : b] - y[a]
        length2 = dx * dx + dy * dy
        # distance to the chord as a segment, which also covers a closed line
        f = np.clip((px * dx + py * dy) / length2, 0, 1) if length2 else np.zeros_like(px)
        d = np.hypot(px - f * dx, py - f * dy)
        far = int(np.argmax(d))
        if d[far] > tolerance:
            keep[a + 1 + far] = True
            stack += [(a, a + 1 + far), (a + 1 + far, b)]
    return np.flatnonzero(keep)


def simplify_lines(df: DataFrame, tolerance: float = 200.0, geom: str = "geom") -> DataFrame:
    """Thin every line of a metric geometry column.

    Works row by row in Arrow batches, so there is no shuffle and a long axis
    is as well spread as its lines are. Only coordinates travel to Python, and
    only indices come back.
    """

    ship_package(df.sparkSession)

    @F.pandas_udf("array<int>")
    def kept(xs: pd.Series, ys: pd.Series) -> pd.Series:
        return pd.Series(
            [
                None if x is None else kept_vertices(np.asarray(x), np.asarray(y), tolerance)
                if len(x)
                else []
                for x, y in zip(xs, ys)
            ]
        )

    line = F.col(geom)
    index = kept(F.transform(line, lambda v: v["x"]), F.transform(line, lambda v: v["y"]))
    thinned = df.withColumn("__kept", index)
    return thinned.withColumn(geom, F.transform("__kept", lambda i: F.get(line, i))).drop("__kept")
