"""Lambert conformal conic with two standard parallels (Snyder, USGS PP 1395, 1987)."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riverloom.functions.geometry import xy
from riverloom.schemas import STORE_SRID, WORK_SRID

# Public registry parameters of the working system, GRS80 ellipsoid.
LAT_ORIGIN = 46.5
LON_ORIGIN = 3.0
PARALLEL_1 = 44.0
PARALLEL_2 = 49.0
EAST_0 = 700000.0
NORTH_0 = 6600000.0
SEMI_MAJOR = 6378137.0
FLATTENING = 1 / 298.257222101

_E = math.sqrt(2 * FLATTENING - FLATTENING**2)


def _m(phi: float) -> float:
    return math.cos(phi) / math.sqrt(1 - (_E * math.sin(phi)) ** 2)


def _t(phi: float) -> float:
    u = _E * math.sin(phi)
    return math.tan(math.pi / 4 - phi / 2) / ((1 - u) / (1 + u)) ** (_E / 2)


_P1, _P2 = math.radians(PARALLEL_1), math.radians(PARALLEL_2)
_N = (math.log(_m(_P1)) - math.log(_m(_P2))) / (math.log(_t(_P1)) - math.log(_t(_P2)))
_AF = SEMI_MAJOR * _m(_P1) / (_N * _t(_P1) ** _N)
_RHO_0 = _AF * _t(math.radians(LAT_ORIGIN)) ** _N
_STEPS = 6


def _eccentric(phi: Column) -> Column:
    # ((1-u)/(1+u))^(e/2) with phi occurring once, so that unrolling stays linear
    return F.pow(2.0 / (F.lit(1.0) + F.sin(phi) * _E) - 1.0, F.lit(_E / 2))


def to_metres(lon: Column, lat: Column) -> tuple[Column, Column]:
    phi = F.radians(lat)
    t = F.tan(math.pi / 4 - phi / 2) / _eccentric(phi)
    rho = F.pow(t, F.lit(_N)) * _AF
    theta = (F.radians(lon) - math.radians(LON_ORIGIN)) * _N
    return rho * F.sin(theta) + EAST_0, F.lit(_RHO_0 + NORTH_0) - rho * F.cos(theta)


def to_degrees(east: Column, north: Column) -> tuple[Column, Column]:
    dx, dy = east - EAST_0, F.lit(_RHO_0 + NORTH_0) - north
    t = F.pow(F.sqrt(dx * dx + dy * dy) / _AF, F.lit(1 / _N))
    phi = math.pi / 2 - F.atan(t) * 2
    for _ in range(_STEPS):
        phi = math.pi / 2 - F.atan(t * _eccentric(phi)) * 2
    return F.degrees(F.atan2(dx, dy) / _N) + LON_ORIGIN, F.degrees(phi)


def _moved(x: Column, y: Column, source: int, target: int) -> tuple[Column, Column]:
    if source == target:
        return x, y
    if (source, target) == (STORE_SRID, WORK_SRID):
        return to_metres(x, y)
    if (source, target) == (WORK_SRID, STORE_SRID):
        return to_degrees(x, y)
    raise ValueError(f"no conversion from {source} to {target}")


def reproject(df: DataFrame, columns, source: int, target: int) -> DataFrame:
    """Convert geometry columns and record the new system in their metadata.

    ``columns`` is a list of vertex-array columns, or a pair ``("x", "y")`` of
    point columns. A column tagged with another system is an error.
    """
    columns = list(columns)
    for c in columns:
        tagged = df.schema[c].metadata.get("srid", source)
        if tagged != source:
            raise ValueError(f"{c} is tagged {tagged}, not {source}")
    if all(isinstance(df.schema[c].dataType, T.NumericType) for c in columns):
        if len(columns) != 2:
            raise ValueError("points need a pair of columns")
        east, north = _moved(F.col(columns[0]), F.col(columns[1]), source, target)
        moved = df.withColumns({columns[0]: east, columns[1]: north})
    else:
        def line(c: Column) -> Column:
            return F.transform(c, lambda v: xy(*_moved(v["x"], v["y"], source, target)))

        new = {}
        for c in columns:
            nested = isinstance(df.schema[c].dataType.elementType, T.ArrayType)
            new[c] = F.transform(F.col(c), line) if nested else line(F.col(c))
        moved = df.withColumns(new)
    for c in columns:
        moved = moved.withMetadata(c, {**df.schema[c].metadata, "srid": target})
    return moved
