"""Loading prepared tables into a folder of stored tables.

Every table is a Parquet folder in key buckets. A load replaces by key, so it
can be run again with the same result.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riverloom.functions.columns import set_displayed, surrogate_key
from riverloom.functions.geometry import (
    drop_z_rings,
    round_coordinates,
    snap_grid_rings,
)
from riverloom.functions.projection import reproject
from riverloom.functions.simplify import simplify_lines
from riverloom.operators.lines import merge_lines
from riverloom.operators.link import link_swaths
from riverloom.operators.profiles import rows_per_axis
from riverloom.operators.joins import hot_join
from riverloom.operators.quality import conform
from riverloom.plans.prepare import NetworkTables
from riverloom.schemas import METRIC_TABLES, REPLACE_KEYS, STORE_SRID, TABLES, WORK_SRID
from riverloom.session import saved
from riverloom.sources.tables import create_table, delete_matching, read_table, upsert_table

# Storage grids in degrees, and the thinning of axis lines in metres.
AXIS_GRID = 1e-4
REGION_GRID = 1e-6
AXIS_TOLERANCE = 200.0


class Store(NamedTuple):
    """A folder of stored tables."""

    spark: SparkSession
    folder: str
    #: of the tables that are created; by default from the rows of their first load
    buckets: int | None = None

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}"

    def read(self, name: str) -> DataFrame:
        return read_table(self.spark, self.path(name), TABLES[name])


def create_tables(store: Store, names: list[str] | None = None) -> None:
    """Empty tables; existing ones of these names lose their rows."""
    for name in names or list(TABLES):
        empty = store.spark.createDataFrame([], TABLES[name])
        create_table(empty, store.path(name), REPLACE_KEYS[name], store.buckets)


def replace_rows(store: Store, name: str, df: DataFrame) -> tuple[int, int]:
    """Replace by the table's key; returns rows deleted and inserted."""
    rows = conform(df, TABLES[name])
    return upsert_table(rows, store.path(name), REPLACE_KEYS[name], schema=TABLES[name])


def _stored_rings(df: DataFrame, digits: int | None) -> DataFrame:
    """Region geometry as stored: in degrees, without height, on a fine grid."""
    flat = df.withColumn("geom", drop_z_rings(F.col("geom")))
    moved = reproject(flat, ["geom"], WORK_SRID, STORE_SRID)
    rings = F.col("geom")
    if digits is not None:
        rings = F.transform(rings, lambda r: round_coordinates(r, digits))
    return moved.withColumn("geom", snap_grid_rings(rings, REGION_GRID))


def load_basins(store: Store, basins: DataFrame, digits: int | None = None) -> tuple[int, int]:
    """``digits`` also rounds the coordinates, which is off by default."""
    rows = _stored_rings(basins, digits)
    if "gid" not in rows.columns:
        # a small id that depends on the code alone
        rows = rows.withColumn("gid", F.hash("cdbh"))
    return replace_rows(store, "bassin_hydrographique", rows)


def load_regions(store: Store, regions: DataFrame, digits: int | None = None) -> tuple[int, int]:
    return replace_rows(store, "region_hydrographique", _stored_rings(regions, digits))


def display(store: Store, name: str, codes: list[str]) -> None:
    """Show exactly the listed basins or regions."""
    rows = saved(set_displayed(store.read(name), REPLACE_KEYS[name], codes), name)
    upsert_table(rows, store.path(name), REPLACE_KEYS[name], schema=TABLES[name])


def load_sites(store: Store, sites: DataFrame) -> tuple[int, int]:
    rows = reproject(sites, ["x", "y"], WORK_SRID, STORE_SRID)
    if "gid" not in rows.columns:
        rows = rows.withColumn("gid", surrogate_key("code_site"))
    return replace_rows(store, "hydro_sites", rows)


def load_obstacles(store: Store, obstacles: DataFrame) -> tuple[int, int]:
    return replace_rows(store, "roe", reproject(obstacles, ["x", "y"], WORK_SRID, STORE_SRID))


def load_metrics(store: Store, name: str, rows: DataFrame) -> tuple[int, int]:
    """Link metric rows to their swaths and replace the axes they belong to."""
    if name not in METRIC_TABLES:
        raise ValueError(f"{name} is not a metric table")
    return replace_rows(store, name, link_swaths(rows, store.read("hydro_swaths")))


class NetworkReport(NamedTuple):
    swaths_deleted: DataFrame
    counts: dict[str, tuple[int, int]]
    obstacles_deleted: int


def load_network(store: Store, network: NetworkTables) -> NetworkReport:
    """Replace whole axes with their lines and swaths.

    Obstacles of a replaced axis are deleted with it and have to be loaded
    again. Metric rows of these axes are linked anew: those of a vanished
    swath lose their link, those at a new position get one. Only the buckets
    of these axes are rewritten.
    """
    axes = saved(network.hydro_axis.select("axis").distinct(), "axes")
    deleted = saved(
        rows_per_axis(hot_join(store.read("hydro_swaths"), axes, ["axis"], "left_semi")), "deleted"
    )
    # lines that meet only on the storage grid are joined, those that shrink to a point go
    thin = reproject(
        simplify_lines(network.lines, AXIS_TOLERANCE), ["geom"], WORK_SRID, STORE_SRID
    )
    thin = merge_lines(thin, "line_no", size=AXIS_GRID)
    obstacles = delete_matching(axes, store.path("roe"), "axis", TABLES["roe"])
    counts = {
        "hydro_axis": replace_rows(store, "hydro_axis", network.hydro_axis),
        "hydro_axis_lines": replace_rows(store, "hydro_axis_lines", thin),
        "hydro_swaths": replace_rows(
            store, "hydro_swaths", reproject(network.hydro_swaths, ["geom"], WORK_SRID, STORE_SRID)
        ),
    }
    swaths = hot_join(store.read("hydro_swaths"), axes, ["axis"], "left_semi")
    for name in METRIC_TABLES:
        rows = hot_join(store.read(name), axes, ["axis"], "left_semi")
        replace_rows(store, name, link_swaths(rows, swaths))
    return NetworkReport(deleted, counts, obstacles)
