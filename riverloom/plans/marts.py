"""Serving tables: both banks summed, and the wide network table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riverloom.operators.joins import grown
from riverloom.operators.link import LINK, link_swaths
from riverloom.schemas import CONTINUITY_LABELS, LANDCOVER_LABELS, METRIC_TABLES, SERVED_CORRIDOR
from riverloom.sources.tables import Builder, refresh

GROUP = [LINK, "axis", "measure_medial_axis"]


def _full_side(df: DataFrame, labels: list[str], total: str) -> DataFrame:
    """Sums over the banks; percentages are halved even if one bank is absent."""
    sums = [f"sum(`{c}`) AS `{c}`" for c in [*labels, total]]
    shares = [f"sum(`{c}_pc`) / 2 AS `{c}_pc`" for c in labels]
    return df.groupBy(*GROUP).agg(*map(F.expr, sums + shares))


def full_side_area(df: DataFrame, labels: list[str]) -> DataFrame:
    return _full_side(df, labels, "sum_area")


def full_side_width(df: DataFrame, labels: list[str]) -> DataFrame:
    return _full_side(df, labels, "sum_width")


def full_side_valley_bottom(df: DataFrame) -> DataFrame:
    return df.groupBy(*GROUP).agg(F.sum("area").alias("area"), F.sum("width").alias("width"))


def network_axis(hydro_axis: DataFrame, lines: DataFrame | None = None) -> DataFrame:
    """Axis serving table.

    One row per axis. With ``lines`` (axis, line_no, geom) the row has all lines
    of its axis, as an array in the order of their numbers.
    """
    attributes = hydro_axis.select(
        "axis",
        F.col("gid").alias("fid"),
        "toponyme",
        "gid_region",
        *(["geom"] if "geom" in hydro_axis.columns else []),
    )
    if lines is None:
        return attributes
    numbered = F.sort_array(F.collect_list(F.struct("line_no", "geom")))
    geoms = lines.groupBy("axis").agg(F.transform(numbered, lambda s: s["geom"]).alias("geom"))
    return attributes.drop("geom").join(grown(geoms), "axis", "left")


def network_metrics(
    swaths: DataFrame,
    hydro_axis: DataFrame,
    talweg: DataFrame,
    continuity_width: DataFrame,
    landcover_area: DataFrame,
    continuity_area: DataFrame,
) -> DataFrame:
    """One wide row per swath with widths, slopes, areas and percentages.

    ``disconnected_pc`` holds the disconnected percentage; the source material
    fills it from the area column, which is a slip.
    The four metric tables join on the swath id together with axis and measure,
    which the link implies. That is how the bank sums are partitioned already,
    so they are not shuffled again, and the swaths are shuffled once for all
    of them. Rows without a link drop out early.
    """
    s, a = swaths.alias("s"), hydro_axis.select("axis", "toponyme").alias("a")

    def linked(df: DataFrame, columns: list[str], name: str) -> DataFrame:
        return df.filter(f"{LINK} IS NOT NULL").select(*GROUP, *columns).alias(name)

    def pc(labels):
        return [f"{c}_pc" for c in labels]

    corridor = [c for c in CONTINUITY_LABELS if c not in ("water_channel", "no_data")]
    t = linked(talweg, ["elevation_talweg", "slope_talweg", "slope_valley_bottom"], "t")
    w = linked(continuity_width, [*CONTINUITY_LABELS[:5], "sum_width"], "w")
    lc = linked(landcover_area, [*LANDCOVER_LABELS, *pc(LANDCOVER_LABELS)], "lc")
    ca = linked(continuity_area, [*corridor, *pc(corridor), "sum_area"], "ca")

    joined = s.join(a, F.col("s.axis") == F.col("a.axis"), "left")
    for name, side in (("t", t), ("w", w), ("lc", lc), ("ca", ca)):
        same = [
            f"{name}.{LINK} = s.gid",
            f"{name}.axis = s.axis",
            f"{name}.measure_medial_axis = s.measure_medial_axis",
        ]
        joined = joined.join(side, F.expr(" AND ".join(same)), "left")

    served = SERVED_CORRIDOR
    widths = {
        "idx_confinement": "CASE WHEN w.sum_width != 0 THEN (w.water_channel + w.active_channel) / w.sum_width END",
        "water_channel_width": "w.water_channel",
        "active_channel_width": "w.water_channel + w.active_channel",
        "natural_corridor_width": "w.riparian_buffer",
        "connected_corridor_width": "w.riparian_buffer + w.connected_meadows + w.connected_cultivated",
        "valley_bottom_width": "w.sum_width",
    }
    return joined.selectExpr(
        "s.gid AS fid",
        "s.axis",
        "s.gid_region",
        "s.measure_medial_axis",
        "s.measure_from_outlet AS measure",
        "a.toponyme",
        "s.strahler",
        "t.elevation_talweg AS talweg_elevation_min",
        *[f"{text} AS {name}" for name, text in widths.items()],
        "t.slope_talweg AS talweg_slope",
        "t.slope_valley_bottom AS floodplain_slope",
        *[f"lc.{c}" for c in LANDCOVER_LABELS],
        *[f"ca.{c} AS {served[c]}" for c in corridor],
        *[f"lc.{c}_pc" for c in LANDCOVER_LABELS],
        *[f"ca.{c}_pc AS {served[c]}_pc" for c in corridor],
        "ca.sum_area",
        *(["s.geom"] if "geom" in swaths.columns else []),
    )


# Order of rebuilding: the wide table reads the others, so it is last.
MART_ORDER = [
    "landcover_area_full_side",
    "continuity_area_full_side",
    "continuity_width_full_side",
    "valley_bottom_full_side",
    "network_axis",
    "network_metrics",
]


def marts(tables: Mapping[str, DataFrame]) -> dict[str, Builder]:
    """Builders of all serving tables, for :func:`riverloom.sources.tables.refresh`.

    ``tables`` are the loaded tables; metric tables that were not linked to the
    swaths on load are linked here.
    """
    swaths = tables["hydro_swaths"]
    linked = {
        n: tables[n] if LINK in tables[n].columns else link_swaths(tables[n], swaths)
        for n in METRIC_TABLES
        if n in tables
    }
    return {
        "landcover_area_full_side": lambda read: full_side_area(
            linked["landcover_area"], LANDCOVER_LABELS
        ),
        "continuity_area_full_side": lambda read: full_side_area(
            linked["continuity_area"], CONTINUITY_LABELS
        ),
        "continuity_width_full_side": lambda read: full_side_width(
            linked["continuity_width"], CONTINUITY_LABELS
        ),
        "valley_bottom_full_side": lambda read: full_side_valley_bottom(linked["valley_bottom"]),
        "network_axis": lambda read: network_axis(
            tables["hydro_axis"], tables.get("hydro_axis_lines")
        ),
        "network_metrics": lambda read: network_metrics(
            swaths,
            tables["hydro_axis"],
            linked["talweg_metrics"],
            read("continuity_width_full_side"),
            read("landcover_area_full_side"),
            read("continuity_area_full_side"),
        ),
    }


def build_marts(spark, tables: Mapping[str, DataFrame], folder: str) -> dict[str, str]:
    """Write all serving tables in dependency order; returns their paths."""
    return dict(zip(MART_ORDER, refresh(spark, MART_ORDER, marts(tables), folder)))
