"""Preparation jobs: raw layers and metric files to table rows."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riverloom.functions.columns import clean_columns, site_url, surrogate_key
from riverloom.functions.geometry import drop_z_rings, line_length
from riverloom.functions.projection import reproject
from riverloom.operators.containment import (
    lines_in_polygons,
    points_in_polygons,
    ring_edges,
)
from riverloom.operators.joins import grown, hot_join
from riverloom.operators.lines import keep_longest, largest_overlap, merge_lines, split_lines
from riverloom.operators.network import (
    drop_degenerate,
    identify_nodes,
    locate_points,
    measure_from_outlet,
    measured_segments,
    snap_to_lines,
)
from riverloom.operators.pivot import pivot_area, pivot_width
from riverloom.operators.profiles import axis_summary, elevation_profile
from riverloom.operators.quality import SideCheck, check_sides, without_duplicates
from riverloom.schemas import CONTINUITY_LABELS, LANDCOVER_LABELS, WORK_SRID
from riverloom.session import saved

MEASURE = {"measure": "measure_medial_axis"}


# --- metric tables ---------------------------------------------------------------


def prepare_landcover_area(df: DataFrame, labels: list[str] = LANDCOVER_LABELS) -> SideCheck:
    """Wide land-cover areas; duplicates are reported beside, not removed."""
    wide = clean_columns(pivot_area(df, labels))
    return check_sides(wide.withColumnsRenamed(MEASURE))


def prepare_continuity_area(df: DataFrame, labels: list[str] = CONTINUITY_LABELS) -> SideCheck:
    wide = clean_columns(pivot_area(df, labels))
    return check_sides(wide.withColumnsRenamed(MEASURE))


def prepare_continuity_width(df: DataFrame, labels: list[str] = CONTINUITY_LABELS) -> SideCheck:
    wide = clean_columns(pivot_width(df, labels))
    return check_sides(wide.withColumnsRenamed(MEASURE))


def prepare_valley_bottom(df: DataFrame) -> SideCheck:
    kept = clean_columns(df).drop("width2", "swath")
    return check_sides(kept.withColumnsRenamed({**MEASURE, "width1": "width"}))


def prepare_talweg_metrics(df: DataFrame) -> DataFrame:
    """Positions that occur more than once are removed altogether."""
    clean = without_duplicates(clean_columns(df), "axis", "measure")
    return clean.drop("swath").withColumnsRenamed(MEASURE)


def prepare_elevation_profiles(df: DataFrame) -> DataFrame:
    return elevation_profile(df)


# --- layers ------------------------------------------------------------------------


def prepare_basins(df: DataFrame, srid: int = WORK_SRID) -> DataFrame:
    return reproject(clean_columns(df).drop("gid"), ["geom"], srid, WORK_SRID)


def prepare_regions(df: DataFrame, srid: int = WORK_SRID) -> DataFrame:
    """Regions in the working system, without third coordinates."""
    clean = clean_columns(df)
    flat = clean.withColumn("geom", drop_z_rings(F.col("geom")))
    return reproject(flat, ["geom"], srid, WORK_SRID)


def region_edges(regions: DataFrame) -> DataFrame:
    """Edges of region polygons under ``gid_region``."""
    return ring_edges(regions.select(F.col("gid").alias("gid_region"), "geom"), ["gid_region"])


# Columns of prepared sites.
SITE_OUTPUT = [
    "code_site", "url_site", "libelle_site", "type_site", "altitude_site", "code_systeme_alti_site",
    "surface_bv", "statut_site", "code_entite_hydro_site", "code_troncon_hydro_site",
    "code_zone_hydro_site", "code_cours_eau", "uri_cours_eau", "grandeur_hydro", "date_maj_site",
    "libelle_cours_eau", "gid_region", "x", "y",
]


def prepare_sites(sites: DataFrame, edges: DataFrame, srid: int = 4326) -> DataFrame:
    """Gauging sites with their region and page; sites in no region go.

    ``edges`` are those of the regions. A column of the output that the input
    lacks is left out.
    """
    metric = reproject(clean_columns(sites), ["x", "y"], srid, WORK_SRID)
    placed = points_in_polygons(
        metric.filter(F.col("code_site").isNotNull()), edges, ["gid_region"]
    )
    paged = placed.withColumn("url_site", site_url(F.col("code_site")))
    return paged.select(*[c for c in SITE_OUTPUT if c in paged.columns])


# --- network ------------------------------------------------------------------------


class AxisTables(NamedTuple):
    """Attributes with one row per axis, and its lines in bounded parts."""

    hydro_axis: DataFrame
    lines: DataFrame


def prepare_axis(reaches: DataFrame, swaths: DataFrame) -> AxisTables:
    """Summary and merged lines of every axis."""
    attributes = axis_summary(swaths, clean_columns(reaches))
    return AxisTables(
        attributes.select(surrogate_key("axis").alias("gid"), *attributes.columns),
        merge_lines(swaths.select("gid", "axis", "geom"), "gid"),
    )


class NetworkTables(NamedTuple):
    hydro_swaths: DataFrame
    hydro_axis: DataFrame
    lines: DataFrame


def prepare_swaths_and_axis(
    swaths: DataFrame, reaches: DataFrame, edges: DataFrame
) -> NetworkTables:
    """River lines cut by swaths, measured from the outlet, and their axes.

    ``edges`` are those of the regions. Only axes with valid swaths are built,
    so a delivery for some axes leaves the others alone. The cleaned swaths and
    the pieces are written to the shared folder once, as several steps read
    them; the steps after that work on narrow columns, and the geometry joins
    in at the end. Rows are told apart by their piece and swath, whatever
    measure they keep, and joined on that key; ``gid`` is derived from it.
    Reaches may be drawn either way: the outlet of an axis is the end where most is
    drained, as the swaths tell, and pieces are turned to run towards it (see
    :func:`measure_from_outlet`).
    """
    swaths, reaches = clean_columns(swaths), clean_columns(reaches)
    valid = swaths.filter(F.col("value") == 2).select("axis", "m", "drainage", "geom")
    valid = saved(without_duplicates(valid, "axis", "m"), "swaths")

    on_axes = hot_join(reaches, valid.select("axis").distinct(), ["axis"], "left_semi")
    split = split_lines(on_axes, valid)
    # a piece in two swaths gives two rows
    row = F.struct("piece.fid", "piece.no", F.coalesce("m", F.lit(-1.0)).alias("m")).alias("row")
    pieces = split.pieces.select("*", row).withColumn("length", line_length(F.col("geom")))
    pieces = drop_degenerate(identify_nodes(keep_longest(pieces, length="length")))
    pieces = saved(pieces, "pieces")

    measured = measure_from_outlet(
        pieces.select("row", "axis", "node_a", "node_b", "length", "drainage"), "row", rising="drainage"
    ).select("row", F.col("measure").alias("measure_from_outlet"), "along")
    strahler = largest_overlap(split.shares, on_axes)
    regions = lines_in_polygons(pieces.select("row", "geom"), edges, "row", "gid_region")
    attributes = (
        pieces.select("row", "piece", "axis", "m", "drainage", "length")
        .join(grown(strahler), "piece", "left")
        .join(grown(measured), "row", "left")
        .join(grown(regions.select("row", "gid_region")), "row", "left")
    )
    hydro_swaths = attributes.join(grown(pieces.select("row", "geom")), "row").select(
        surrogate_key("axis", "row.fid", "row.no", "row.m").alias("gid"),
        "axis",
        F.col("m").cast("long").alias("measure_medial_axis"),
        "measure_from_outlet",
        "drainage",
        "length",
        F.col("strahler").cast("int").alias("strahler"),
        F.col("gid_region").cast("int").alias("gid_region"),
        # all lines run downstream
        F.when(~F.col("along"), F.reverse("geom")).otherwise(F.col("geom")).alias("geom"),
    )
    hydro_swaths = saved(hydro_swaths, "hydro_swaths")
    axis = prepare_axis(reaches, hydro_swaths)
    return NetworkTables(hydro_swaths, axis.hydro_axis, axis.lines)


def axis_segments(lines: DataFrame) -> DataFrame:
    """Segments of the axis lines with their distance from the outlet."""
    named = lines.withColumn("line_id", surrogate_key("axis", "line_no")).withColumn(
        "length", line_length(F.col("geom"))
    )
    network = drop_degenerate(identify_nodes(named))
    measured = measure_from_outlet(
        network.select("line_id", "axis", "node_a", "node_b", "length"), "line_id"
    ).select("line_id", "measure")
    return measured_segments(network.join(grown(measured), "line_id"), "line_id")


def prepare_obstacles(
    obstacles: DataFrame,
    edges: DataFrame,
    reach_ids: DataFrame,
    hydro_axis: DataFrame,
    lines: DataFrame,
    srid: int = WORK_SRID,
    tolerance: float = 100.0,
    prefer_vertices: bool = True,
) -> DataFrame:
    """Obstacles with region, axis and position along the axis.

    Kept are those in a region, whose reach belongs to a known axis, and that
    lie within the tolerance of a line; these are moved onto the line, to a
    vertex of it if one lies within the tolerance. An obstacle listed for
    several reaches of one axis gives one row for each listing. ``gid`` is
    optional in the input and derived from the code if absent.
    """
    rows = reproject(clean_columns(obstacles), ["x", "y"], srid, WORK_SRID)
    rows = rows.filter(F.col("cdobstecou").isNotNull())
    if "gid" not in rows.columns:
        rows = rows.withColumn("gid", surrogate_key("cdobstecou"))
    placed = points_in_polygons(rows, edges, ["gid_region"])
    known = reach_ids.filter(F.col("axis").isNotNull()).withColumnRenamed(
        "id_troncon", "idtronco_1"
    )
    on_axis = saved(placed.join(grown(known), "idtronco_1"), "obstacles")
    on_axis = hot_join(on_axis, hydro_axis.select("axis").distinct(), ["axis"], "left_semi")
    on_axis = saved(on_axis, "obstacles")
    segments = saved(axis_segments(lines), "segments")
    snapped = snap_to_lines(on_axis, segments, tolerance, prefer_vertices=prefer_vertices)
    located = locate_points(snapped, segments, tolerance)
    columns = [c for c in placed.columns if c not in ("x", "y")]
    return located.select(*columns, "axis", "distance_axis", "x", "y")

