"""SQL pieces shared by the oracle texts."""

from __future__ import annotations

from riverloom.fixtures import SQL
from riverloom.schemas import CONTINUITY_LABELS, LANDCOVER_LABELS


def ctes(*parts: tuple[str, str], recursive: bool = False) -> str:
    head = "WITH RECURSIVE " if recursive else "WITH "
    return head + ",\n".join(f"{name} AS ({text})" for name, text in parts) + "\n"


def fx(*names: str) -> list[tuple[str, str]]:
    return [(f"fx_{n}", SQL[n]) for n in names]


def pct(part: str, total: str) -> str:
    return f"CASE WHEN {part} IS NOT NULL AND {total} <> 0 THEN {part} / {total} * 100 END"


def pivot(source: str, value: str, labels: list[str], total: str, measure: str = "measure") -> str:
    cells = ", ".join(f"MAX(CASE WHEN label = '{x}' THEN {value} END) AS {x}" for x in labels)
    summed = " + ".join(f"COALESCE({x}, 0)" for x in labels)
    shares = ", ".join(f"{pct(x, total)} AS {x}_pc" for x in labels)
    return f"""SELECT side, axis, measure AS {measure}, {', '.join(labels)}, {total}, {shares} FROM (
  SELECT *, {summed} AS {total} FROM (
    SELECT side, axis, measure, {cells} FROM {source} GROUP BY side, axis, measure) c) s"""


LANDCOVER_WIDE = pivot(
    "fx_landcover", "area / 10000", LANDCOVER_LABELS, "sum_area", "measure_medial_axis"
)
CONTINUITY_WIDE = pivot(
    "fx_continuity", "area / 10000", CONTINUITY_LABELS, "sum_area", "measure_medial_axis"
)
WIDTH_WIDE = pivot(
    "fx_continuity", "width1", CONTINUITY_LABELS, "sum_width", "measure_medial_axis"
)
VALLEY_ROWS = (
    "SELECT side, area, width1 AS width, axis, measure AS measure_medial_axis FROM fx_valley_bottom"
)


def linked(source: str) -> str:
    return f"""SELECT m.*, s.gid AS hydro_swaths_gid FROM {source} m LEFT JOIN fx_swaths s
  ON s.axis = m.axis AND s.measure_medial_axis = m.measure_medial_axis"""


def full_side(source: str, labels: list[str], total: str) -> str:
    sums = ", ".join(f"SUM({c}) AS {c}" for c in [*labels, total])
    shares = ", ".join(f"SUM({c}_pc) / 2 AS {c}_pc" for c in labels)
    return f"""SELECT hydro_swaths_gid, axis, measure_medial_axis, {sums}, {shares}
  FROM {source} GROUP BY hydro_swaths_gid, axis, measure_medial_axis"""


AXIS_SUMMARY = """SELECT a.axis, r.toponyme, a.length, g.gid_region FROM (
  SELECT axis, CASE WHEN COUNT(*) = COUNT(length) THEN SUM(length) END AS length
  FROM fx_swaths GROUP BY axis) a
LEFT JOIN (SELECT axis, gid_region FROM (
    SELECT axis, gid_region, ROW_NUMBER() OVER (PARTITION BY axis ORDER BY COUNT(*) DESC, gid_region) AS k
    FROM fx_swaths WHERE gid_region IS NOT NULL GROUP BY axis, gid_region) t WHERE k = 1) g ON g.axis = a.axis
LEFT JOIN (SELECT axis, toponyme FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY axis ORDER BY fid) AS k FROM reaches) t WHERE k = 1) r ON r.axis = a.axis"""

# attributes of the derived reaches: four per supplier, the first without a name
REACH_ROWS = """SELECT CAST(s_suppkey * 4 + k AS BIGINT) AS fid, CAST(s_suppkey AS BIGINT) AS axis,
  CAST((s_suppkey + k) % 6 + 1 AS INT) AS strahler,
  CASE WHEN k > 0 THEN CONCAT('River ', CAST(s_suppkey * 4 + k AS VARCHAR(20))) END AS toponyme
  FROM supplier CROSS JOIN (SELECT UNNEST(RANGE(4)) AS k) t"""

NETWORK_METRICS_TAIL = """SELECT s.gid AS fid, s.axis, s.gid_region, s.measure_medial_axis,
  s.measure_from_outlet AS measure, a.toponyme, s.strahler,
  t.elevation_talweg AS talweg_elevation_min,
  CASE WHEN w.sum_width <> 0 THEN (w.water_channel + w.active_channel) / w.sum_width END AS idx_confinement,
  w.water_channel AS water_channel_width,
  w.water_channel + w.active_channel AS active_channel_width,
  w.riparian_buffer AS natural_corridor_width,
  w.riparian_buffer + w.connected_meadows + w.connected_cultivated AS connected_corridor_width,
  w.sum_width AS valley_bottom_width,
  t.slope_talweg AS talweg_slope, t.slope_valley_bottom AS floodplain_slope,
  l.water_channel, l.gravel_bars, l.natural_open, l.forest, l.grassland, l.crops, l.diffuse_urban,
  l.dense_urban, l.infrastructures,
  c.active_channel, c.riparian_buffer AS riparian_corridor, c.connected_meadows AS semi_natural,
  c.connected_cultivated AS reversible, c.disconnected, c.built AS built_environment,
  l.water_channel_pc, l.gravel_bars_pc, l.natural_open_pc, l.forest_pc, l.grassland_pc, l.crops_pc,
  l.diffuse_urban_pc, l.dense_urban_pc, l.infrastructures_pc,
  c.active_channel_pc, c.riparian_buffer_pc AS riparian_corridor_pc,
  c.connected_meadows_pc AS semi_natural_pc, c.connected_cultivated_pc AS reversible_pc,
  c.disconnected_pc, c.built_pc AS built_environment_pc, c.sum_area
FROM fx_swaths s LEFT JOIN axes a ON a.axis = s.axis
LEFT JOIN talweg t ON t.hydro_swaths_gid = s.gid
LEFT JOIN width_full w ON w.hydro_swaths_gid = s.gid
LEFT JOIN landcover_full l ON l.hydro_swaths_gid = s.gid
LEFT JOIN continuity_full c ON c.hydro_swaths_gid = s.gid"""

NETWORK_METRICS = (
    ctes(
        *fx("landcover", "continuity", "talweg", "swaths"),
        ("reaches", REACH_ROWS),
        ("axes", AXIS_SUMMARY),
        ("landcover_wide", LANDCOVER_WIDE),
        ("continuity_wide", CONTINUITY_WIDE),
        ("width_wide", WIDTH_WIDE),
        ("talweg_rows", "SELECT *, measure AS measure_medial_axis FROM fx_talweg"),
        ("talweg", linked("talweg_rows")),
        ("landcover_linked", linked("landcover_wide")),
        ("continuity_linked", linked("continuity_wide")),
        ("width_linked", linked("width_wide")),
        ("landcover_full", full_side("landcover_linked", LANDCOVER_LABELS, "sum_area")),
        ("continuity_full", full_side("continuity_linked", CONTINUITY_LABELS, "sum_area")),
        ("width_full", full_side("width_linked", CONTINUITY_LABELS, "sum_width")),
    )
    + NETWORK_METRICS_TAIL
)
