"""Label lists, keys and table schemas (fixed values of the data model)."""

from __future__ import annotations

from pyspark.sql import types as T

# Land-cover and corridor-continuity classes.
LANDCOVER_LABELS = [
    "water_channel",
    "gravel_bars",
    "natural_open",
    "forest",
    "grassland",
    "crops",
    "diffuse_urban",
    "dense_urban",
    "infrastructures",
]
CONTINUITY_LABELS = [
    "water_channel",
    "active_channel",
    "riparian_buffer",
    "connected_meadows",
    "connected_cultivated",
    "disconnected",
    "built",
    "no_data",
]

WORK_SRID = 2154
STORE_SRID = 4326

XY = T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])
LINE = T.ArrayType(XY)
RINGS = T.ArrayType(LINE)

_TYPES = {
    "long": T.LongType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "date": T.DateType(),
    "boolean": T.BooleanType(),
    "line": LINE,
    "rings": RINGS,
    "strings": T.ArrayType(T.StringType()),
}


def struct(text: str) -> T.StructType:
    """``"gid long, name string"`` to a schema; geometry types by short name."""
    fields = []
    for item in text.split(","):
        name, kind = item.split()
        fields.append(T.StructField(name, _TYPES[kind]))
    return T.StructType(fields)


def _doubles(names) -> str:
    return ", ".join(f"{n} double" for n in names)


def _wide(labels, total) -> str:
    return _doubles([*labels, total, *[f"{label}_pc" for label in labels]])


# --- inputs -------------------------------------------------------------------

_LABELLED = "swath double, label string, side string, area double, width1 double, width2 double, axis long, measure long"

INPUTS = {
    "talweg_metrics": struct(
        _doubles(
            [
                "swath",
                "elevation_talweg",
                "elevation_talweg_med",
                "height_valley_bottom",
                "slope_talweg",
                "slope_valley_bottom",
            ]
        )
        + ", axis long, measure long, sinuosity double"
    ),
    "landcover": struct(_LABELLED + ", width_landcover double"),
    "continuity": struct(_LABELLED + ", width_continuity double"),
    "valley_bottom": struct(
        "swath double, side string, area double, width1 double, width2 double, axis long, measure long"
    ),
    "elevation_profiles": struct(
        "sample long, side string, quantile int, density int, mean double, profile double,"
        " axis long, measure long, distance int"
    ),
    "troncon_bdtopo_id": struct("id_troncon string, axis long"),
}

# Columns of the gauging site register.
SITE_COLUMNS = [
    "code_site string", "libelle_site string", "type_site string", "coordonnee_x_site double",
    "coordonnee_y_site double", "code_projection int", "altitude_site double",
    "code_systeme_alti_site int", "surface_bv double", "statut_site int",
    "premier_mois_etiage_site int", "premier_mois_annee_hydro_site int",
    "influence_generale_site int", "code_entite_hydro_site string",
    "code_troncon_hydro_site string", "code_commune_site strings", "code_zone_hydro_site string",
    "libelle_commune strings", "code_departement strings", "code_region strings",
    "libelle_region strings", "code_cours_eau string", "uri_cours_eau string",
    "grandeur_hydro string", "date_maj_site string", "libelle_departement strings",
    "libelle_cours_eau string", "commentaire_influence_generale_site string",
    "commentaire_site string", "type_contexte_loi_stat_site strings", "type_loi_site strings",
    "date_premiere_donnee_dispo_site string", "longitude_site double", "latitude_site double",
]

SITE_RESPONSE = T.StructType(
    [T.StructField("data", T.ArrayType(struct(", ".join(SITE_COLUMNS))))]
)

# --- stored tables ------------------------------------------------------------

# Attribute columns of the obstacle register.
_OBSTACLE_COLUMNS = [
    "cdobstecou string", "stobstecou string", "cdmodevali string", "lbmodevali string",
    "cdetouvrag string", "lbetouvrag string", "nomprincip string", "nomseconda string",
    "cdtypeouvr string", "lbtypeouvr string", "coordxpoin double", "coordypoin double",
    "typecoordp string", "cdtypedisp string", "lbtypedisp string", "cdtypedi_1 string",
    "lbtypedi_1 string", "cdtypedi_2 string", "lbtypedi_2 string", "cdtypedi_3 string",
    "lbtypedi_3 string", "cdtypedi_4 string", "lbtypedi_4 string", "cdtypeelmo string",
    "lbtypeelmo string", "cdtypeel_1 string", "lbtypeel_1 string", "cdtypeel_2 string",
    "lbtypeel_2 string", "cdtypedi_5 string", "lbtypedi_5 string", "cdtypedi_6 string",
    "lbtypedi_6 string", "cdtypedi_7 string", "lbtypedi_7 string", "cdusageobs string",
    "lbusageobs string", "cdusageo_1 string", "lbusageo_1 string", "cdusageo_2 string",
    "lbusageo_2 string", "cdusageo_3 string", "lbusageo_3 string", "hautmaxter string",
    "hautchutet string", "cdhautchut string", "lbhautchut string", "datemajobs date",
    "datevalido date", "grenobstec string", "ouvragelie string", "idtronconh string",
    "nomentiteh string", "cdtronconh string", "cdentitehy string", "cdzonehydr string",
    "idtronco_1 string", "cddepartem string", "lbdepartem string", "cdcommune string",
    "lbcommune string", "numcircadm string", "nomcircadm string", "cdeumassed string",
    "altipointc double", "nomlimiteh string", "denmaxouvr double", "pkobstecou double",
]

TABLES = {
    "bassin_hydrographique": struct(
        "gid int, cdbh string, lbbh string, numcircadm string, projcoordo string,"
        " display boolean, geom rings"
    ),
    "region_hydrographique": struct(
        "gid int, cdregionhy string, lbregionhy string, cdbh string, display boolean, geom rings"
    ),
    "hydro_axis": struct("gid long, axis long, toponyme string, length double, gid_region int"),
    "hydro_axis_lines": struct("axis long, line_no long, geom line"),
    "hydro_swaths": struct(
        "gid long, axis long, measure_medial_axis long, measure_from_outlet double,"
        " drainage double, length double, strahler int, gid_region int, geom line"
    ),
    "roe": struct(
        "gid long, " + ", ".join(_OBSTACLE_COLUMNS) + ", gid_region int, axis long, distance_axis double,"
        " x double, y double"
    ),
    "hydro_sites": struct(
        "gid long, code_site string, url_site string, libelle_site string, type_site string,"
        " altitude_site double, code_systeme_alti_site int, surface_bv double, statut_site int,"
        " code_entite_hydro_site string, code_troncon_hydro_site string,"
        " code_zone_hydro_site string, code_cours_eau string, uri_cours_eau string,"
        " grandeur_hydro string, date_maj_site string, libelle_cours_eau string,"
        " gid_region int, x double, y double"
    ),
    "talweg_metrics": struct(
        "axis long, measure_medial_axis long, "
        + _doubles(
            [
                "elevation_talweg",
                "elevation_talweg_med",
                "height_valley_bottom",
                "slope_talweg",
                "slope_valley_bottom",
                "sinuosity",
            ]
        )
        + ", hydro_swaths_gid long"
    ),
    "landcover_area": struct(
        "side string, axis long, measure_medial_axis long, "
        + _wide(LANDCOVER_LABELS, "sum_area")
        + ", hydro_swaths_gid long"
    ),
    "continuity_area": struct(
        "side string, axis long, measure_medial_axis long, "
        + _wide(CONTINUITY_LABELS, "sum_area")
        + ", hydro_swaths_gid long"
    ),
    "continuity_width": struct(
        "side string, axis long, measure_medial_axis long, "
        + _wide(CONTINUITY_LABELS, "sum_width")
        + ", hydro_swaths_gid long"
    ),
    "valley_bottom": struct(
        "axis long, measure_medial_axis long, side string, area double, width double,"
        " hydro_swaths_gid long"
    ),
    "elevation_profiles": struct(
        "sample long, quantile int, density int, mean double, profile double, axis long,"
        " measure_medial_axis long, distance int, hydro_swaths_gid long"
    ),
}

UNIQUE_KEYS = {
    "bassin_hydrographique": ["cdbh"],
    "region_hydrographique": ["cdregionhy"],
    "hydro_axis": ["axis"],
    "hydro_swaths": ["axis", "measure_medial_axis"],
    "roe": ["cdobstecou"],
    "hydro_sites": ["code_site"],
    "talweg_metrics": ["axis", "measure_medial_axis"],
    "elevation_profiles": ["axis", "measure_medial_axis", "sample"],
}

# child table, child column, parent table, parent column
FOREIGN_KEYS = [
    ("region_hydrographique", "cdbh", "bassin_hydrographique", "cdbh"),
    ("hydro_axis", "gid_region", "region_hydrographique", "gid"),
    ("hydro_swaths", "gid_region", "region_hydrographique", "gid"),
    ("roe", "gid_region", "region_hydrographique", "gid"),
    ("hydro_sites", "gid_region", "region_hydrographique", "gid"),
    ("hydro_swaths", "axis", "hydro_axis", "axis"),
    ("roe", "axis", "hydro_axis", "axis"),
] + [
    (name, "hydro_swaths_gid", "hydro_swaths", "gid")
    for name in (
        "talweg_metrics",
        "landcover_area",
        "continuity_area",
        "continuity_width",
        "valley_bottom",
        "elevation_profiles",
    )
]

METRIC_TABLES = [child for child, column, _, _ in FOREIGN_KEYS if column == "hydro_swaths_gid"]

# Key by which each table is replaced on load.
REPLACE_KEYS = {
    "bassin_hydrographique": "cdbh",
    "region_hydrographique": "cdregionhy",
    "hydro_axis": "axis",
    "hydro_axis_lines": "axis",
    "hydro_swaths": "axis",
    "roe": "cdobstecou",
    "hydro_sites": "code_site",
    **{name: "axis" for name in METRIC_TABLES},
}

# Names under which corridor classes are served.
SERVED_CORRIDOR = {
    "active_channel": "active_channel",
    "riparian_buffer": "riparian_corridor",
    "connected_meadows": "semi_natural",
    "connected_cultivated": "reversible",
    "disconnected": "disconnected",
    "built": "built_environment",
}
