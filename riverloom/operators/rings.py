"""Rings of polygons, nested by containment into parts and holes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riverloom.functions.geometry import ring_area
from riverloom.operators.containment import points_in_polygons, ring_edges
from riverloom.operators.joins import grown
from riverloom.session import saved


def nest_rings(polygons: DataFrame, key: str, geom: str = "geom") -> DataFrame:
    """Every ring of polygons whose rings are a flat list: ``(key, ring, depth, within, line)``.

    ``ring`` is its place in the list, ``depth`` the number of other rings of the polygon around
    it, and ``within`` the innermost of these, null for depth 0. Rings of even depth are outer
    borders of parts, those of odd depth are holes. Rings may touch at vertices.

    The middle of a ring's first edge is looked up among all rings of its polygon, so a ring
    is one row, and one with many others beside it meets the edges of its own grid cell only.
    """
    rings = polygons.select(key, F.posexplode(geom).alias("ring", "line")).filter(F.size("line") >= 4)
    rings = saved(rings, "rings")
    edges = ring_edges(rings.withColumn("g", F.array("line")), [key, "ring"], "g")
    a, b = F.col("line")[0], F.col("line")[1]
    probes = rings.select(
        key, F.col("ring").alias("own"), ((a["x"] + b["x"]) / 2).alias("x"), ((a["y"] + b["y"]) / 2).alias("y")
    )
    around = points_in_polygons(probes, edges, [key, "ring"], by=[key]).filter("own != ring")
    around = saved(around.select(key, "own", "ring"), "rings-around")
    depth = around.groupBy(key, F.col("own").alias("ring")).agg(F.count(F.lit(1)).alias("depth"))
    # the innermost ring around is the one that itself has most around it
    inner = around.join(grown(depth.withColumnRenamed("depth", "of")), [key, "ring"], "left")
    innermost = inner.groupBy(key, F.col("own").alias("ring")).agg(
        F.max_by("ring", F.coalesce("of", F.lit(0))).alias("within")
    )
    nested = rings.join(grown(depth), [key, "ring"], "left").join(grown(innermost), [key, "ring"], "left")
    return nested.select(key, "ring", F.coalesce("depth", F.lit(0)).alias("depth"), "within", "line")


def to_multipolygons(polygons: DataFrame, key: str, geom: str = "geom") -> DataFrame:
    """``(key, parts)``: a list of parts, each a list of rings, its outer border first.

    Outer borders run counter-clockwise, holes clockwise, whatever way they were drawn; parts
    and holes keep their order. Polygons without a ring of four vertices are left out.
    """
    nested = nest_rings(polygons, key, geom)
    outer = F.col("depth") % 2 == 0
    turned = F.when((ring_area(F.col("line")) > 0) == outer, F.col("line")).otherwise(F.reverse("line"))
    ring = F.struct((~outer).alias("hole"), "ring", turned.alias("line"))
    owner = F.when(outer, F.col("ring")).otherwise(F.col("within")).alias("part")
    parts = nested.groupBy(key, owner).agg(F.sort_array(F.collect_list(ring)).alias("rings"))
    listed = parts.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("part", "rings"))).alias("parts"))
    lines = F.transform("parts", lambda p: F.transform(p["rings"], lambda r: r["line"]))
    return listed.select(key, lines.alias("parts"))
