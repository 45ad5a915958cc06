"""Column expressions and projections."""

from __future__ import annotations

import re
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def clean_name(name: str) -> str:
    return re.sub(r"[. \-]", "_", name.lower())


def clean_columns(df: DataFrame) -> DataFrame:
    """Lower snake-case names; two names that become one are an error."""
    names = [clean_name(c) for c in df.columns]
    clashes = [n for n, k in Counter(names).items() if k > 1]
    if clashes:
        raise ValueError(f"column names clash after cleaning: {clashes}")
    return df.toDF(*names)


def hectares(area_m2: Column) -> Column:
    return area_m2 / F.lit(10000.0)


def guarded_pct(part: Column, total: Column) -> Column:
    """Percentage of the total; null for a null part or a null or zero total."""
    return F.when(part.isNotNull() & (total != 0), part / total * 100)


def guarded_ratio(part: Column, total: Column) -> Column:
    return F.when(total != 0, part / total)


def flip_sign(distance: Column) -> Column:
    """Negative on the left bank; zero stays plain zero, null stays null."""
    return F.when(distance != 0, -distance).when(distance == 0, distance)


def strict_sum(c: Column) -> Column:
    """Sum that is null as soon as one input is null."""
    return F.when(F.count(F.lit(1)) == F.count(c), F.sum(c))


# Public page of a gauging site.
SITE_PAGE = ("https://www.hydro.eaufrance.fr/sitehydro/", "/fiche")


def site_url(code_site: Column) -> Column:
    return F.concat(F.lit(SITE_PAGE[0]), code_site, F.lit(SITE_PAGE[1]))


def parse_axis_id(link: Column) -> Column:
    """Axis id from a watercourse link: first entry, digits only, end zeros off."""
    digits = F.regexp_replace(F.substring_index(link, "/", 1), "[^0-9]", "")
    return F.regexp_replace(digits, "0*$", "").try_cast("bigint")


def reach_axis_ids(df: DataFrame, reach: str = "id_troncon", link: str = "link") -> DataFrame:
    """Lookup of reach id to axis; reaches without a link are left out."""
    return df.filter(F.col(link).isNotNull() & (F.col(link) != "")).select(
        F.col(reach).alias("id_troncon"), parse_axis_id(F.col(link)).alias("axis")
    )


def set_displayed(df: DataFrame, key: str, codes: list[str]) -> DataFrame:
    """Show exactly the listed codes; rows with a null key keep their flag."""
    if key not in df.columns or "display" not in df.columns:
        raise ValueError(f"table needs columns {key} and display")
    listed = F.col(key).isin(codes) if codes else F.lit(False)
    return df.withColumn(
        "display", F.when(F.col(key).isNotNull(), listed).otherwise(F.col("display"))
    )


def confinement(water: Column, active: Column, total: Column) -> Column:
    return guarded_ratio(water + active, total)


def null_where(value: Column, condition: Column) -> Column:
    return F.when(F.coalesce(condition, F.lit(False)), None).otherwise(value)


def tag_srid(df: DataFrame, column: str, srid: int) -> DataFrame:
    """Record the reference system; coordinates stay as they are."""
    return df.withMetadata(column, {**df.schema[column].metadata, "srid": srid})


def surrogate_key(*natural: str | Column) -> Column:
    """Id that depends on the natural key only, so it is stable over re-runs."""
    return F.xxhash64(*natural)
