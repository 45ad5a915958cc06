"""Readers with fixed schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riverloom.schemas import INPUTS, SITE_RESPONSE


def read_metrics(
    spark: SparkSession, path: str, schema: T.StructType | str, header: bool = True
) -> DataFrame:
    """Metric CSV with a header; ``schema`` is a struct or the name of an input.

    No inference pass is made. Columns are matched by name, in any order, and
    a column of the schema that the file lacks is null. All files of the path
    must have the same header: one that differs is an error, and so is a broken
    number, or one with decimals where a whole number is due.
    """
    wanted = INPUTS[schema] if isinstance(schema, str) else schema
    if not header:
        return spark.read.schema(wanted).option("mode", "FAILFAST").csv(path)
    names = spark.read.option("header", True).csv(path).columns
    types = {f.name: f.dataType for f in wanted.fields}
    whole = (T.LongType, T.IntegerType)

    def parsed(name: str) -> T.DataType:
        # whole numbers are often written as 200.0
        kind = types.get(name, T.StringType())
        return T.DecimalType(30, 6) if isinstance(kind, whole) else kind

    in_file = T.StructType([T.StructField(n, parsed(n)) for n in names])
    # columns are not left out before the headers have been compared
    df = (
        spark.read.schema(in_file)
        .option("header", True)
        .option("mode", "FAILFAST")
        .option("enforceSchema", False)
        .csv(path)
    )

    def typed(f: T.StructField):
        if f.name not in names:
            return F.lit(None).cast(f.dataType)
        value = F.col(f"`{f.name}`")
        if isinstance(f.dataType, whole):
            broken = F.raise_error(F.concat(F.lit(f"{f.name} is not a whole number: "), value.cast("string")))
            value = F.when(value % 1 != 0, broken).otherwise(value)
        return value.cast(f.dataType)

    return df.select(*[typed(f).alias(f.name) for f in wanted.fields])


def read_layer(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """Spatial layer stored as Parquet: ``point``, ``line`` or ``polygon``.

    Points have columns x and y. Lines and polygons have a vertex array
    ``geom``, or come as one row per vertex ``(feature_id, ring, seq, x, y)``,
    which is folded here.
    """
    df = spark.read.parquet(path)
    if kind == "point":
        if not {"x", "y"} <= set(df.columns):
            raise ValueError("a point layer needs columns x and y")
        return df
    if "geom" in df.columns:
        return df
    keep = [c for c in df.columns if c not in ("ring", "seq", "x", "y")]
    return fold_vertices(df, keep, kind)


def fold_vertices(df: DataFrame, keys: list[str], kind: str = "line") -> DataFrame:
    """Vertex rows to one row per feature; the array is as large as the feature."""
    xy = F.struct(F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y"))
    ring = [*keys, "ring"] if kind == "polygon" else keys
    lines = df.groupBy(*ring).agg(
        F.transform(
            F.sort_array(F.collect_list(F.struct(F.col("seq"), xy.alias("v")))), lambda s: s["v"]
        ).alias("geom")
    )
    if kind != "polygon":
        return lines
    return lines.groupBy(*keys).agg(
        F.transform(
            F.sort_array(F.collect_list(F.struct("ring", F.col("geom").alias("g")))),
            lambda s: s["g"],
        ).alias("geom")
    )


def read_sites(
    spark: SparkSession, path: str, schema: T.StructType = SITE_RESPONSE, lines: bool = False
) -> DataFrame:
    """Saved registry responses: one JSON document per file, or per line."""
    return spark.read.schema(schema).option("multiLine", not lines).json(path)


def import_sites(responses: DataFrame) -> DataFrame:
    """Sites of the ``data`` arrays: valid status, with a code, one row per code.

    A geometry member is dropped; the point is taken from longitude and
    latitude as ``x`` and ``y``.
    """
    rows = responses.select(F.explode("data").alias("site")).select("site.*")
    rows = rows.drop("geometry")
    if "longitude_site" in rows.columns:
        rows = rows.withColumnsRenamed({"longitude_site": "x", "latitude_site": "y"})
    return distinct_sites(rows)


def distinct_sites(rows: DataFrame) -> DataFrame:
    """Valid sites, one row per code: the smallest by the other columns.

    The pick is an aggregate, so copies of one site shrink on the map side.
    """
    others = [c for c in rows.columns if c != "code_site"]
    return (
        rows.filter((F.col("statut_site") == 1) & F.col("code_site").isNotNull())
        .groupBy("code_site")
        .agg(F.min(F.struct(*others)).alias("s"))
        .select(*[F.col(f"s.{c}").alias(c) if c in others else c for c in rows.columns])
    )
