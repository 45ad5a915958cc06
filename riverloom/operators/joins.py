"""Join helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: a key is hot if more than one row in so many holds it
HOT = 200
#: keys that the sketch follows: any hot key is among them, whatever the others are
FOLLOWED = 16 * HOT


def grown(df: DataFrame) -> DataFrame:
    """The right side of an equi-join whose sides both grow with the input: joined by merge.

    Spark takes a computed table for as large as the files it comes from. It does not see how far
    exploding (vertices, cells) has multiplied it, nor how well a saved table was packed, and so
    would send a large one whole through the driver to every executor. Sorted runs spill instead.
    """
    return df.hint("merge")


def keyed_join(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Left, left-semi or left-anti equi-join that survives many null keys.

    A row with a null key can match nothing, yet a shuffle would send all such
    rows of a key prefix to one task. A third key, derived from the row itself,
    is 0 on both sides for complete keys and spreads the incomplete ones, over as
    many values as there are shuffle partitions. For complete keys that many
    rows of ``left`` may hold, see :func:`hot_join`.

    The 0 of ``right`` is computed from its keys: Spark would put a constant into the
    condition, and shuffle by the other keys alone.
    """
    width = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    complete = " AND ".join(f"`{k}` IS NOT NULL" for k in keys)
    names = ", ".join(f"`{k}`" for k in keys)
    spread = (
        f"CASE WHEN {complete} THEN 0 ELSE 1 + int(pmod(xxhash64({_row_columns(left)}), {width})) END AS __spread"
    )
    joined = left.selectExpr("*", spread).join(
        grown(right.selectExpr("*", f"int(pmod(xxhash64({names}), 1)) AS __spread")), [*keys, "__spread"], how
    )
    return _without_spread(joined, left, right, keys, how)


def _row_columns(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}`" for f in df.schema if not isinstance(f.dataType, T.MapType))


def _without_spread(joined: DataFrame, left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    added = [c for c in right.columns if c not in keys] if how == "left" else []
    return joined.select(*left.columns, *added)


def _key_hash(keys: list[str]) -> Column:
    return F.xxhash64(*[F.col(k) for k in keys])


def hot_keys(df: DataFrame, keys: list[str]) -> list[int]:
    """Hashes of the keys that more than 1/``HOT`` of the rows hold.

    One aggregate of bounded size: a frequency sketch of the hashed keys in each task, merged.
    It never misses a key above that share; at most ``HOT`` hashes reach the driver.
    """
    complete = F.expr(" AND ".join(f"`{k}` IS NOT NULL" for k in keys))
    sketch = F.expr(f"approx_top_k(__hash, {HOT}, {FOLLOWED})").alias("top")
    top, n = df.where(complete).select(_key_hash(keys).alias("__hash")).agg(sketch, F.count(F.lit(1))).first()
    return [r["item"] for r in top or [] if r["count"] * HOT > n]


def hot_join(
    left: DataFrame, right: DataFrame, keys: list[str], how: str, hot: list[int] | None = None
) -> DataFrame:
    """Like :func:`keyed_join`, for a ``left`` of which a few keys may hold most rows.

    ``right`` has one row for a key (or few). The adaptive skew join does not help where
    ``right`` is an aggregate, so the rows of hot keys are spread by a hash of the row over as
    many values as there are shuffle partitions, and the rows of ``right`` with these keys, at
    most ``HOT`` keys, are copied to each of them. ``left`` is read once more for the sketch,
    its keys only: best a stored or saved table. ``hot`` are its :func:`hot_keys`, if known.
    Rows of ``left`` that are equal in all columns stay together.
    """
    hot = hot_keys(left, keys) if hot is None else hot
    if not hot:
        return keyed_join(left, right, keys, how)
    width = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    complete = F.expr(" AND ".join(f"`{k}` IS NOT NULL" for k in keys))
    is_hot = complete & _key_hash(keys).isin(hot)
    slot = F.expr(f"int(pmod(xxhash64({_row_columns(left)}, 1), {width}))")
    nulls = F.lit(-1) - slot
    spread = F.when(is_hot, slot).when(complete, F.lit(0)).otherwise(nulls)
    copies = F.when(_key_hash(keys).isin(hot), F.sequence(F.lit(0), F.lit(width - 1))).otherwise(F.array(F.lit(0)))
    joined = left.withColumn("__spread", spread).join(
        grown(right.withColumn("__spread", F.explode(copies))), [*keys, "__spread"], how
    )
    return _without_spread(joined, left, right, keys, how)
