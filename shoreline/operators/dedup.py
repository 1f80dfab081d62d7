"""One row per key, chosen the same way every time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F, types as T

GROUPS = 1 << 18  # of keys, by their hash: what is broadcast has a row of a few bytes for each
_RANKED = (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)


def keep_latest(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] = ()) -> DataFrame:
    """The row with the greatest ``order_by`` values per key; NULL sorts lowest.

    The remaining columns break ties, so equal runs give equal tables. An aggregate rather than
    a window: each map task sends one row per key, so a key holding a third of the input is
    reduced before the shuffle instead of being sorted in one task. The keys are shuffled once, not
    in the ranked row as well.
    """
    ranked = [*order_by, *(c for c in df.columns if c not in order_by)]
    rest = [c for c in ranked if c not in keys]
    if not rest:
        return df.select(*df.columns).distinct()
    best = df.groupBy(*keys).agg(F.max(F.struct(*rest)).alias("_best"))
    return best.select(*[F.col(c) if c in keys else F.col("_best").getField(c).alias(c) for c in df.columns])


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``_key``, a hash of each key that occurs more than once. Seldom also that of two keys whose
    hashes are equal, which are then looked at in vain."""
    counted = df.groupBy(F.xxhash64(*keys).alias("_key")).agg(F.count(F.lit(1)).alias("n"))
    return counted.where("n > 1").select("_key")


def keep_latest_where_repeated(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str], repeated: DataFrame
) -> DataFrame:
    """``keep_latest`` where only ``repeated`` keys, few enough to be broadcast, occur more than once.

    All other rows are the latest of their key as they are, and are neither sorted nor shuffled.
    """
    hashed, few = df.withColumn("_key", F.xxhash64(*keys)), F.broadcast(repeated)
    alone = hashed.join(few, "_key", "left_anti").drop("_key")
    several = hashed.join(few, "_key", "left_semi").drop("_key")
    return alone.unionByName(keep_latest(several, keys, order_by))


def near_latest(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] = (), groups: int = GROUPS) -> DataFrame:
    """``df`` without many of the rows that ``keep_latest`` would not keep, for any number of keys.

    Each key's greatest value of the first ``order_by`` column is found from these columns alone. A
    row below the least of them in its group of keys cannot be its key's latest. The groups are few
    enough to be broadcast, so such rows go before any row is sorted or shuffled whole. ``df`` is
    read twice; where that column is missing or a text, it is handed back as it is.
    """
    if not order_by or order_by[0] in keys or not isinstance(df.schema[order_by[0]].dataType, _RANKED):
        return df
    first, group = F.col(order_by[0]), F.pmod(F.xxhash64(*keys), F.lit(groups)).cast("int")
    greatest = df.groupBy(*keys).agg(F.max(first).alias("_greatest"))
    least = greatest.groupBy(group.alias("_group")).agg(
        F.min("_greatest").alias("_least"), F.bool_or(F.col("_greatest").isNull()).alias("_none")
    )
    met = df.withColumn("_group", group).join(F.broadcast(least), "_group")
    return met.where(F.col("_none") | (first >= F.col("_least"))).select(*df.columns)


def duplicate_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows, distinct keys and the duplicates a dedup would drop, as one row."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    rows = F.coalesce(F.sum("n"), F.lit(0))
    return per_key.agg(
        rows.alias("rows"),
        F.count(F.lit(1)).alias("distinct_keys"),
        (rows - F.count(F.lit(1))).alias("duplicates"),
    )
