"""Join the current rows of a live source with history kept in the lake."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from shoreline.functions.timestamps import bound
from shoreline.session import shared_folder

# So many keys are handed to the history's scan as values, which it can skip row groups by.
POINT_KEYS = 10


def recent(
    live: DataFrame, minutes: int = 15, now: Column | None = None, updated: str = "updated_at"
) -> DataFrame:
    """Rows changed in the last minutes. ``now`` defaults to the query's current time.

    The comparison leaves the column bare so that the source can evaluate it.
    """
    now = F.current_timestamp() if now is None else now
    since = now - F.make_dt_interval(mins=F.lit(minutes))
    return live.filter(F.col(updated) > bound(live, updated, since))


def with_history(
    live: DataFrame, history: DataFrame, key: str = "customer_id"
) -> DataFrame:
    """Every live row with its history columns, NULL where there is none.

    A plain join, so that the source is asked once; a customer holding much of it, or rows without
    one, are split by adaptive execution, which nothing after the join prevents.
    """
    return live.join(history, key, "left")


def lookup(
    live: DataFrame,
    history: DataFrame,
    where: Column,
    key: str = "customer_id",
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """The live rows matching ``where``, left-joined to history on ``key``.

    The source is asked once: the matched rows are stored in the shared folder, so the join sees
    one state of them and Catalyst knows their size. Their keys thin out the history scan first: a
    few as values pushed down to its files, see ``landing.write_for_lookup``; more by a semi join,
    which Catalyst broadcasts or shuffles by their size.
    """
    spark = live.sparkSession
    path = shared_folder(spark, "lookup")
    live.filter(where).write.parquet(path)
    matched = spark.read.schema(live.schema).parquet(path)
    keys = matched.select(key).where(F.col(key).isNotNull()).distinct()
    few = [r[0] for r in keys.limit(POINT_KEYS + 1).collect()]
    if len(few) <= POINT_KEYS:
        known = history.where(F.col(key).isin(few))
    else:
        known = history.join(keys, key, "left_semi")
    joined = matched.join(known, key, "left")
    return joined.select(*columns) if columns else joined
