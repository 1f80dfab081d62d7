"""Text to timestamp, strict and lenient. Unreadable text becomes NULL, never an error."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

# The strict source pattern, and the layouts the lenient parser accepts
# besides ISO 8601 (which Spark reads without a pattern).
STRICT_PATTERN = "yyyy-MM-dd HH:mm:ss.SSSSSS"
LENIENT_PATTERNS = (
    "dd/MM/yyyy HH:mm:ss",
    "dd/MM/yyyy",
    "yyyy/MM/dd HH:mm:ss",
    "yyyyMMddHHmmss",
)


def strict(value: Column, pattern: str = STRICT_PATTERN) -> Column:
    return F.try_to_timestamp(value, F.lit(pattern))


def best_effort(
    value: Column, patterns: Sequence[str] = LENIENT_PATTERNS, to_second: bool = True
) -> Column:
    """First reading that works: ISO, then each pattern, then 9 or 10 digits as epoch seconds."""
    epoch = F.when(value.rlike("^[0-9]{9,10}$"), F.timestamp_seconds(value.try_cast("bigint")))
    # A digits-only text must not be read as a year by the ISO parser.
    iso = F.when(~value.rlike("^[0-9]+$"), F.try_to_timestamp(value))
    tries = [F.try_to_timestamp(value, F.lit(p)) for p in patterns]
    parsed = F.coalesce(iso, *tries, epoch)
    return F.date_trunc("second", parsed) if to_second else parsed


def hour(value: Column) -> Column:
    return F.date_trunc("hour", value.cast("timestamp"))


def bound(df: DataFrame, name: str, value: Column) -> Column:
    """A time to compare a column with, in the column's own type.

    Were the types to differ, the cast would land on the column and keep the filter from the scan.
    """
    return value.cast(df.schema[name].dataType)
