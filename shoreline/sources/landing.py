"""Raw file sets: reading them, landing tables as files, and choosing which tables to take."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from shoreline.operators.cdc import snapshot_as_changes


def read_landing(spark: SparkSession, path: str) -> DataFrame:
    """A landed Parquet folder as it is; ``contracts.conform`` then fixes names and types.

    No schema is imposed here: a declared column missing in the files must fail, not read NULL.
    """
    return spark.read.parquet(path)


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def write_by_day(df: DataFrame, path: str, ts_col: str, day_column: str = "dia") -> None:
    """Parquet in one folder per day, sorted by time inside each file.

    The rebalance hint gathers a day's rows into few files and, with adaptive execution, splits a
    day that is much larger than the others over several tasks.
    """
    dated = df.withColumn(day_column, F.to_date(ts_col)).hint("rebalance", day_column)
    dated = dated.sortWithinPartitions(day_column, ts_col)
    dated.write.mode("overwrite").partitionBy(day_column).parquet(path)


def write_for_lookup(
    df: DataFrame, path: str, keys: Mapping[str, int], row_group_bytes: int = 32 << 20
) -> None:
    """Parquet for lookups of single keys: every row group carries a Bloom filter of each key.

    ``keys`` names the columns and about how many distinct values a row group has of each, which sets
    the filters' size. A scan for a few values then skips row groups that cannot hold them, also
    where the rows are in no order and their ranges tell nothing.
    """
    writer = df.write.mode("overwrite").option("parquet.block.size", row_group_bytes)
    for key, distinct in keys.items():
        writer = writer.option(f"parquet.bloom.filter.enabled#{key}", "true")
        writer = writer.option(f"parquet.bloom.filter.expected.ndv#{key}", distinct)
    writer.parquet(path)


def landing_path(folder: str, schema: str, table: str) -> str:
    return f"{folder.rstrip('/')}/{schema}/{table}"


def land(df: DataFrame, folder: str, schema: str, table: str) -> str:
    """Write a table as gzip Parquet under ``<folder>/<schema>/<table>`` and return the path."""
    path = landing_path(folder, schema, table)
    df.write.mode("overwrite").option("compression", "gzip").parquet(path)
    return path


def _matches(pattern: str, name: str) -> bool:
    return re.fullmatch(".*".join(map(re.escape, re.split("[*%]", pattern))), name) is not None


def select_tables(
    names: Iterable[str], includes: Sequence[str] = (), excludes: Sequence[str] = ()
) -> list[str]:
    """Dotted table names that match an include pattern (none given: all) and no exclude.

    ``*`` and ``%`` both stand for any text.
    """
    return [
        name
        for name in names
        if (not includes or any(_matches(p, name) for p in includes))
        and not any(_matches(p, name) for p in excludes)
    ]


def full_load(
    read: Callable[[str], DataFrame],
    names: Iterable[str],
    folder: str,
    includes: Sequence[str] = (),
    excludes: Sequence[str] = (),
    committed_ms: int | None = None,
) -> dict[str, str]:
    """Land every selected ``…schema.table`` and return its path.

    The loop runs over table names; each table is copied by one distributed write. With
    ``committed_ms``, the time at which the copy was taken, rows also get the operation ``r`` and
    that time, so that the copy and the changes after it replay in order as one log.
    """

    def rows(name: str) -> DataFrame:
        return read(name) if committed_ms is None else snapshot_as_changes(read(name), committed_ms)

    return {
        name: land(rows(name), folder, *name.split(".")[-2:])
        for name in select_tables(names, includes, excludes)
    }
