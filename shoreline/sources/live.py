"""Tables of a running database, read in place."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def live_table(
    spark: SparkSession,
    url: str,
    table: str,
    *,
    partition_column: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = 8,
    **options: str,
) -> DataFrame:
    """A JDBC table. Filters and column choices are evaluated by the database.

    Without ``partition_column`` the scan is one connection, right for lookups. A wide scan names
    a numeric column and its bounds and is split over ``partitions`` connections.
    """
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, **options)
    if partition_column is not None:
        if bounds is None:
            raise ValueError("partition_column needs bounds")
        reader = reader.options(
            partitionColumn=partition_column,
            lowerBound=str(bounds[0]),
            upperBound=str(bounds[1]),
            numPartitions=str(partitions),
        )
    return reader.load()
