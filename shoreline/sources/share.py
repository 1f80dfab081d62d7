"""Let a consumer namespace read a producer's tables without copying them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession

from shoreline.sources import tables as catalog


def _shareable(spark: SparkSession, producer: str) -> list[str]:
    found = spark.sql(f"SHOW TABLES IN {producer}").collect()
    named = [r["tableName"] for r in found if not r["isTemporary"]]
    return [name for name in named if not catalog.is_internal(name)]


def publish(
    spark: SparkSession, producer: str, consumer: str, tables: Sequence[str] | None = None
) -> list[str]:
    """Mount the producer's tables (all of them by default) as views of the consumer.

    Rows written later are visible at once. A view keeps the columns it was made with, so publish
    again after the producer's schema changes.
    """
    catalog.ensure_namespace(spark, consumer)
    shared = list(tables) if tables is not None else _shareable(spark, producer)
    for table in shared:
        spark.sql(
            f"CREATE OR REPLACE VIEW {consumer}.{table} AS SELECT * FROM {producer}.{table}"
        )
    return shared


def revoke(spark: SparkSession, consumer: str, tables: Sequence[str]) -> None:
    for table in tables:
        spark.sql(f"DROP VIEW IF EXISTS {consumer}.{table}")
