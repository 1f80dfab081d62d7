"""Column profiles kept per partition as mergeable sketches, so that only new partitions are read.

How many distinct values a column has cannot be added up from the counts of its partitions; sketches
can. A table that gets a partition a day is profiled by reading that day, and a rule over the whole
table by merging small rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from shoreline.session import file_system, setting

# Registers of a sketch, as a power of two, and the standard error that goes with them.
LOG_REGISTERS = 14
ERROR = 1.04 / 2 ** (LOG_REGISTERS / 2)
# Estimates farther off than that many standard errors are not expected.
ERRORS = 3


def profile(df: DataFrame, columns: Sequence[str], by: str) -> DataFrame:
    """One row per partition and column: ``by, column_name, row_count, non_null, sketch``.

    All columns are measured by one aggregate whose groups are the partitions.
    """
    measures = [F.count(F.lit(1)).alias("row_count")]
    for i, column in enumerate(columns):
        text = F.col(column).cast("string")
        measures += [
            F.count(column).alias(f"non_null_{i}"),
            F.hll_sketch_agg(text, F.lit(LOG_REGISTERS)).alias(f"sketch_{i}"),
        ]
    rows = [
        F.struct(
            F.lit(column).alias("column_name"),
            F.col(f"non_null_{i}").alias("non_null"),
            F.col(f"sketch_{i}").alias("sketch"),
        )
        for i, column in enumerate(columns)
    ]
    measured = df.groupBy(by).agg(*measures)
    return measured.select("row_count", F.inline(F.array(*rows)), by)


def update(spark: SparkSession, df: DataFrame, path: str, columns: Sequence[str], by: str) -> DataFrame:
    """Profile the partitions that are not profiled yet; returns the profiles of all.

    ``df`` reads a folder partitioned by ``by``; partitions known already are pruned from its scan. A
    partition whose rows have changed is profiled again once its folder below ``path`` is gone.
    """
    fs, place = file_system(spark, path)
    if fs.exists(place):
        known = [r[0] for r in spark.read.parquet(path).select(by).distinct().collect()]
        df = df.where(~F.col(by).isin(known))
    with setting(spark, "spark.sql.sources.partitionOverwriteMode", "dynamic"):
        fresh = profile(df, columns, by).hint("rebalance", by)
        fresh.write.mode("overwrite").partitionBy(by).parquet(path)
    return spark.read.parquet(path)


def merged(profiles: DataFrame) -> DataFrame:
    """One row per column over all partitions: ``column_name, row_count, non_null, distinct_values``,
    the last one estimated."""
    sketch = F.hll_union_agg("sketch")
    return profiles.groupBy("column_name").agg(
        F.sum("row_count").alias("row_count"),
        F.sum("non_null").alias("non_null"),
        F.coalesce(F.hll_sketch_estimate(sketch), F.lit(0)).alias("distinct_values"),
    )


def unique_proportion(profiles: DataFrame, at_least: float = 0.99) -> DataFrame:
    """``column_name, row_count, non_null, observed, passed``: distinct values over non-null ones.

    ``observed`` is an estimate, cut off at 1. A column passes unless its estimate is below the bound
    by more than the sketch's error, so a column that meets it does not fail for the estimate's sake.
    """
    share = F.coalesce(F.try_divide("distinct_values", "non_null"), F.lit(0.0))
    return merged(profiles).select(
        "column_name",
        "row_count",
        "non_null",
        F.least(share, F.lit(1.0)).alias("observed"),
        (share >= at_least * (1 - ERRORS * ERROR)).alias("passed"),
    )
