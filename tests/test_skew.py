"""Hot join keys are split by adaptive execution, by the blocks that the map tasks wrote for them."""

import pytest
from pyspark.sql import functions as F

SMALL = {
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100b",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100b",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.fixture
def small_partitions(spark, no_broadcast):
    before = {k: spark.conf.get(k, None) for k in SMALL}
    for k, v in SMALL.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def most_rows_in_a_task(df):
    # the payload is looked at, or Spark would not even shuffle it
    counted = df.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n"), F.max("v").alias("v"))
    return counted.agg(F.max("n"), F.max("v")).first()[0]


@pytest.mark.parametrize("key, how", [("7", "inner"), ("cast(NULL AS bigint)", "left")])
def test_a_hot_key_is_spread_over_tasks(spark, small_partitions, key, how):
    left = spark.range(8000, numPartitions=16).selectExpr(f"IF(id % 3 = 0, {key}, id) AS k", "md5(string(id)) AS v")
    right = spark.range(8000).selectExpr("id AS k", "id AS r")
    joined = left.join(right, "k", how)
    assert most_rows_in_a_task(joined) < 2000
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")
    try:
        assert most_rows_in_a_task(left.join(right, "k", how)) > 2666
    finally:
        spark.conf.unset("spark.sql.adaptive.skewJoin.enabled")


def test_building_a_plan_runs_no_job(spark, no_broadcast, tmp_path):
    from shoreline.plans import adapters

    order = spark.range(5).selectExpr("id AS o_orderkey", "id AS o_custkey", "'x' AS o_orderpriority")
    customer = spark.range(5).selectExpr("id AS c_custkey", "'n' AS c_name")
    part = spark.range(5).selectExpr("id AS p_partkey", "'p' AS p_name", "'t' AS p_type", "'b' AS p_brand")
    line = spark.range(5).selectExpr("id AS l_orderkey", "id AS l_partkey", "1 AS l_linenumber", "1.0 AS l_quantity", "1.0 AS l_extendedprice", "0.1 AS l_discount")
    tracker = spark.sparkContext.statusTracker()
    before = len(tracker.getJobIdsForGroup(None))
    sales = adapters.sales(line, part, order, customer)
    assert len(tracker.getJobIdsForGroup(None)) == before
    assert sales.count() == 5
