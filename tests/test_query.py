import time
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from conftest import plan, rows
from shoreline.operators import federate, query
from shoreline.sources import landing


@pytest.fixture
def numbers(spark):
    spark.range(20).createOrReplaceTempView("numbers")


def test_result_carries_rows_and_metadata(spark, numbers):
    got = query.bounded_query(spark, "SELECT id, id * 2 AS twice FROM numbers ORDER BY id DESC;", 3)
    assert got.data == [{"id": 19, "twice": 38}, {"id": 18, "twice": 36}, {"id": 17, "twice": 34}]
    assert (got.row_count, got.column_names, got.truncated) == (3, ["id", "twice"], True)


@pytest.mark.parametrize("cap, truncated", [(19, True), (20, False), (21, False)])
def test_truncated_only_when_rows_are_missing(spark, numbers, cap, truncated):
    assert query.bounded_query(spark, "SELECT * FROM numbers", cap).truncated is truncated


def test_common_table_expressions_and_comments(spark, numbers):
    got = query.bounded_query(spark, "WITH t AS (SELECT max(id) AS m FROM numbers) SELECT m FROM t -- end")
    assert got.data == [{"m": 19}]


@pytest.mark.parametrize("sql", [None, "", "  ", "SELECT java_method('java.lang.System', 'exit', 1)", "SELECT REFLECT ('a', 'b')", "SELECT `reflect`('a', 'b')", "SELECT reflect/**/('a', 'b')", "WITH t AS (SELECT (SELECT max(reflect('a', 'b')) FROM range(2)) AS x) SELECT * FROM t", "SELECT * FROM text.`/etc/hostname`", "SELECT 1 WHERE EXISTS (SELECT * FROM parquet.`/x`)"])
def test_bad_input(spark, sql):
    with pytest.raises(query.QueryInputError):
        query.bounded_query(spark, sql)


@pytest.mark.parametrize("sql", ["SELECT * FROM IDENTIFIER('text.`{path}`')", "SELECT * FROM IDENTIFIER('te' || 'xt.`{path}`')", "SELECT IDENTIFIER('ref' || 'lect')('java.lang.Math', 'abs', 1)", "WITH t AS (SELECT * FROM IDENTIFIER('text.`{path}`')) SELECT * FROM t", "SELECT (SELECT max(value) FROM IDENTIFIER('text.`{path}`'))", "SELECT * FROM csv.`{path}`"])
def test_computed_names_reach_no_file_and_no_jvm(spark, tmp_path, sql):
    (tmp_path / "secret").write_text("hidden")
    with pytest.raises(query.QueryInputError):
        query.bounded_query(spark, sql.format(path=tmp_path / "secret"))


def test_views_and_tables_over_files_are_allowed(spark, namespace, tmp_path):
    spark.range(3).write.parquet(f"{tmp_path}/v")
    spark.read.parquet(f"{tmp_path}/v").createOrReplaceTempView("over_files")
    spark.range(4).write.saveAsTable(f"{namespace}.stored")
    spark.sql(f"CREATE VIEW {namespace}.shown AS SELECT id + 1 AS id FROM {namespace}.stored")
    for name, count in (("over_files", 3), (f"{namespace}.stored", 4), (f"{namespace}.shown", 4)):
        assert query.bounded_query(spark, f"SELECT count(*) AS n FROM {name} WHERE id IN (SELECT id FROM over_files)").row_count == 1
        assert query.bounded_query(spark, f"SELECT * FROM {name}").row_count == count


def test_a_slow_query_ends_and_so_do_its_jobs(spark):
    start, tracker = time.time(), spark.sparkContext.statusTracker()
    with pytest.raises(query.QueryTimeout, match="longer than 3"):
        query.bounded_query(spark, "SELECT SUM(sqrt(id % 7)) AS s FROM range(1000000000000)", seconds=3)
    assert time.time() - start < 20
    while tracker.getActiveStageIds() and time.time() - start < 60:
        time.sleep(0.2)
    assert not tracker.getActiveStageIds()
    assert query.bounded_query(spark, "SELECT 1 AS x", seconds=60).data == [{"x": 1}]
    with pytest.raises(query.QueryInputError):
        query.bounded_query(spark, "SELECT 1", seconds=0)


def test_bad_cap(spark):
    with pytest.raises(query.QueryInputError):
        query.bounded_query(spark, "SELECT 1", 0)


@pytest.mark.parametrize("sql", ["SELEC 1", "SELECT * FROM no_such_table", "SELECT 1 / 0 AS x"])
def test_failing_sql_is_one_typed_error(spark, sql):
    with pytest.raises(query.QueryFailed):
        query.bounded_query(spark, sql)


@pytest.mark.parametrize("sql", ["DROP TABLE t", "CREATE TABLE {ns}.x (a int) USING parquet", "SELECT 1) ; DROP TABLE t --", "SET a=b"])
def test_only_queries_run(spark, namespace, sql):
    with pytest.raises(query.QueryFailed):
        query.bounded_query(spark, sql.format(ns=namespace))


HISTORY = "customer_id bigint, pedidos_ultimos_90d int, chargebacks int"
LIVE = "order_id bigint, status string, updated_at timestamp, customer_id bigint"


@pytest.fixture
def live(spark, tmp_path):
    at = lambda minute, micro=0: datetime(2026, 3, 1, 12, minute, 0, micro)
    data = [(1, "new", at(50), 10), (2, "paid", at(45), 11), (3, "paid", at(45, 1), None), (4, "new", at(10), 10)]
    spark.createDataFrame(data, LIVE).write.parquet(f"{tmp_path}/live")
    return spark.read.parquet(f"{tmp_path}/live")


@pytest.fixture
def history(spark, tmp_path):
    spark.createDataFrame([(10, 5, 1), (99, 1, 0)], HISTORY).write.parquet(f"{tmp_path}/history")
    return spark.read.parquet(f"{tmp_path}/history")


def test_a_harmless_text_may_name_a_function(spark):
    found = query.bounded_query(spark, "SELECT 'reflect (x)' AS said")
    assert found.data == [{"said": "reflect (x)"}]


def test_lookup_with_and_without_history(live, history):
    columns = ["order_id", "status", "pedidos_ultimos_90d", "chargebacks"]
    one = federate.lookup(live, history, F.col("order_id") == 1, columns=columns)
    assert rows(one) == [(1, "new", 5, 1)]
    assert rows(federate.lookup(live, history, F.col("order_id") == 2, columns=columns)) == [(2, "paid", None, None)]
    assert rows(federate.lookup(live, history, F.col("order_id") == 3, columns=columns)) == [(3, "paid", None, None)]
    assert rows(federate.lookup(live, history, F.col("order_id") == 77, columns=columns)) == []


def test_lookup_of_many_rows_has_the_same_plan(live, history, no_broadcast):
    columns = live.columns + ["chargebacks"]
    found = federate.lookup(live, history, F.col("order_id") > 0, columns=columns)
    assert rows(found) == rows(federate.with_history(live, history).select(*columns)) and found.count() == 4


def test_lookup_asks_the_live_side_once_and_thins_out_history(live, history, monkeypatch):
    few = plan(federate.lookup(live, history, F.col("order_id") == 1))
    assert "/live" not in few and "EqualTo(customer_id,10)" in few
    monkeypatch.setattr(federate, "POINT_KEYS", 0)
    many = plan(federate.lookup(live, history, F.col("order_id") == 1))
    assert "/live" not in many and "LeftSemi" in many


def scanned_rows(spark, path, key):
    """How many rows a scan for one key hands on, before they are filtered one by one."""
    found = spark.read.parquet(path).where(F.col("key") == key)
    count = len(found.collect())
    leaves = found._jdf.queryExecution().executedPlan().collectLeaves()
    return count, leaves.apply(0).metrics().apply("numOutputRows").value()


def test_bloom_filters_skip_row_groups_for_a_single_key(spark, tmp_path):
    """Keys in no order, so that the row groups' ranges all hold the key that is looked up."""
    rows = spark.range(0, 60_000, numPartitions=1).select((F.xxhash64("id") % 10_000_019).alias("key"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
    with_filter, without = f"{tmp_path}/a", f"{tmp_path}/b"
    landing.write_for_lookup(rows, with_filter, {"key": 5_000}, row_group_bytes=1 << 18)
    rows.write.option("parquet.block.size", 1 << 18).option("parquet.enable.dictionary", "false").parquet(without)
    key = rows.first().key
    assert scanned_rows(spark, without, key) == (1, 60_000)
    found, read = scanned_rows(spark, with_filter, key)
    assert found == 1 and read < 30_000


def test_recent_is_strict_and_pushed_down(live):
    now = F.lit("2026-03-01 13:00:00").cast("timestamp")
    found = federate.recent(live, now=now)
    assert [r[0] for r in rows(found)] == [1, 3]
    assert "GreaterThan(updated_at" in plan(found)


def test_recent_defaults_to_the_present(spark):
    live = spark.sql("SELECT 1 AS id, current_timestamp() - INTERVAL 5 MINUTES AS updated_at UNION ALL SELECT 2, current_timestamp() - INTERVAL 20 MINUTES")
    assert [r.id for r in federate.recent(live).collect()] == [1]
