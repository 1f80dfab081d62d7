"""Every registered query against its SQL over the smallest given tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from shoreline.plans import oracle, registry
from tools.check_oracle import normal

SF_DIR = "/root/testdata/sf0.001"
SQL = oracle.SQL

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="the given tables are absent")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in os.listdir(SF_DIR):
        connection.execute(f"CREATE VIEW {file.split('.')[0]} AS SELECT * FROM '{SF_DIR}/{file}'")
    return connection


def test_every_sql_has_its_query():
    assert set(SQL) == set(registry.QUERIES)
    assert set(SQL) <= set(entry.oracle_sql()) and set(registry.QUERIES) <= set(entry.queries())


def test_entry_runs(spark):
    assert entry.entry(spark).columns == ["hora", "pedidos", "receita"]


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_sql(spark, duck, name):
    got = entry.queries()[name](spark, SF_DIR).toPandas()
    want = duck.execute(SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert normal(got) == normal(want)


def test_streams_take_several_bounded_batches(spark):
    """A landed folder is read a few files at a time."""
    stream = registry._event_stream(spark, SF_DIR)
    seen = []
    query = stream.writeStream.foreachBatch(lambda batch, number: seen.append(number))
    query.trigger(availableNow=True).start().awaitTermination()
    assert len(seen) > 1
