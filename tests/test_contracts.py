from decimal import Decimal

import pytest
from pyspark.sql import functions as F, types as T

from conftest import rows
from shoreline.functions import cleaning, timestamps
from shoreline.operators import contracts
from shoreline.operators.dedup import duplicate_counts, keep_latest

SMALL = T.StructType().add("id", "string").add("rating", "double").add("n", "integer")
NORMALIZERS = {"rating": cleaning.comma_to_point, "n": cleaning.drop_thousands}


@pytest.fixture
def raw(spark):
    data = [("a", "4,5", "1,234", "x"), ("b", "3.5", "7", "x"), ("c", "abc", None, "x")]
    return spark.createDataFrame(data, "n_extra string, rating string, n string, id string").select(
        F.col("n").alias("n"), "rating", F.col("n_extra").alias("id"), F.col("id").alias("extra")
    )


def test_conform_keeps_declared_columns_in_order_and_nulls_bad_values(raw):
    out = contracts.conform(raw, SMALL)
    assert out.dtypes == [("id", "string"), ("rating", "double"), ("n", "int")]
    assert rows(out) == [("a", None, None), ("b", 3.5, 7), ("c", None, None)]


def test_normalizers_run_before_the_cast(raw):
    out = contracts.conform(raw, SMALL, NORMALIZERS)
    assert rows(out) == [("a", 4.5, 1234), ("b", 3.5, 7), ("c", None, None)]


def test_normalizers_leave_numbers_alone(spark):
    df = spark.createDataFrame([("a", 4.5, 3)], "id string, rating double, n int")
    assert rows(contracts.conform(df, SMALL, NORMALIZERS)) == [("a", 4.5, 3)]


def test_missing_column_fails_at_once(raw):
    with pytest.raises(ValueError, match="rating"):
        contracts.conform(raw.drop("rating"), SMALL)


def test_lost_values_counts_only_values_that_were_there(raw):
    assert rows(contracts.lost_values(raw, SMALL)) == [("id", 0), ("n", 1), ("rating", 2)]
    assert rows(contracts.lost_values(raw, SMALL, NORMALIZERS)) == [
        ("id", 0),
        ("n", 0),
        ("rating", 1),
    ]


def test_sales_contract_has_the_sixteen_columns():
    assert len(contracts.SALES) == 16
    assert contracts.SALES["rating_count"].dataType == T.IntegerType()


def test_price_cleaning_of_text_and_numbers(spark):
    text = spark.createDataFrame([("₹1,099.50",), ("",), ("free",), (None,)], "p string")
    assert [r[0] for r in text.select(cleaning.price(text, "p")).collect()] == [
        Decimal("1099.50"),
        None,
        None,
        None,
    ]
    numbers = spark.createDataFrame([(1.0e7,), (-5.0,), (1.0e9,)], "p double")
    assert [r[0] for r in numbers.select(cleaning.price(numbers, "p")).collect()] == [
        Decimal("10000000.00"),
        Decimal("-5.00"),
        None,
    ]


def test_decimal_comma_overflow_is_null(spark):
    df = spark.createDataFrame([("4,5",), ("10.5",), ("abc",)], "r string")
    assert [r[0] for r in df.select(cleaning.decimal_comma(df, "r", "decimal(3,2)")).collect()] == [
        Decimal("4.50"),
        None,
        None,
    ]


def test_plain_number_rejects_signs_and_text(spark):
    df = spark.createDataFrame([("4.5",), ("-1",), ("1.2.3",), ("",), (None,)], "r string")
    got = [r[0] for r in df.select(cleaning.plain_number("r")).collect()]
    assert got == [4.5, None, None, None, None]


def test_strict_and_best_effort_times(spark):
    texts = [
        "2024-01-02 03:04:05.123456",
        "2024-01-02 03:04:05",
        "2024-01-02T03:04:05Z",
        "02/01/2024 03:04:05",
        "1704164645",
        "20240102030405",
        "not a time",
        None,
    ]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    out = df.select(
        "i",
        timestamps.strict(F.col("t")).cast("string"),
        timestamps.best_effort(F.col("t")).cast("string"),
        timestamps.best_effort(F.col("t"), to_second=False).cast("string"),
    )
    got = {r[0]: tuple(r)[1:] for r in out.collect()}
    second = "2024-01-02 03:04:05"
    assert got[0] == (f"{second}.123456", second, f"{second}.123456")
    for i in (1, 2, 3, 4, 5):
        assert got[i] == (None, second, second), texts[i]
    assert got[6] == got[7] == (None, None, None)


def test_keep_latest_is_by_order_then_by_the_other_columns(spark):
    data = [("k", 1, "a"), ("k", 2, "b"), ("k", 2, "c"), ("l", None, "d"), ("l", 0, "a")]
    df = spark.createDataFrame(data, "key string, version int, name string")
    assert rows(keep_latest(df, ["key"], ["version"])) == [("k", 2, "c"), ("l", 0, "a")]
    shuffled = keep_latest(df.orderBy(F.rand(3)).repartition(5), ["key"], ["version"])
    assert rows(shuffled) == rows(keep_latest(df, ["key"], ["version"]))


def test_keep_latest_takes_composite_keys(spark):
    df = spark.createDataFrame([("p", "u", 1), ("p", "u", 2), ("p", "v", 1)], "p string, u string, n int")
    assert rows(keep_latest(df, ["p", "u"], ["n"])) == [("p", "u", 2), ("p", "v", 1)]


def test_duplicate_counts(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,), (None,)], "k string")
    assert rows(duplicate_counts(df, ["k"])) == [(5, 3, 2)]
    assert rows(duplicate_counts(df.limit(0), ["k"])) == [(0, 0, 0)]
