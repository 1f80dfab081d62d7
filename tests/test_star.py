import random
import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import plan, rows
from shoreline.operators import reports, star

CATEGORIES = ["A", "B", "C", None]


@pytest.fixture(scope="module")
def star_tables(spark):
    """Random tables with repeated dimension keys, unmatched keys and NULLs, as views."""
    rng = random.Random(5)
    products = [f"p{i}" for i in range(12)]
    users = [f"u{i}" for i in range(8)]
    stg = [
        (rng.choice(products), rng.choice(users), rng.choice([None, round(rng.uniform(1, 90), 2)]))
        for _ in range(150)
    ] + [("unknown", "u1", 5.0), (None, "u1", 5.0), ("p1", None, 5.0)]
    dim_product = [
        (p, f"name {i % 4}", CATEGORIES[i % 4], str(copy), "i", "l")
        for i, p in enumerate(products[:10])
        for copy in range(1 + i % 3)
    ] + [("alone", "name 9", "D", "x", "i", "l")]
    dim_user = [(u, f"user {i}") for i, u in enumerate(users[:6])] + [("u0", "other name")]
    dim_rating = [
        (rng.choice(users), rng.choice(products), rng.choice([None, Decimal("4.50"), Decimal("3.00")]), 1)
        for _ in range(40)
    ]
    made = {
        "stg": spark.createDataFrame(stg, "product_id string, user_id string, actual_price double"),
        "dim_product": spark.createDataFrame(
            dim_product,
            "product_id string, product_name string, category string, about_product string,"
            " img_link string, product_link string",
        ),
        "dim_user": spark.createDataFrame(dim_user, "user_id string, user_name string"),
        "dim_rating": spark.createDataFrame(
            dim_rating,
            "user_id string, product_id string, rating decimal(3,2), rating_count bigint",
        ),
    }
    made["fact_rating"] = star.fact_product_rating(
        made["stg"], made["dim_product"], made["dim_rating"]
    )
    made["fact_sales"] = star.fact_sales_category(
        made["stg"], made["dim_product"], made["dim_user"]
    )
    for name, df in made.items():
        df.createOrReplaceTempView(name)
    return made


def near(df):
    """Rows with doubles rounded: sums taken in another order differ in the last bit."""
    doubles = [c for c, t in df.dtypes if t == "double"]
    return rows(df.withColumns({c: F.round(c, 9) for c in doubles}) if doubles else df)


def literal_rating(spark):
    return spark.sql(
        """SELECT p.product_id, p.product_name, AVG(CAST(r.rating AS DOUBLE)) AS avg_rating
           FROM stg s JOIN dim_product p ON s.product_id = p.product_id
           JOIN dim_rating r ON r.product_id = p.product_id
           WHERE r.rating IS NOT NULL GROUP BY p.product_id, p.product_name"""
    )


def literal_sales(spark):
    return spark.sql(
        """SELECT u.user_id, p.category,
                  CAST(SUM(CAST(s.actual_price AS DECIMAL(10,2))) AS DECIMAL(38,2)) AS sales_amount
           FROM stg s JOIN dim_product p ON s.product_id = p.product_id
           JOIN dim_user u ON s.user_id = u.user_id GROUP BY u.user_id, p.category"""
    )


def test_rating_fact_equals_the_three_way_join(spark, star_tables):
    assert near(star_tables["fact_rating"]) == near(literal_rating(spark))


def test_sales_fact_equals_the_joins_with_repeated_keys(spark, star_tables):
    assert rows(star_tables["fact_sales"]) == rows(literal_sales(spark))


def test_facts_are_the_same_without_broadcasts(spark, star_tables, no_broadcast):
    t = star_tables
    sales = star.fact_sales_category(t["stg"], t["dim_product"], t["dim_user"])
    assert rows(sales) == rows(literal_sales(spark))


def test_staged_rows_are_shuffled_for_their_product_and_their_category_only(spark, star_tables, no_broadcast):
    t = star_tables
    steps = plan(star.fact_sales_category(t["stg"], t["dim_product"], t["dim_user"]))
    exchanged = re.findall(r"hashpartitioning\(((?:\w+#\d+L?, )+)\d+\)", steps)
    keys = {", ".join(re.findall(r"(\w+)#", columns)) for columns in exchanged}
    assert keys == {"product_id", "product_id, category", "user_id, category", "user_id"}


def test_strict_keys_reject_repeats_and_pass_unique_dimensions(spark, star_tables):
    t = star_tables
    strict = star.fact_sales_category(t["stg"], t["dim_product"], t["dim_user"], strict_keys=True)
    with pytest.raises(Exception, match="repeats in the dimension"):
        strict.collect()
    once = t["dim_product"].dropDuplicates(["product_id"])
    people = t["dim_user"].filter("user_name <> 'other name'")
    assert rows(star.fact_sales_category(t["stg"], once, people, strict_keys=True)) == rows(
        star.fact_sales_category(t["stg"], once, people)
    )


def test_dimensions(spark):
    stg = spark.createDataFrame(
        [("p", "n", "c", "a", "i", "l", "u", "x", "4,5", "3")] * 2,
        "product_id string, product_name string, category string, about_product string,"
        " img_link string, product_link string, user_id string, user_name string,"
        " rating string, rating_count string",
    )
    assert star.dim_product(stg).count() == 1
    assert rows(star.dim_user(stg)) == [("u", "x")]
    assert rows(star.dim_rating(stg)) == [("u", "p", Decimal("4.50"), 3)] * 2
    assert star.dim_rating(stg).dtypes[2:] == [("rating", "decimal(3,2)"), ("rating_count", "bigint")]


def test_rating_by_category_equals_the_join(spark, star_tables):
    got = reports.rating_by_category(star_tables["fact_rating"], star_tables["dim_product"])
    want = spark.sql(
        """SELECT p.category, AVG(f.avg_rating) AS avg_rating FROM fact_rating f
           JOIN dim_product p ON f.product_id = p.product_id
           GROUP BY p.category ORDER BY avg_rating DESC, p.category LIMIT 10"""
    )
    assert near(got) == near(want)


def test_sales_rating_equals_the_many_to_many_join(spark, star_tables, no_broadcast):
    got = reports.sales_rating_by_category(
        star_tables["dim_product"], star_tables["dim_rating"], star_tables["fact_sales"]
    )
    want = spark.sql(
        """SELECT p.category, ROUND(CAST(AVG(r.rating) AS DOUBLE), 2) AS avg_rating,
                  CAST(SUM(COALESCE(s.sales_amount, 10)) AS DECIMAL(38,2)) AS total_sales
           FROM dim_product p LEFT JOIN dim_rating r ON p.product_id = r.product_id
           LEFT JOIN fact_sales s ON p.category = s.category GROUP BY p.category"""
    )
    assert rows(got) == rows(want)
    without_sales = {r["category"]: r["total_sales"] for r in got.collect()}["D"]
    assert without_sales == Decimal("10.00")


def test_listing_orders_by_category_first_unless_asked_for_the_top(spark, star_tables):
    literal = """SELECT p.category, p.product_name,
                        CAST(SUM(COALESCE(s.sales_amount, 10)) AS DECIMAL(38,2)) AS total_sales
                 FROM fact_sales s JOIN dim_product p ON s.category = p.category
                 GROUP BY p.category, p.product_name"""
    args = (star_tables["fact_sales"], star_tables["dim_product"])
    by_name = [tuple(r) for r in reports.category_sales_listing(*args, top=4, names=True).collect()]
    want = spark.sql(f"{literal} ORDER BY category, total_sales DESC, product_name LIMIT 4")
    assert by_name == [tuple(r) for r in want.collect()]
    shown = reports.category_sales_listing(*args, top=4)
    assert [tuple(r) for r in shown.collect()] == [(c, t) for c, _, t in by_name]
    best = [tuple(r) for r in reports.category_sales_listing(*args, top=4, true_top_n=True, names=True).collect()]
    want = spark.sql(f"{literal} ORDER BY total_sales DESC, category, product_name LIMIT 4")
    assert best == [tuple(r) for r in want.collect()]


def test_rating_by_product_is_sorted(star_tables):
    got = reports.rating_by_product(star_tables["fact_rating"], star_tables["dim_product"]).collect()
    ratings = [r["avg_rating"] for r in got]
    assert ratings == sorted(ratings, reverse=True)


def test_totals_count_missing_sales_as_the_placeholder(spark):
    fact = spark.createDataFrame(
        [("u", "c", Decimal("5.50")), ("v", "c", None)],
        "user_id string, category string, sales_amount decimal(38,2)",
    )
    assert rows(reports.total_sales(fact)) == [(Decimal("15.50"),)]
    assert rows(reports.total_sales(fact, null_sales=0)) == [(Decimal("5.50"),)]
    assert rows(reports.sales_count(fact)) == [(2,)]


def test_reports_never_join_row_by_row_on_category(star_tables, no_broadcast):
    listing = reports.sales_rating_by_category(
        star_tables["dim_product"], star_tables["dim_rating"], star_tables["fact_sales"]
    )
    assert "CartesianProduct" not in plan(listing)
    assert "BroadcastNestedLoopJoin" not in plan(listing)


def test_hourly_revenue(spark):
    orders = spark.createDataFrame(
        [("2026-03-01 10:05:00", "100"), ("2026-03-01 10:40:00", "150"), ("2026-03-01 11:10:00", "80"),
         ("2026-02-28 23:59:59", "1")],
        "pedido_em string, valor string",
    ).select(F.col("pedido_em").cast("timestamp"), F.col("valor").cast("decimal(12,2)"))
    got = reports.hourly_revenue(orders, since="2026-03-01").collect()
    assert [(str(r.hora), r.pedidos, r.receita) for r in got] == [
        ("2026-03-01 10:00:00", 2, Decimal("250.00")),
        ("2026-03-01 11:00:00", 1, Decimal("80.00")),
    ]
    newest = reports.newest_hours(reports.hourly_revenue(orders), 1).collect()
    assert str(newest[0].hora) == "2026-03-01 11:00:00"


def test_hourly_filter_reaches_the_scan_and_skips_days(spark, tmp_path):
    from shoreline.sources import landing

    orders = spark.range(96).selectExpr(
        "id AS order_id",
        "timestamp'2026-03-01 00:00:00' + make_dt_interval(0, cast(id as int)) AS pedido_em",
        "cast(1 AS decimal(12,2)) AS valor",
    )
    landing.write_by_day(orders, f"{tmp_path}/vendas", "pedido_em")
    stored = spark.read.parquet(f"{tmp_path}/vendas")
    report = reports.hourly_revenue(stored, "2026-03-03", "dia")
    assert report.count() == 48
    assert "PushedFilters: [IsNotNull(pedido_em), GreaterThanOrEqual(pedido_em" in plan(report)
    assert "dia#" in plan(report).partition("PartitionFilters: [")[2][:80]


def test_dedup_shuffles_a_key_once(spark):
    from shoreline.operators.dedup import keep_latest

    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "w"), (None, 1, "n"), (None, 1, "m")], "k string, o int, v string")
    kept = keep_latest(df, ["k"], ["o"])
    assert kept.columns == df.columns and rows(kept) == [("a", 2, "w"), (None, 1, "n")]
    assert "max(struct(o, " in plan(kept) and "struct(o, o" in plan(kept) and ", k, " not in plan(kept)
    assert rows(keep_latest(df.select("k"), ["k"])) == [("a",), (None,)]


def test_rows_of_keys_that_do_not_repeat_are_staged_without_a_shuffle(spark, monkeypatch):
    from shoreline.operators.contracts import SALES
    from shoreline.operators.dedup import keep_latest, keep_latest_where_repeated, repeated_keys
    from shoreline.plans import pipeline

    df = spark.range(300).selectExpr(
        "if(id < 280, id, id % 4) AS k", "if(id % 90 = 7, NULL, id % 3) AS l", "id % 7 AS o", "md5(string(id)) AS v"
    )
    kept = keep_latest_where_repeated(df, ["k", "l"], ["o"], repeated_keys(df, ["k", "l"]))
    assert kept.columns == df.columns and rows(kept) == rows(keep_latest(df, ["k", "l"], ["o"]))
    assert 280 < kept.count() < 300

    given = []
    monkeypatch.setattr(pipeline.tables, "upsert", lambda spark, rows, *args, **options: given.append((rows, options)))
    names = [f.name for f in SALES]
    raw = spark.range(50).select(*[F.col("id").cast("string").alias(n) for n in names])
    raw = raw.unionByName(raw.where("id < 2").withColumn("rating_count", F.lit("99")))
    for most in (pipeline.MOST_BROADCAST, 1):
        monkeypatch.setattr(pipeline, "MOST_BROADCAST", most)
        pipeline.stage(spark, raw, "a.b", ["product_id", "user_id"], ["rating_count"])
    (few, options), (many, _) = given
    assert options["deal"] is False
    assert rows(few) == rows(many) and few.where("rating_count = 99").count() == 2 and few.count() == 50
    assert "LeftAnti" in plan(few) and "LeftAnti" not in plan(many)


@pytest.mark.parametrize("groups", [1, 7, 1 << 18])
def test_rows_that_others_outrank_go_before_the_dedup(spark, groups):
    from shoreline.operators.dedup import keep_latest, near_latest

    df = spark.range(3000).selectExpr(
        "if(id % 41 = 0, NULL, id % 40) AS k", "string(id % 2) AS l",
        "if(id % 40 = 3 OR id % 5 = 0, NULL, id div 40 % 7) AS o", "md5(string(id)) AS v",
    )
    near = near_latest(df, ["k", "l"], ["o", "v"], groups)
    assert near.columns == df.columns and near.exceptAll(df).count() == 0
    assert rows(keep_latest(near, ["k", "l"], ["o", "v"])) == rows(keep_latest(df, ["k", "l"], ["o", "v"]))
    known = df.where("k % 5 <> 0 AND k <> 3 AND o IS NOT NULL")  # every key has rows of each value
    assert near_latest(known, ["k"], ["o"], groups).select("o").distinct().count() == 1
    for order in ([], ["v"], ["k"]):
        assert near_latest(df, ["k"], order) is df


def test_many_repeated_keys_are_staged_without_the_rows_that_others_outrank(spark, monkeypatch):
    from shoreline.operators.contracts import SALES
    from shoreline.plans import pipeline

    given = []
    monkeypatch.setattr(pipeline.tables, "upsert", lambda spark, rows, *args, **options: given.append(rows))
    raw = spark.range(200).select(*[F.col("id").cast("string").alias(f.name) for f in SALES])
    raw = raw.withColumns({"product_id": (F.col("product_id").cast("int") % 20).cast("string")})
    for most in (pipeline.MOST_BROADCAST, 1):
        monkeypatch.setattr(pipeline, "MOST_BROADCAST", most)
        pipeline.stage(spark, raw, "a.b", ["product_id"], ["rating_count"])
    few, many = given
    assert rows(few) == rows(many) and many.count() == 20
    assert "_least" in plan(many)


def test_lines_meet_their_orders_before_the_long_columns_of_the_parts(spark, no_broadcast):
    from shoreline.plans import adapters

    order = spark.range(5).selectExpr("id AS o_orderkey", "id AS o_custkey", "'x' AS o_orderpriority")
    customer = spark.range(5).selectExpr("id AS c_custkey", "'n' || id AS c_name")
    part = spark.range(5).selectExpr("id AS p_partkey", "'p' || id AS p_name", "'t' || id AS p_type", "'b' || id AS p_brand")
    line = spark.range(5).selectExpr("id AS l_orderkey", "id AS l_partkey", "1 AS l_linenumber", "1.0 AS l_quantity", "1.0 AS l_extendedprice", "0.1 AS l_discount")
    joins = adapters.sales(line, part, order, customer)._jdf.queryExecution().optimizedPlan().toString()
    joins = [at for at in joins.splitlines() if "Join Inner" in at]
    assert "p_partkey" in joins[0] and "o_orderkey" in joins[1]
