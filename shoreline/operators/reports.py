"""The dashboard and revenue reports over the star schema and the orders table.

Every ordered report ends its sort with a unique key, so equal values do not make rows come and
go at the limit. A limit sorts only its own rows per task (``TakeOrderedAndProject``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from shoreline.functions.timestamps import bound, hour

MONEY = "decimal(38,2)"


def _sales_or_default(null_sales: int) -> Column:
    # The reports count a missing amount as a fixed placeholder, kept as a parameter.
    return F.coalesce(F.col("sales_amount"), F.lit(null_sales).cast(MONEY))


def rating_by_category(fact_rating: DataFrame, products: DataFrame, top: int = 10) -> DataFrame:
    """Mean of the products' average ratings per category, best first.

    The fact is reduced to one row per product, so that each dimension row meets at most one and
    a product listed several times weighs as often as the plain join would repeat it.
    """
    per_product = fact_rating.groupBy("product_id").agg(
        F.sum("avg_rating").alias("total"), F.count("avg_rating").alias("n")
    )
    listed = products.select("product_id", "category")
    return (
        listed.join(per_product, "product_id")
        .groupBy("category")
        .agg(F.try_divide(F.sum("total"), F.sum("n")).alias("avg_rating"))
        .orderBy(F.desc("avg_rating"), "category")
        .limit(top)
    )


def sales_rating_by_category(
    products: DataFrame,
    ratings: DataFrame,
    fact_sales: DataFrame,
    null_sales: int = 10,
    top: int = 10,
) -> DataFrame:
    """Rating and sales side by side, lowest rating first, then highest sales.

    The report joins product to rating on the product and then to sales on the *category*, which
    repeats each sales row once per (product, rating) row of its category. With
    ``n = sum over products of max(1, ratings)`` the repeated total is ``n * sum(sales)``, or
    ``n * null_sales`` without sales, and the repeated average is the plain one. Only one row per
    category is ever joined to sales.
    """
    rated = ratings.groupBy("product_id").agg(
        F.count(F.lit(1)).alias("rating_rows"),
        F.count("rating").alias("rated"),
        F.sum("rating").cast(MONEY).alias("rating_sum"),
    )
    listed = products.select("product_id", "category")
    per_category = (
        listed.join(rated, "product_id", "left")
        .groupBy("category")
        .agg(
            F.sum(F.coalesce("rating_rows", F.lit(1))).alias("joined_rows"),
            F.sum("rated").alias("rated"),
            F.sum("rating_sum").cast("double").alias("rating_sum"),
        )
    )
    sales = fact_sales.groupBy("category").agg(
        F.sum(_sales_or_default(null_sales)).cast(MONEY).alias("sales")
    )
    total = F.coalesce("sales", F.lit(null_sales).cast(MONEY))
    return (
        per_category.join(sales, "category", "left")
        .select(
            "category",
            F.round(F.try_divide("rating_sum", "rated"), 2).alias("avg_rating"),
            (F.col("joined_rows").cast("decimal(18,0)") * total).cast(MONEY).alias("total_sales"),
        )
        .orderBy(F.asc_nulls_last("avg_rating"), F.desc("total_sales"), "category")
        .limit(top)
    )


def rating_by_product(fact_rating: DataFrame, products: DataFrame) -> DataFrame:
    """Every rated product, best first. The sort is by range over the full key, not the rating
    alone, so a rating shared by many products does not land in one task."""
    listed = products.select("product_id", "product_name")
    rated = fact_rating.select("product_id", "avg_rating")
    joined = listed.join(rated, "product_id")
    return joined.orderBy(F.desc("avg_rating"), "product_id", "product_name")


def category_sales_listing(
    fact_sales: DataFrame,
    products: DataFrame,
    null_sales: int = 10,
    top: int = 10,
    true_top_n: bool = False,
    names: bool = False,
) -> DataFrame:
    """Sales per (category, product name), by category name and then sales; ``names`` shows the
    product names, which the report only groups by.

    The join on category pairs every sales row with every product of the category; here the
    category's sum is taken first and multiplied by how often the name occurs. The sort by
    category comes first as in the report, so it lists the first categories rather than the
    best-selling ones; ``true_top_n`` sorts by sales instead.
    """
    sales = fact_sales.groupBy("category").agg(
        F.sum(_sales_or_default(null_sales)).cast(MONEY).alias("sales")
    )
    listed = products.groupBy("category", "product_name").agg(F.count(F.lit(1)).alias("times"))
    listing = listed.join(sales, "category").select(
        "category",
        "product_name",
        (F.col("times").cast("decimal(18,0)") * F.col("sales")).cast(MONEY).alias("total_sales"),
    )
    by_sales = F.desc("total_sales")
    order = [by_sales, "category"] if true_top_n else ["category", by_sales]
    first = listing.orderBy(*order, "product_name").limit(top)
    return first if names else first.drop("product_name")


def total_sales(fact_sales: DataFrame, null_sales: int = 10) -> DataFrame:
    return fact_sales.agg(
        F.sum(_sales_or_default(null_sales)).cast(MONEY).alias("total_sales")
    )


def sales_count(fact_sales: DataFrame) -> DataFrame:
    return fact_sales.agg(F.count(F.lit(1)).alias("total_sales"))


def hourly_revenue(
    orders: DataFrame, since: str | None = None, day_column: str | None = None
) -> DataFrame:
    """Orders and revenue per hour.

    ``since`` reaches the scan as a pushed-down filter. Over a table stored by day, naming its
    ``day_column`` also skips the folders of earlier days.
    """
    if since is not None:
        orders = orders.filter(F.col("pedido_em") >= bound(orders, "pedido_em", F.lit(since)))
        if day_column is not None:
            orders = orders.filter(F.col(day_column) >= F.to_date(F.lit(since).cast("timestamp")))
    return (
        orders.groupBy(hour(F.col("pedido_em")).alias("hora"))
        .agg(
            F.count(F.lit(1)).alias("pedidos"), F.sum("valor").cast(MONEY).alias("receita")
        )
        .orderBy("hora")
    )


def newest_hours(hourly: DataFrame, count: int = 5) -> DataFrame:
    return hourly.orderBy(F.desc("hora")).limit(count)
