"""Dimensions and facts of the sales star schema, each a function of its input tables.

Joins to a dimension with repeated keys multiply rows, and the results keep that meaning. But
the repeats are counted per key first and multiplied in, so the multiplied rows never exist.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from shoreline.functions import cleaning

MONEY = "decimal(38,2)"


def dim_product(stg: DataFrame) -> DataFrame:
    return stg.select(
        "product_id", "product_name", "category", "about_product", "img_link", "product_link"
    ).distinct()


def dim_user(stg: DataFrame) -> DataFrame:
    return stg.select("user_id", "user_name").distinct()


def dim_rating(stg: DataFrame) -> DataFrame:
    """One row per staged row; no deduplication."""
    return stg.select(
        "user_id",
        "product_id",
        cleaning.decimal_comma(stg, "rating", "decimal(3,2)").alias("rating"),
        cleaning.decimal_comma(stg, "rating_count", "bigint").alias("rating_count"),
    )


def fact_product_rating(
    stg: DataFrame, products: DataFrame, ratings: DataFrame
) -> DataFrame:
    """Average numeric rating of each staged product.

    Joining staging, product and rating repeats every rating of a product equally often, which
    an average cannot see. So: average first, then join, and staging is only an existence test.
    """
    numeric = ratings.select("product_id", cleaning.plain_number("rating").alias("r"))
    averages = (
        numeric.filter(F.col("r").isNotNull())
        .groupBy("product_id")
        .agg(F.avg("r").alias("avg_rating"))
    )
    staged = stg.select("product_id").distinct()
    names = products.select("product_id", "product_name").distinct()
    rated = averages.join(staged, "product_id", "left_semi")
    return names.join(rated, "product_id").select(
        "product_id", "product_name", "avg_rating"
    )


def _assert_unique(df: DataFrame, key: str) -> DataFrame:
    """``df`` reduced to its keys, failing inside the job when one repeats."""
    repeated = F.concat(F.lit(f"{key} repeats in the dimension: "), F.col(key))
    return df.withColumn(
        "repeats", F.when(F.col("repeats") > 1, F.raise_error(repeated)).otherwise(F.lit(1))
    )


def fact_sales_category(
    stg: DataFrame, products: DataFrame, users: DataFrame, strict_keys: bool = False
) -> DataFrame:
    """Sales per user and category.

    A repeated ``product_id`` or ``user_id`` in a dimension multiplies the amount, as the plain
    joins do; ``strict_keys`` turns that into an error. Staged rows meet one row per (product,
    category), so none is multiplied, and are summed per (user, category) before the second join.
    They are not summed per (user, product) first: staging seldom repeats a pair, and that would
    shuffle all of its rows once more. A hot product is split by adaptive execution.
    """
    sold = stg.select("user_id", "product_id", cleaning.price(stg, "actual_price").alias("amount"))
    categories = products.groupBy("product_id", "category").agg(
        F.count(F.lit(1)).alias("repeats")
    )
    people = users.groupBy("user_id").agg(F.count(F.lit(1)).alias("repeats"))
    if strict_keys:
        per_product = products.groupBy("product_id").agg(
            F.count(F.lit(1)).alias("repeats"), F.first("category").alias("category")
        )
        categories = _assert_unique(per_product, "product_id")
        people = _assert_unique(people, "user_id")

    def times(amount: str, repeats: str):
        return (F.col(amount) * F.col(repeats).cast("decimal(18,0)")).cast(MONEY)

    by_category = (
        sold.join(categories, "product_id")
        .groupBy("user_id", "category")
        .agg(F.sum(times("amount", "repeats")).cast(MONEY).alias("amount"))
    )
    # At most one row per category and user is left, so no user is hot any more.
    return by_category.join(people, "user_id").select(
        "user_id", "category", times("amount", "repeats").alias("sales_amount")
    )
