"""The given benchmark tables shaped like this package's inputs. Projections and joins only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from shoreline.functions.timestamps import bound
from shoreline.operators import cdc

MONEY = "decimal(12,2)"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def orders(source: DataFrame) -> DataFrame:
    """The orders table under the orders contract."""
    return source.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").alias("pedido_em"),
        F.col("o_totalprice").cast(MONEY).alias("valor"),
        F.col("o_orderstatus").alias("status"),
    )


def event_orders(source: DataFrame) -> DataFrame:
    """The events under the orders contract; unlike orders they carry a time of day."""
    return source.select(
        F.col("event_id").alias("order_id"),
        F.col("user_id").alias("customer_id"),
        F.col("ts").alias("pedido_em"),
        F.col("value").cast(MONEY).alias("valor"),
        F.col("event_type").alias("status"),
    )


def sales(lineitem: DataFrame, part: DataFrame, order: DataFrame, customer: DataFrame) -> DataFrame:
    """Line items as raw product reviews, one row each, with repeated keys."""
    lines = lineitem.select(
        F.col("l_orderkey").alias("o_orderkey"),
        F.col("l_partkey").alias("p_partkey"),
        "l_linenumber",
        "l_quantity",
        "l_extendedprice",
        "l_discount",
    )
    buyers = order.select("o_orderkey", F.col("o_custkey").alias("c_custkey"), "o_orderpriority").join(
        customer.select("c_custkey", "c_name"), "c_custkey"
    )
    parts = part.select("p_partkey", "p_name", "p_type", "p_brand")
    # the orders first: the lines are shuffled for them and have no long columns yet
    joined = lines.join(buyers, "o_orderkey").join(parts, "p_partkey")
    product, user = F.col("p_partkey").cast("string"), F.col("c_custkey").cast("string")
    return joined.select(
        F.concat(F.lit("P"), product).alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("discounted_price"),
        F.col("l_extendedprice").alias("actual_price"),
        (F.col("l_discount") * 100).alias("discount_percentage"),
        (1 + F.col("l_quantity") % 5).alias("rating"),
        F.col("l_linenumber").alias("rating_count"),
        F.concat(F.col("p_brand"), F.lit(" "), F.col("p_name")).alias("about_product"),
        F.concat(F.lit("U"), user).alias("user_id"),
        F.col("c_name").alias("user_name"),
        F.concat_ws("-", "o_orderkey", "p_partkey", "l_linenumber").alias("review_id"),
        F.concat(F.lit("about "), F.col("p_name")).alias("review_title"),
        F.col("o_orderpriority").alias("review_content"),
        F.concat(F.lit("https://img.example/"), product).alias("img_link"),
        F.concat(F.lit("https://shop.example/"), product).alias("product_link"),
    )


def sales_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales(*[table(spark, sf_dir, t) for t in ("lineitem", "part", "orders", "customer")])


def sales_text(raw: DataFrame) -> DataFrame:
    """Raw sales as a shop export writes them: currency sign, decimal comma, one extra column."""
    money = F.col("actual_price").cast("decimal(12,2)").cast("string")
    rating = F.col("rating").cast("decimal(3,1)").cast("string")
    return raw.withColumns(
        {
            "actual_price": F.concat(F.lit("R$ "), money),
            "rating": F.when(F.col("rating_count") > 3, F.replace(rating, F.lit("."), F.lit(",")))
            .otherwise(rating),
            "rating_count": F.col("rating_count").cast("string"),
            "exported": F.lit("yes"),
        }
    )


def _event_key() -> Column:
    return F.concat(F.lit("E"), F.expr("event_id div 4").cast("string"))


def _operation_of(event: str, user: str) -> Column:
    """Four events in a row are the life of one key: create, two updates, then an update or,
    for every other user, a delete."""
    step = F.col(event) % 4
    deleted = (step == 3) & (F.col(user) % 2 == 0)
    return F.when(step == 0, "c").when(deleted, "d").otherwise("u")


def _operation() -> Column:
    return _operation_of("event_id", "user_id")


def _time_text() -> Column:
    micros = F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return (
        F.when(F.col("event_id") % 11 == 5, F.lit("not a time"))
        .when(F.col("event_id") % 7 == 3, F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
        .otherwise(micros)
    )


def _image(event_type: Column) -> Column:
    user = F.col("user_id").cast("string")
    made = {
        "event_id": _event_key(),
        "event_timestamp": _time_text(),
        "event_type": event_type,
        "page_url": F.concat(F.lit("https://site.example/"), F.col("event_type")),
        "page_url_path": F.concat(F.lit("/"), F.col("event_type")),
        "utm_source": F.when(F.col("user_id") % 3 == 0, F.lit("mail")),
        "click_id": F.col("value").cast(MONEY).cast("string"),
        "geo_country": F.concat(F.lit("C"), (F.col("user_id") % 20).cast("string")),
        "ip_address": F.concat(F.lit("10.0.0."), (F.col("user_id") % 250).cast("string")),
        "browser_name": F.concat(F.lit("B"), (F.col("user_id") % 5).cast("string")),
        "browser_user_agent": F.concat(F.lit("agent/"), user),
        "device_is_mobile": F.col("user_id") % 2 == 0,
        "user_custom_id": F.concat(F.lit("custom-"), user),
        "user_domain_id": F.concat(F.lit("domain-"), user),
    }
    return F.struct(
        *[
            made.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in cdc.IMAGE.fields
        ]
    )


def envelope(events: DataFrame, offset: Column | None = None) -> DataFrame:
    """Events as change envelopes, one per event; works on a stream as well."""
    arrival = [] if offset is None else [offset.cast("bigint").alias("offset")]
    return events.select(
        F.when(
            _operation() != "c",
            _image(F.concat(F.lit("was "), F.col("event_type"))),
        ).alias("before"),
        F.when(_operation() != "d", _image(F.col("event_type"))).alias("after"),
        _operation().alias("op"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("ts_ms"),
        *arrival,
    )


def order_changes(events: DataFrame) -> DataFrame:
    """Events as changes of the orders table, four to a key, in the order of their ids."""
    rows = event_orders(events).withColumn("op", F.when(_operation_of("order_id", "customer_id") == "d", "d").otherwise("u"))
    return rows.select(
        F.expr("order_id div 4").alias("order_id"), "customer_id", "pedido_em", "valor", "status",
        "op", F.col("order_id").cast("bigint").alias("offset"),
    )


def customer_history(order: DataFrame) -> DataFrame:
    """What the lake knows of each customer, from the whole orders table."""
    return order.groupBy(F.col("o_custkey").alias("customer_id")).agg(
        F.count_if(F.col("o_orderdate") >= bound(order, "o_orderdate", F.lit("2001-05-03")))
        .cast("int")
        .alias("pedidos_ultimos_90d"),
        F.count_if(F.col("o_orderpriority") == "1-URGENT").cast("int").alias("chargebacks"),
    )


def live_orders(order: DataFrame) -> DataFrame:
    return order.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderdate").alias("updated_at"),
        F.col("o_custkey").alias("customer_id"),
    )


def live_events(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("event_id").alias("order_id"),
        F.col("event_type").alias("status"),
        F.col("ts").alias("updated_at"),
        F.col("user_id").alias("customer_id"),
    )
