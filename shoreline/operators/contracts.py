"""Declared schemas, and the projection that makes a source follow them."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, functions as F, types as T

# The declared columns and types of the two source tables.
SALES = (
    T.StructType()
    .add("product_id", "string")
    .add("product_name", "string")
    .add("category", "string")
    .add("discounted_price", "double")
    .add("actual_price", "double")
    .add("discount_percentage", "double")
    .add("rating", "double")
    .add("rating_count", "integer")
    .add("about_product", "string")
    .add("user_id", "string")
    .add("user_name", "string")
    .add("review_id", "string")
    .add("review_title", "string")
    .add("review_content", "string")
    .add("img_link", "string")
    .add("product_link", "string")
)
ORDERS = (
    T.StructType()
    .add("order_id", "long")
    .add("customer_id", "long")
    .add("pedido_em", "timestamp")
    .add("valor", "decimal(12,2)")
    .add("status", "string")
)

Normalizer = Callable[[Column], Column]


def _prepared(df: DataFrame, name: str, normalizers: Mapping[str, Normalizer]) -> Column:
    if name in normalizers and isinstance(df.schema[name].dataType, T.StringType):
        return normalizers[name](F.col(name))
    return F.col(name)


def conform(
    df: DataFrame, contract: T.StructType, normalizers: Mapping[str, Normalizer] | None = None
) -> DataFrame:
    """Exactly the contract's columns, in order, cast to its types.

    A value that cannot be cast becomes NULL, an undeclared column is left out, and a missing
    one fails at once. One projection, so the scan reads only the declared columns.
    """
    normalizers = normalizers or {}
    missing = [f.name for f in contract if f.name not in df.columns]
    if missing:
        raise ValueError(f"source lacks declared columns {missing}; it has {df.columns}")
    return df.select(
        *[_prepared(df, f.name, normalizers).try_cast(f.dataType).alias(f.name) for f in contract]
    )


def lost_values(
    df: DataFrame, contract: T.StructType, normalizers: Mapping[str, Normalizer] | None = None
) -> DataFrame:
    """Per declared column, how many non-null values the casts turn into NULL (one pass)."""
    normalizers = normalizers or {}
    counts = [
        F.count_if(
            F.col(f.name).isNotNull()
            & _prepared(df, f.name, normalizers).try_cast(f.dataType).isNull()
        ).alias(f.name)
        for f in contract
    ]
    rows = F.explode(
        F.array(
            *[
                F.struct(F.lit(f.name).alias("column_name"), F.col(f.name).alias("lost"))
                for f in contract
            ]
        )
    )
    return df.agg(*counts).select(rows.alias("r")).select("r.*")
