"""Column expressions that turn messy source text into numbers. All run inside codegen."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T


def _is_text(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, T.StringType)


def price(df: DataFrame, name: str, dtype: str = "decimal(10,2)") -> Column:
    """Money without currency sign and thousands separator.

    Numbers are cast directly: stripping a double's text form would turn ``1.0E7`` into 1.07.
    """
    if _is_text(df, name):
        return F.regexp_replace(name, "[^0-9.]", "").try_cast(dtype)
    return F.col(name).try_cast(dtype)


def decimal_comma(df: DataFrame, name: str, dtype: str) -> Column:
    """A number whose decimal separator may be a comma."""
    if _is_text(df, name):
        return F.regexp_replace(name, ",", ".").try_cast(dtype)
    return F.col(name).try_cast(dtype)


def plain_number(name: str) -> Column:
    """The value as double when its text is only digits and dots, else NULL."""
    return F.regexp_extract(F.col(name).cast("string"), "^[0-9.]+$", 0).try_cast("double")


# Normalizers for ``contracts.conform``: text in, text out, applied before the cast.


def strip_currency(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9.]", "")


def comma_to_point(value: Column) -> Column:
    return F.regexp_replace(value, ",", ".")


def drop_thousands(value: Column) -> Column:
    return F.regexp_replace(value, ",", "")
