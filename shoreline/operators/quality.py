"""Declared quality rules, evaluated in one aggregate per table, and a gate that stops bad data."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, functions as F

REPORT_COLUMNS = ("table_name", "rule", "column_name", "observed", "passed")


class QualityGateError(ValueError):
    """Some rule failed. ``failures`` holds the report rows of all failed rules."""

    def __init__(self, failures: Sequence[Row]):
        self.failures = list(failures)
        super().__init__(
            "; ".join(
                f"{r.table_name}.{r.column_name or '*'} breaks {r.rule} with {r.observed}" for r in self.failures
            )
        )


@dataclass(frozen=True)
class Rule:
    """What a rule measures over a DataFrame, and which measured values pass."""

    column: str | None = None

    def measure(self, df: DataFrame) -> Column:
        raise NotImplementedError

    def accepts(self, observed: Column) -> Column:
        return observed == 0


@dataclass(frozen=True)
class ColumnExists(Rule):
    def measure(self, df):
        return F.lit(float(self.column in df.columns))

    def accepts(self, observed):
        return observed == 1


@dataclass(frozen=True)
class NotNull(Rule):
    def measure(self, df):
        return F.count_if(F.col(self.column).isNull())


@dataclass(frozen=True)
class UniqueProportion(Rule):
    """Distinct values over non-null values. The exact count adds a shuffle on the column;
    ``approximate`` replaces it by a sketch for tables where that matters."""

    at_least: float = 0.99
    approximate: bool = False

    def measure(self, df):
        distinct = F.approx_count_distinct if self.approximate else F.count_distinct
        return F.coalesce(
            F.try_divide(distinct(F.col(self.column)), F.count(self.column)), F.lit(0.0)
        )

    def accepts(self, observed):
        return observed >= self.at_least


@dataclass(frozen=True)
class RowCount(Rule):
    at_least: int = 1

    def measure(self, df):
        return F.count(F.lit(1))

    def accepts(self, observed):
        return observed >= self.at_least


@dataclass(frozen=True)
class OfType(Rule):
    type_name: str = "StringType"

    def measure(self, df):
        return F.lit(float(type(df.schema[self.column].dataType).__name__ == self.type_name))

    def accepts(self, observed):
        return observed == 1


@dataclass(frozen=True)
class InRange(Rule):
    """Non-null values outside the bounds; NULLs are NotNull's business."""

    low: float = 0
    high: float = 0

    def measure(self, df):
        return F.count_if(~F.col(self.column).between(self.low, self.high))


def evaluate(df: DataFrame, rules: Sequence[Rule], table: str) -> DataFrame:
    """One report row per rule: ``table_name, rule, column_name, observed, passed``.

    All rules of the table are measured by a single aggregate; its one row is then spread into
    the report. A rule on a column that does not exist fails with ``observed`` NULL.
    """
    measures, rows = [], []
    for i, rule in enumerate(rules):
        known = rule.column is None or rule.column in df.columns or isinstance(rule, ColumnExists)
        value = rule.measure(df) if known else F.lit(None)
        measures.append(value.cast("double").alias(f"m{i}"))
        observed = F.col(f"m{i}")
        rows.append(
            F.struct(
                F.lit(table).alias("table_name"),
                F.lit(type(rule).__name__).alias("rule"),
                F.lit(rule.column).cast("string").alias("column_name"),
                observed.alias("observed"),
                F.coalesce(rule.accepts(observed), F.lit(False)).alias("passed"),
            )
        )
    measured = df.agg(F.count(F.lit(1)).alias("_rows"), *measures)
    return measured.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def report(
    tables: Mapping[str, DataFrame], rulesets: Mapping[str, Sequence[Rule]]
) -> DataFrame:
    return reduce(
        DataFrame.unionByName,
        [evaluate(df, rulesets[name], name) for name, df in tables.items()],
    )


def gate(
    tables: Mapping[str, DataFrame], rulesets: Mapping[str, Sequence[Rule]]
) -> list[tuple]:
    """Evaluate every table, then raise if anything failed; return the report rows otherwise.

    What reaches the driver is one row per declared rule.
    """
    rows = report(tables, rulesets).select(*REPORT_COLUMNS).collect()
    failures = [r for r in rows if not r.passed]
    if failures:
        raise QualityGateError(failures)
    return [tuple(r) for r in rows]


def _columns(rule: type[Rule], *names: str) -> list[Rule]:
    return [rule(name) for name in names]


# The rules that guard the star schema.
DIMENSION_RULES: dict[str, list[Rule]] = {
    "dim_user": [
        *_columns(ColumnExists, "user_id", "user_name"),
        *_columns(NotNull, "user_id", "user_name"),
        UniqueProportion("user_id"),
        RowCount(),
        *_columns(OfType, "user_id", "user_name"),
    ],
    "dim_product": [
        *_columns(ColumnExists, "product_id", "product_name", "category", "about_product", "img_link", "product_link"),
        *_columns(NotNull, "product_id", "product_name", "category", "img_link", "product_link"),
        UniqueProportion("product_id"),
        RowCount(),
        *_columns(OfType, "product_id", "product_name", "category", "about_product", "img_link", "product_link"),
    ],
    "dim_rating": [
        *_columns(ColumnExists, "user_id", "product_id", "rating", "rating_count"),
        *_columns(NotNull, "user_id", "product_id"),
        *_columns(OfType, "user_id", "product_id"),
        RowCount(),
    ],
}
FACT_RULES: dict[str, list[Rule]] = {
    "fact_product_rating": [
        *_columns(ColumnExists, "product_id", "product_name", "avg_rating"),
        *_columns(NotNull, "product_id", "product_name", "avg_rating"),
        *_columns(OfType, "product_id", "product_name"),
        RowCount(),
        InRange("avg_rating", low=0, high=5),
    ],
    "fact_sales_category": [
        *_columns(ColumnExists, "user_id", "category", "sales_amount"),
        *_columns(NotNull, "user_id", "category", "sales_amount"),
        *_columns(OfType, "user_id", "category"),
        RowCount(),
    ],
}
