"""Ad-hoc read-only SQL with a cap on the rows handed back and on the time it takes."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Row, SparkSession

# The default row cap and time limit.
MAX_ROWS = 1000
MAX_SECONDS = 900.0
# A stopped statement is watched this long for jobs that it may still begin.
STOPPING_SECONDS = 60
CALLS_INTO_JVM = frozenset({"reflect", "try_reflect", "java_method"})

T = TypeVar("T")


class QueryInputError(ValueError):
    """The request has no usable SQL text or cap."""


class QueryFailed(RuntimeError):
    """Spark could not parse, analyse or run the SQL."""


class QueryTimeout(QueryFailed):
    """The query did not end in time; its jobs were stopped."""


@dataclass(frozen=True)
class QueryResult:
    data: list[dict] = field(default_factory=list)
    row_count: int = 0
    column_names: list[str] = field(default_factory=list)
    truncated: bool = False


def _check(sql: str | None, max_rows: int) -> str:
    if not sql or not sql.strip():
        raise QueryInputError("a SQL text is required")
    if max_rows < 1:
        raise QueryInputError("max_rows must be at least 1")
    return sql.strip().rstrip(";")


def _each(sequence) -> Iterator:
    found = sequence.iterator()
    while found.hasNext():
        yield found.next()


def _nodes(root) -> Iterator:
    """All plans and expressions of a statement, also inside subqueries and WITH, but not inside
    views, whose makers answer for them."""
    waiting = [root]
    while waiting:
        node = waiting.pop()
        yield node
        if node.getClass().getSimpleName() == "View":
            continue
        waiting += _each(node.children())
        kind = node.getClass().getName()
        if ".plans.logical." in kind or kind.endswith("UnresolvedRelation"):
            waiting += _each(node.expressions())
            waiting += _each(node.innerChildren())
        elif kind.endswith(("ScalarSubquery", "Exists", "ListQuery", "LateralSubquery", "SubqueryArgumentExpression")):
            waiting.append(node.plan())


def _refuse_unsafe(spark: SparkSession, text: str) -> None:
    """Look at the parsed statement, not its text: quoting and comments cannot hide a call."""
    try:
        parsed = spark._jsparkSession.sessionState().sqlParser().parsePlan(f"SELECT * FROM (\n{text}\n)")
    except Exception as error:
        raise QueryFailed(str(error)) from error
    for node in _nodes(parsed):
        kind = node.getClass().getSimpleName()
        if kind == "UnresolvedFunction":
            if list(_each(node.nameParts()))[-1].lower() in CALLS_INTO_JVM:
                raise QueryInputError("functions that call into the JVM are not allowed")
        elif kind == "UnresolvedRelation":
            names = list(_each(node.multipartIdentifier()))
            if len(names) == 2 and not spark.catalog.databaseExists(names[0]):
                raise QueryInputError(f"{'.'.join(names)} is not a table; files cannot be queried by path")
        elif "UnresolvedIdentifier" in kind:
            # a name that is computed while the statement is analysed
            raise QueryInputError("names must be written out, not computed with IDENTIFIER")


def _refuse_unsafe_plan(df: DataFrame) -> None:
    """Look at what the names turned out to be: tables and views only, and no call into the JVM."""
    for node in _nodes(df._jdf.queryExecution().analyzed()):
        kind = node.getClass().getSimpleName()
        if kind in ("CallMethodViaReflection", "TryReflect"):
            raise QueryInputError("functions that call into the JVM are not allowed")
        if kind == "LogicalRelation" and node.catalogTable().isEmpty():
            raise QueryInputError("files cannot be queried by path")
        if kind == "DataSourceV2Relation" and node.identifier().isEmpty():
            raise QueryInputError("files cannot be queried by path")


def _in_time(spark: SparkSession, work: Callable[[], T], seconds: float) -> T:
    """The work's result, or ``QueryTimeout`` once that much time is over and its jobs are stopped.

    The work runs in a thread of its own, whose jobs carry a tag; so the caller is answered in time
    even while Spark is still clearing up.
    """
    tag, outcome = f"bounded-{uuid.uuid4().hex}", []

    def run() -> None:
        spark.sparkContext.addJobTag(tag)
        try:
            outcome.append((True, work()))
        except Exception as error:
            outcome.append((False, error))

    worker = threading.Thread(target=inheritable_thread_target(spark)(run), daemon=True)
    worker.start()
    worker.join(seconds)
    if worker.is_alive():
        _stop(spark, tag, worker)
        raise QueryTimeout(f"the query took longer than {seconds} s")
    done, value = outcome[0]
    if not done:
        raise value
    return value


def _stop(spark: SparkSession, tag: str, worker: threading.Thread) -> None:
    """Stop the tagged jobs, and for a while also those that the statement may still begin."""
    spark.sparkContext.cancelJobsWithTag(tag)

    def follow() -> None:
        for _ in range(STOPPING_SECONDS):
            worker.join(1)
            if not worker.is_alive():
                return
            spark.sparkContext.cancelJobsWithTag(tag)

    threading.Thread(target=inheritable_thread_target(spark)(follow), daemon=True).start()


def capped(spark: SparkSession, sql: str | None, max_rows: int = MAX_ROWS) -> DataFrame:
    """The query as a DataFrame of at most ``max_rows`` rows.

    Standing as a subquery, the text can only be a query: any other statement fails to parse.
    That makes it read-only; it is not a sandbox.
    """
    text = _check(sql, max_rows)
    _refuse_unsafe(spark, text)
    try:
        df = spark.sql(f"SELECT * FROM (\n{text}\n)")
    except PySparkException as error:
        raise QueryFailed(str(error)) from error
    _refuse_unsafe_plan(df)
    return df.limit(max_rows)


def bounded_query(
    spark: SparkSession, sql: str | None, max_rows: int = MAX_ROWS, seconds: float = MAX_SECONDS
) -> QueryResult:
    """Rows as dicts plus what was returned. One extra row tells a full result from a cut one.

    A query that takes longer than ``seconds`` has its jobs stopped and raises ``QueryTimeout``.
    """
    _check(sql, max_rows)
    if seconds <= 0:
        raise QueryInputError("seconds must be more than 0")

    def run() -> tuple[list[str], list[Row]]:
        df = capped(spark, sql, max_rows + 1)
        return df.columns, df.collect()

    try:
        columns, rows = _in_time(spark, run, seconds)
    except PySparkException as error:
        raise QueryFailed(str(error)) from error
    data = [dict(zip(columns, row)) for row in rows[:max_rows]]
    return QueryResult(data, len(data), list(columns), len(rows) > max_rows)
