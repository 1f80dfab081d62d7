"""Catalog tables: create, guard, replace, upsert.

A three-part name (``catalog.namespace.table``) belongs to a catalog whose format replaces and
merges rows itself, and is written with Spark's own commands for that. A two-part name is a view
over a Parquet table of the session catalog, which can do neither:

- Replacing writes a new table beside the old one and then points the view at it. Readers see the
  old rows or the new ones, and a write that dies half-way leaves the view alone. The table before
  the current one stays for readers that began on it; older ones are dropped.
- A table made by ``upsert`` is partitioned by a hash of its keys. A later upsert stages the new
  rows of the partitions that its keys fall in and then replaces these partitions by Spark's
  dynamic partition overwrite. An upsert that dies while replacing is finished by the next write.

One writer per table.
"""

from __future__ import annotations

import json
import re
import time
import uuid
from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from shoreline.session import file_system, input_bytes, setting

# What a view points at; the keys that a stored table is partitioned by, and into how many parts.
STORED, KEYS = "shoreline.stored", "shoreline.keys"
PART = "__part"
PART_BYTES = 256 << 20
CODEC = "zstd"  # of all that is stored here: a third less than Spark's default

Merge = Callable[[DataFrame, DataFrame], DataFrame]


class SchemaMismatchError(ValueError):
    """The data's columns differ from the existing table's."""


def has_row_level_writes(name: str) -> bool:
    return name.count(".") == 2


def _split(name: str) -> tuple[str, str]:
    namespace, _, table = name.rpartition(".")
    if not namespace:
        raise ValueError(f"table names are qualified: namespace.table, not {name!r}")
    return namespace, table


def ensure_namespace(spark: SparkSession, namespace: str, location: str | None = None) -> None:
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {namespace}{where}")


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def _property(spark: SparkSession, name: str, key: str) -> str | None:
    if not table_exists(spark, name):
        return None
    found = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    return found.get(key)


def stored_table(spark: SparkSession, name: str) -> str | None:
    """The Parquet table behind a name."""
    return _property(spark, name, STORED)


def is_internal(table: str) -> bool:
    """True for a Parquet table behind a name, as opposed to the name users read."""
    return re.search(r"__[0-9a-f]{16}_[0-9a-f]{8}$", table) is not None


def _stored_tables(spark: SparkSession, name: str) -> list[str]:
    namespace, table = _split(name)
    found = [r["tableName"] for r in spark.sql(f"SHOW TABLES IN {namespace} LIKE '{table}__*'").collect()]
    return [f"{namespace}.{t}" for t in found if is_internal(t) and t.rpartition("__")[0] == table.lower()]


def _location(spark: SparkSession, physical: str) -> str:
    namespace, table = _split(physical)
    return f"{spark.catalog.getDatabase(namespace).locationUri.rstrip('/')}/{table.lower()}"


def _staged(spark: SparkSession, physical: str) -> str:
    """Where an upsert into this table prepares its rows."""
    return f"{_location(spark, physical)}__staged"


def _drop_stored(spark: SparkSession, physical: str) -> None:
    fs, staged = file_system(spark, _staged(spark, physical))
    fs.delete(staged, True)
    spark.sql(f"DROP TABLE IF EXISTS {physical}")


def _point(spark: SparkSession, name: str, physical: str) -> str | None:
    """Make the name show that table; returns what it showed before."""
    before = stored_table(spark, name)
    listed = ", ".join(f"`{c}`" for c in spark.table(physical).columns if c != PART)
    spark.sql(
        f"CREATE OR REPLACE VIEW {name} TBLPROPERTIES ('{STORED}' = '{physical}') AS SELECT {listed} FROM {physical}"
    )
    return before


def publish(spark: SparkSession, written: Mapping[str, str]) -> None:
    """Make several names show the tables written for them, all or none.

    Only catalog entries change here. If one of them fails, those already changed are put back.
    """
    before: dict[str, str | None] = {}
    try:
        for name, physical in written.items():
            before[name] = _point(spark, name, physical)
    except Exception:
        for name, physical in before.items():
            if physical is None:
                spark.sql(f"DROP VIEW IF EXISTS {name}")
            else:
                _point(spark, name, physical)
        raise
    for name, physical in written.items():
        for old in _stored_tables(spark, name):
            if old not in (physical.lower(), (before[name] or "").lower()):
                _drop_stored(spark, old)


def discard(spark: SparkSession, written: Mapping[str, str]) -> None:
    """Drop tables that were written but are not to be published."""
    for physical in written.values():
        _drop_stored(spark, physical)


def write_stored(
    df: DataFrame,
    name: str,
    *,
    partition_by: Sequence[str] = (),
    cluster_by: Sequence[str] = (),
    buckets: int = 0,
    gather: bool = True,
) -> str:
    """Write rows to a new table for this name, which readers see once it is ``publish``-ed."""
    physical = f"{name}__{time.time_ns():016x}_{uuid.uuid4().hex[:8]}"
    if cluster_by:
        # One task per bucket, hence one sorted file per bucket.
        df = df.repartition(buckets, *cluster_by)
    elif partition_by and gather:
        # Few files per folder; adaptive execution splits a folder that outgrows the others.
        df = df.hint("rebalance", *partition_by)
    writer = df.write.format("parquet").option("compression", CODEC)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if cluster_by:
        writer = writer.bucketBy(buckets, *cluster_by).sortBy(*cluster_by)
    writer.saveAsTable(physical)
    return physical


def _replace(df: DataFrame, name: str, **layout) -> str:
    physical = write_stored(df, name, **layout)
    publish(df.sparkSession, {name: physical})
    return physical


def buckets_for(size: int, bucket_bytes: int = PART_BYTES) -> int:
    """How many buckets or partitions so many bytes are worth."""
    return max(1, -(-size // bucket_bytes))


def stored_bytes(spark: SparkSession, physical: str) -> int:
    """The bytes of a table's files."""
    fs, path = file_system(spark, _location(spark, physical))
    return fs.getContentSummary(path).getLength() if fs.exists(path) else 0


def _part_of(keys: Sequence[str], parts: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(parts)).cast("int")


def _write_parts(df: DataFrame, name: str, keys: Sequence[str], parts: int, gather: bool = True) -> str:
    """Write the whole table anew, partitioned by a hash of its keys; a single part need not be
    gathered."""
    spark = df.sparkSession
    part = F.lit(0) if parts == 1 else _part_of(keys, parts)
    physical = write_stored(df.withColumn(PART, part), name, partition_by=[PART], gather=gather)
    layout = json.dumps([*keys, parts])
    spark.sql(f"ALTER TABLE {physical} SET TBLPROPERTIES ('{KEYS}' = '{layout}')")
    publish(spark, {name: physical})
    return physical


def ensure_table(
    spark: SparkSession, name: str, schema: T.StructType, partition_by: Sequence[str] = ()
) -> None:
    """Create the table, empty, unless it exists."""
    if table_exists(spark, name):
        return
    if has_row_level_writes(name):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        parts = f" PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}){parts}")
        return
    _replace(spark.createDataFrame([], schema), name, partition_by=partition_by)


def assert_schema_matches(
    spark: SparkSession, name: str, df: DataFrame, check_types: bool = False
) -> None:
    """Fail before writing when the ordered column names (and types, if asked) differ."""
    stored = {f.name: (i, f.dataType) for i, f in enumerate(spark.table(name).schema)}
    given = {f.name: (i, f.dataType) for i, f in enumerate(df.schema)}
    faults = [f"column {c} is missing" for c in stored if c not in given]
    faults += [f"column {c} is not in the table" for c in given if c not in stored]
    if not faults:
        for column, (place, kind) in stored.items():
            at, other = given[column]
            if at != place:
                faults.append(f"column {column} is number {at + 1} instead of {place + 1}")
            if check_types and other != kind:
                faults.append(f"column {column} is {other.simpleString()} instead of {kind.simpleString()}")
    if faults:
        raise SchemaMismatchError(f"{name}: {'; '.join(faults)}")


def as_stored(spark: SparkSession, name: str, df: DataFrame) -> DataFrame:
    """The rows in the table's types. A value that its type cannot hold fails the write."""
    schema = spark.table(name).schema

    def cast(field: T.StructField) -> Column:
        value, given = F.col(f"`{field.name}`"), df.schema[field.name].dataType
        if given.simpleString() == field.dataType.simpleString():  # whether parts may be NULL aside
            return value
        held = value.try_cast(field.dataType)
        lost = value.isNotNull() & ~held.try_cast(given).eqNullSafe(value)
        text = F.concat(F.lit(f"{name}.{field.name} is {field.dataType.simpleString()} and cannot hold "), value.cast("string"))
        return F.when(lost, F.raise_error(text).cast(field.dataType)).otherwise(held).alias(field.name)

    return df.select(*[cast(f) for f in schema])


def overwrite_table(
    spark: SparkSession,
    df: DataFrame,
    name: str,
    *,
    partition_by: Sequence[str] = (),
    cluster_by: Sequence[str] = (),
    buckets: int = 0,
    published: bool = True,
) -> str:
    """Replace the whole table at once; returns the Parquet table now behind the name.

    ``cluster_by`` with ``buckets`` stores the rows hashed and sorted by those columns, so that
    later joins on them need no shuffle of this table. Unless ``published``, readers of the name
    go on seeing the old rows until the returned table is handed to ``publish``.
    """
    ensure_namespace(spark, _split(name)[0])
    if has_row_level_writes(name):
        if not published:
            raise ValueError(f"{name}: stage the rows under another name")
        ensure_table(spark, name, df.schema, partition_by)
        assert_schema_matches(spark, name, df)
        df.writeTo(name).overwrite(F.lit(True))
        return name
    if table_exists(spark, name):
        assert_schema_matches(spark, name, df)
        df = as_stored(spark, name, df)
    write = _replace if published else write_stored
    return write(df, name, partition_by=partition_by, cluster_by=cluster_by, buckets=buckets)


def drop_table(spark: SparkSession, name: str) -> None:
    """Remove a table, its name and all that is stored for it."""
    if has_row_level_writes(name):
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        return
    spark.sql(f"DROP VIEW IF EXISTS {name}")
    for physical in _stored_tables(spark, name):
        _drop_stored(spark, physical)


def bulk_load(spark: SparkSession, path: str, name: str) -> None:
    """Append a Parquet folder to an existing table, matching columns by position."""
    incoming = spark.read.parquet(path)
    assert_schema_matches(spark, name, incoming)
    if has_row_level_writes(name):
        incoming.writeTo(name).append()
        return
    finish(spark, name)
    physical = stored_table(spark, name)
    layout = _property(spark, physical, KEYS)
    if layout:
        *keys, parts = json.loads(layout)
        incoming = as_stored(spark, name, incoming).withColumn(PART, _part_of(keys, parts)).hint("rebalance", PART)
    incoming.write.insertInto(physical)


def _checked_source(df: DataFrame, keys: Sequence[str], unique: bool) -> DataFrame:
    """The source, failing inside the write when a key is NULL or occurs twice."""
    if not unique:
        rest = [c for c in df.columns if c not in keys]
        grouped = df.groupBy(*keys).agg(
            F.count(F.lit(1)).alias("_n"), F.max(F.struct(F.lit(0), *rest)).alias("_row")
        )
        first = keys[0]
        only = F.when(
            F.col("_n") > 1, F.raise_error(F.lit(f"upsert source repeats a key of {list(keys)}"))
        ).otherwise(F.col(first))
        df = grouped.withColumn(first, only.cast(df.schema[first].dataType)).select(
            *[F.col(c) if c in keys else F.col("_row").getField(c).alias(c) for c in df.columns]
        )
    checked = {
        k: F.when(
            F.col(k).isNull(), F.raise_error(F.lit(f"upsert source has a NULL key in {k}"))
        )
        .otherwise(F.col(k))
        .cast(df.schema[k].dataType)
        for k in keys
    }
    return df.withColumns(checked)


def merge_rows(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``target`` with every row whose key is in ``source`` updated, and the other source rows added.

    ``source`` holds a key once. Target rows that repeat a key are all updated; NULL target keys
    match nothing and stay. Whether a join is broadcast or shuffled is Catalyst's choice and does
    not change the result; either way its hot keys can be split.
    """
    keys = list(keys)
    new = source.select(*keys, F.struct(*source.columns).alias("new"))
    old = target.select(*keys, F.struct(*target.columns).alias("old"))
    updated = old.join(new, keys, "left").select(F.coalesce("new", "old").alias("row")).select("row.*")
    added = source.join(target.select(*keys), keys, "left_anti").select(*target.columns)
    return updated.unionByName(added)


def finish(spark: SparkSession, name: str) -> None:
    """Complete an upsert that died after its rows were staged, and clear what one left behind."""
    physical = stored_table(spark, name)
    if physical is None:
        return
    fs, staged = file_system(spark, _staged(spark, physical))
    if not fs.exists(staged):
        return
    _, ready = file_system(spark, f"{_staged(spark, physical)}/ready")
    if fs.exists(ready):
        stored = spark.table(physical)
        rows = spark.read.schema(stored.schema).parquet(f"{_staged(spark, physical)}/rows")
        # the partitions that the rows have, and no others
        with setting(spark, "spark.sql.sources.partitionOverwriteMode", "dynamic"):
            rows.select(*stored.columns).write.insertInto(physical, overwrite=True)
    fs.delete(staged, True)


def _stage(spark: SparkSession, rows: DataFrame, physical: str) -> DataFrame:
    """The rows, written first, so that their plan runs once however often they are then used."""
    path = f"{_staged(spark, physical)}/source"
    rows.write.mode("overwrite").option("compression", CODEC).parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def fold(
    spark: SparkSession,
    rows: DataFrame,
    name: str,
    keys: Sequence[str],
    merge: Merge,
    parts: int = 0,
    deal: bool = True,
) -> str:
    """Combine rows with the stored ones of equal keys by ``merge(stored, rows)``.

    ``merge`` gets all stored rows of the partitions that the keys fall in, and returns what these
    partitions are to hold. The others are neither read nor written. A table that has grown to
    twice its partitions' worth is dealt anew.

    Unless ``deal``, a new table is one partition, whose rows are written as they come. This saves a
    shuffle of all of them; the next call deals them, if they are worth more partitions.
    """
    ensure_namespace(spark, _split(name)[0])
    if not table_exists(spark, name):
        if not deal:
            return _write_parts(rows, name, keys, 1, gather=False)
        return _write_parts(rows, name, keys, parts or buckets_for(input_bytes(rows)))
    finish(spark, name)
    target, physical = spark.table(name), stored_table(spark, name)
    source = _stage(spark, as_stored(spark, name, rows), physical)
    layout = json.loads(_property(spark, physical, KEYS) or "[]")
    worth = buckets_for(stored_bytes(spark, physical))
    if layout[:-1] != list(keys) or worth > 2 * layout[-1]:
        return _write_parts(merge(target, source), name, keys, max(parts, worth))
    staged, part = _staged(spark, physical), _part_of(keys, layout[-1])
    touched = sorted(r[0] for r in source.select(part).distinct().collect())
    held = spark.table(physical).where(F.col(PART).isin(touched)).select(*target.columns)
    merged = merge(held, source).withColumn(PART, part)
    writer = merged.hint("rebalance", PART).write.mode("overwrite").option("compression", CODEC)
    writer.partitionBy(PART).parquet(f"{staged}/rows")
    fs, ready = file_system(spark, f"{staged}/ready")
    fs.create(ready, True).close()
    finish(spark, name)
    return physical


def upsert(
    spark: SparkSession,
    df: DataFrame,
    name: str,
    keys: Sequence[str],
    *,
    unique: bool = False,
    buckets: int = 0,
    parts: int = 0,
    deal: bool = True,
) -> str:
    """Update the rows whose key exists, insert the others; nothing is deleted.

    ``unique`` promises that the keys of ``df`` do not repeat (it was deduplicated on them) and
    saves the check. The table is partitioned into ``parts`` by a hash of the keys (as many as its
    first rows' bytes are worth, if not given), and only partitions that the source's keys fall in
    are read and written; see ``fold`` for ``deal``. ``buckets`` stores it instead clustered by its
    keys: later joins on them shuffle only their other side, but every upsert writes the table anew.
    """
    ensure_namespace(spark, _split(name)[0])
    source = _checked_source(df, keys, unique)
    if has_row_level_writes(name):
        ensure_table(spark, name, df.schema)
        assert_schema_matches(spark, name, df)
        on = reduce(
            Column.__and__, [F.col(f"source.{k}") == F.col(f"{name}.{k}") for k in keys]
        )
        merge = source.alias("source").mergeInto(name, on)
        merge.whenMatched().updateAll().whenNotMatched().insertAll().merge()
        return name
    if table_exists(spark, name):
        assert_schema_matches(spark, name, df)
        source = _checked_source(as_stored(spark, name, df), keys, unique)
    if not buckets:
        return fold(spark, source, name, keys, lambda old, new: merge_rows(old, new, keys), parts, deal)
    if table_exists(spark, name):
        source = merge_rows(spark.table(name), _stage(spark, source, stored_table(spark, name)), keys)
    return _replace(source, name, cluster_by=tuple(keys), buckets=buckets)
