"""Grouped counts and sums that are kept up to date from changes instead of recomputed."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from shoreline.session import file_system
from shoreline.sources import tables
from shoreline.streaming import sinks

HISTORY = (
    T.StructType()
    .add("mv_name", "string")
    .add("status", "string")
    .add("refresh_type", "string")
    .add("starttime", "timestamp")
    .add("endtime", "timestamp")
)
# A group's identity, which unlike its keys is never NULL, and its partial states by load.
GROUP, LOADS = "__group", "__loads"
STREAM = "stream "


def _sum_type(dtype: T.DataType) -> T.DataType:
    if isinstance(dtype, T.DecimalType):
        return T.DecimalType(38, dtype.scale)
    if isinstance(dtype, T.IntegralType):
        return T.LongType()
    raise ValueError(f"sums must be exact to be kept incrementally, not {dtype.simpleString()}")


class AggregateView:
    """``SELECT keys, count(*), sum(...) GROUP BY keys`` over a table that only sends changes.

    ``keys`` maps output names to expressions, ``sums`` output names to summed columns. With
    ``sign`` naming a +1/-1 column, removed and replaced rows are handled too: a group whose count
    falls to zero disappears, as it would from a recomputation.

    The table holds one row per group with a map from load to the counts and sums that this load
    brought. A load that is taken in again replaces what it brought before, so replays and any order
    of loads come to the same, and reading adds up within rows, without a shuffle. A stream is one
    load, whose totals Spark's state store keeps: each batch replaces those of the groups it touched.
    """

    def __init__(
        self,
        spark: SparkSession,
        name: str,
        source_schema: T.StructType,
        keys: Mapping[str, Column],
        sums: Mapping[str, str],
        count: str = "pedidos",
        sign: str | None = None,
        parts: int = 0,
    ):
        if tables.has_row_level_writes(name):
            raise ValueError(f"{name}: a format with row-level writes merges batches itself")
        self.spark, self.name, self.parts = spark, name, parts
        self.keys, self.sums, self.count, self.sign = dict(keys), dict(sums), count, sign
        self._types = {out: _sum_type(source_schema[c].dataType) for out, c in sums.items()}
        self._partials = self.delta(spark.createDataFrame([], source_schema)).schema

    def _filled(self, out: str) -> str:
        return f"{out}__values"

    def delta(self, rows: DataFrame) -> DataFrame:
        """The partial counts and sums of some source rows.

        Beside each sum goes the number of values in it, to tell a sum of none (NULL) from zero.
        """
        sign = None if self.sign is None else F.col(self.sign).cast("int")
        count = F.count(F.lit(1)) if sign is None else F.sum(sign)
        partials = [count.cast("bigint").alias(self.count)]
        for out, column in self.sums.items():
            dtype, value = self._types[out], F.col(column)
            if sign is None:
                total, filled = F.sum(value), F.count(value)
            else:
                total = F.sum((value.cast(dtype) * sign).cast(dtype))
                filled = F.sum(F.when(value.isNotNull(), sign).otherwise(F.lit(0)))
            partials += [
                total.cast(dtype).alias(out),
                filled.cast("bigint").alias(self._filled(out)),
            ]
        return rows.groupBy(*[e.alias(k) for k, e in self.keys.items()]).agg(*partials)

    def merged(self, partials: DataFrame) -> DataFrame:
        """Partial counts and sums, several to a group, added up to one per group."""
        totals = [F.sum(self.count).alias(self.count)]
        for out in self.sums:
            filled = self._filled(out)
            totals += [
                F.sum(out).cast(self._types[out]).alias(out),
                F.sum(filled).alias(filled),
            ]
        return partials.groupBy(*self.keys).agg(*totals)

    @property
    def _measures(self) -> list[str]:
        return [self.count, *[c for out in self.sums for c in (out, self._filled(out))]]

    def add(self, partials: DataFrame, load: str) -> None:
        """Take in what a load brings, one row per group as ``delta`` and ``merged`` make them."""
        identity = F.to_json(F.struct(*self.keys), {"ignoreNullFields": "false", "timeZone": "UTC"})
        states = F.struct(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in self._partials if f.name in self._measures])
        rows = partials.select(
            F.sha2(identity, 256).alias(GROUP), *self.keys, F.create_map(F.lit(load), states).alias(LOADS)
        )

        def merge(old: DataFrame, new: DataFrame) -> DataFrame:
            new = new.select(GROUP, F.struct(*new.columns).alias("new"))
            old = old.select(GROUP, F.struct(*old.columns).alias("old"))
            both = old.join(new, GROUP, "full_outer")
            others = F.map_filter(f"old.{LOADS}", lambda name, _: name != load)
            loads = F.when(F.col("old").isNull(), F.col(f"new.{LOADS}"))
            loads = loads.when(F.col("new").isNull(), F.col(f"old.{LOADS}"))
            loads = loads.otherwise(F.map_concat(others, f"new.{LOADS}"))
            keys = [F.coalesce(f"new.{k}", f"old.{k}").alias(k) for k in self.keys]
            return both.select(GROUP, *keys, loads.alias(LOADS))

        tables.fold(self.spark, rows, self.name, [GROUP], merge, self.parts)

    def apply_delta(self, rows: DataFrame, load: str | int) -> None:
        """Take in some source rows under a name; under the same name again, they replace those."""
        self.add(self.delta(rows), str(load))

    def read(self) -> DataFrame:
        """The view's rows; reads stored group states only, never the source."""
        if not tables.table_exists(self.spark, self.name):
            empty = self.spark.createDataFrame([], self._partials)
            return empty.select(*self.keys, self.count, *self.sums)
        states = F.map_values(LOADS)

        def total(name: str, dtype: T.DataType) -> Column:
            values = F.transform(states, lambda s: F.coalesce(s[name], F.lit(0)).cast(dtype))
            return F.aggregate(values, F.lit(0).cast(dtype), lambda a, b: (a + b).cast(dtype))

        sums = [
            F.when(total(self._filled(out), T.LongType()) > 0, total(out, self._types[out])).alias(out)
            for out in self.sums
        ]
        rows = tables.read_table(self.spark, self.name)
        return rows.select(*self.keys, total(self.count, T.LongType()).alias(self.count), *sums).filter(
            F.col(self.count) > 0
        )

    def reset(self) -> None:
        """Forget all rows, so that a new checkpoint can process the source from its start."""
        tables.drop_table(self.spark, self.name)

    # Refreshing from a stream -------------------------------------------------------------

    @property
    def _history_path(self) -> str:
        namespace = self.name.rpartition(".")[0]
        root = self.spark.catalog.getDatabase(namespace).locationUri.rstrip("/")
        return f"{root}/mv_refresh_history"

    def _log(self, status: str, refresh_type: str, start: datetime) -> None:
        tables.ensure_namespace(self.spark, self.name.rpartition(".")[0])
        row = (self.name, status, refresh_type, start, datetime.now(timezone.utc))
        entry = self.spark.createDataFrame([row], HISTORY)
        entry.coalesce(1).write.mode("append").parquet(self._history_path)

    def _check_checkpoint(self, load: str) -> None:
        """Refuse a second stream: one that starts over would count its rows a second time."""
        if not tables.table_exists(self.spark, self.name):
            return
        streams = tables.read_table(self.spark, self.name).select(F.explode(F.map_keys(LOADS)).alias("load"))
        other = streams.filter(F.col("load").startswith(STREAM) & (F.col("load") != load)).first()
        if other:
            raise ValueError(
                f"{self.name} holds rows of another checkpoint, {other[0].removeprefix(STREAM)}; go on "
                "with that one, or reset() the view to process the source from its start"
            )

    def _start(
        self, source: DataFrame, checkpoint: str, trigger: dict | None, auto: bool
    ) -> StreamingQuery:
        load = STREAM + checkpoint
        self._check_checkpoint(load)

        def on_batch(groups: DataFrame) -> None:
            start = datetime.now(timezone.utc)
            self.add(groups, load)
            if auto:
                self._log("Success", "Auto", start)

        return sinks.each_batch(self.delta(source), on_batch, checkpoint, trigger)

    def auto_refresh(
        self, source: DataFrame, checkpoint: str, trigger: dict | None = None
    ) -> StreamingQuery:
        """Keep the view fresh from a stream of source rows until the query is stopped."""
        return self._start(source, checkpoint, trigger, True)

    def refresh(self, source: DataFrame, checkpoint: str) -> None:
        """Take in what the stream holds beyond the checkpoint, then stop."""
        start = datetime.now(timezone.utc)
        try:
            self._start(source, checkpoint, {"availableNow": True}, False).awaitTermination()
        except Exception:
            self._log("Failed", "Manual", start)
            raise
        self._log("Success", "Manual", start)

    def refresh_history(self, newest: int = 20) -> DataFrame:
        """This view's latest refreshes, newest first."""
        fs, path = file_system(self.spark, self._history_path)
        if not fs.exists(path):
            return self.spark.createDataFrame([], HISTORY)
        log = self.spark.read.schema(HISTORY).parquet(self._history_path)
        own = log.filter(F.col("mv_name") == self.name)
        return own.orderBy(F.desc("starttime"), F.desc("endtime")).limit(newest)
