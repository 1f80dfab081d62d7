"""Current state of a source, kept from its changes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from shoreline.operators.cdc import latest_by_version
from shoreline.sources import tables
from shoreline.streaming import sinks


class Mirror:
    """Newest row per key, whatever order the changes arrive in (``cdc.version_order``).

    The table is partitioned by a hash of the keys; a batch of changes reads and replaces the
    partitions that its keys fall in. Of a stored and a new row the newer one stays, so a batch that
    is applied again, or a source that is read again from its start, changes nothing.

    Deleted keys stay stored with their version and are only hidden on read; otherwise an older
    update arriving late would bring the row back. ``deletes="ignore"`` drops delete events
    instead, so a deleted row stays visible. Rows with a NULL key are not kept.
    """

    def __init__(
        self,
        spark: SparkSession,
        name: str,
        schema: T.StructType,
        keys: Sequence[str],
        version: Sequence[str] = ("ts_ms",),
        op_col: str = "op",
        deletes: str = "apply",
        parts: int = 0,
    ):
        if deletes not in ("apply", "ignore"):
            raise ValueError("deletes is 'apply' or 'ignore'")
        if tables.has_row_level_writes(name):
            raise ValueError(f"{name}: a format with row-level writes merges batches itself")
        self.spark, self.name, self.schema = spark, name, schema
        self.keys, self.version, self.parts = list(keys), list(version), parts
        self.op_col, self.deletes = op_col, deletes

    def newest(self, changes: DataFrame) -> DataFrame:
        """The newest of these changes per key. On a stream, in update mode, Spark's state store
        holds it across batches, and every batch puts out the keys it touched."""
        keyed = changes.dropna(subset=self.keys)
        if self.deletes == "ignore":
            keyed = keyed.filter(~F.col(self.op_col).eqNullSafe("d"))
        return latest_by_version(keyed, self.keys, self.version, self.op_col)

    def _fold(self, newest: DataFrame) -> None:
        def merge(old: DataFrame, new: DataFrame) -> DataFrame:
            return latest_by_version(old.unionByName(new), self.keys, self.version, self.op_col)

        rows = newest.select(*self.schema.names)
        tables.fold(self.spark, rows, self.name, self.keys, merge, self.parts)

    def load(self, snapshot: DataFrame) -> None:
        """Start from a full copy of the source, as change rows."""
        if tables.table_exists(self.spark, self.name):
            raise ValueError(f"{self.name} already holds rows")
        self.apply(snapshot)

    def apply(self, changes: DataFrame) -> None:
        """Take in some flat change rows."""
        self._fold(self.newest(changes))

    def stored(self) -> DataFrame:
        """All keys with their newest change, deletes included."""
        if not tables.table_exists(self.spark, self.name):
            return self.spark.createDataFrame([], self.schema)
        return tables.read_table(self.spark, self.name)

    def read(self) -> DataFrame:
        return self.stored().filter(~F.col(self.op_col).eqNullSafe("d"))

    def stream(self, changes: DataFrame, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
        """Start keeping the mirror from a stream of flat change rows."""
        return sinks.each_batch(self.newest(changes), self._fold, checkpoint, trigger)


def freshness(source: DataFrame, destination: DataFrame, ts_col: str) -> DataFrame:
    """Row counts of both sides and how far the destination's newest time lags, as one row."""
    sides = source.select(F.lit(True).alias("is_source"), F.col(ts_col).alias("ts")).unionByName(
        destination.select(F.lit(False).alias("is_source"), F.col(ts_col).alias("ts"))
    )
    newest = {
        side: F.max(F.when(F.col("is_source") == side, F.col("ts").cast("timestamp")))
        for side in (True, False)
    }
    return sides.agg(
        F.count_if("is_source").alias("source_rows"),
        F.count_if(~F.col("is_source")).alias("destination_rows"),
        F.timestamp_diff("MICROSECOND", newest[False], newest[True]).alias("lag_micros"),
    )
