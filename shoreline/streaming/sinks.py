"""Outputs of a change stream: an append-only log, or whatever a function makes of its batches."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from shoreline.session import setting

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def once(
    stream: DataFrame, identity: Sequence[str], arrived: str, within: str = "1 hour"
) -> DataFrame:
    """The stream without messages that were delivered again.

    ``identity`` names a message, such as its partition and offset. ``arrived`` is when it came to
    this side (not when it happened, which may be long ago): a message is known for ``within`` after
    the newest arrival, in Spark's state store, so a replay up to that much later is left out.
    """
    return stream.withWatermark(arrived, within).dropDuplicatesWithinWatermark(list(identity))


def append_log(
    stream: DataFrame,
    checkpoint: str,
    path: str | None = None,
    format: str = "parquet",
    trigger: dict | None = None,
    **options: str,
) -> StreamingQuery:
    """Start writing every change to a log and hand back the running query.

    Restarting with the same checkpoint continues after the last finished batch; a new checkpoint
    starts over. ``trigger`` takes Spark's trigger arguments, such as ``{"availableNow": True}``;
    without one, batches follow each other. The file sink writes each batch once; a sink without
    row keys may repeat a batch after a failure. A source that delivers a message again is cut back
    to one by ``once``.
    """
    writer = stream.writeStream.format(format).outputMode("append")
    writer = writer.option("checkpointLocation", checkpoint).options(**options)
    if trigger:
        writer = writer.trigger(**trigger)
    with setting(stream.sparkSession, STATE_STORE, ROCKSDB):
        return writer.start(path) if path else writer.start()


def each_batch(
    stream: DataFrame, work: Callable[[DataFrame], None], checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Start handing each batch's new and changed rows to ``work``.

    A batch may come again after a failure, so ``work`` must not mind. State is kept in RocksDB,
    beside the executors' heap, and saved with the checkpoint.
    """
    writer = stream.writeStream.outputMode("update").foreachBatch(lambda batch, _: work(batch))
    writer = writer.option("checkpointLocation", checkpoint)
    if trigger:
        writer = writer.trigger(**trigger)
    with setting(stream.sparkSession, STATE_STORE, ROCKSDB):
        return writer.start()
