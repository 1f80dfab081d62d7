"""What the operators share: reading tables, Arrow batches of bounded size, written steps."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shoreline.session import shared_folder

ROWS_PER_BATCH = 512


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, purpose: str) -> DataFrame:
    """The rows, stored once in the shared folder: cuts lineage and survives lost executors."""
    path = shared_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def handed_back(work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``work``, after which a worker gives the memory it has freed back to the system.

    Workers live on from task to task and stage to stage. Allocators keep freed memory for the next
    request, so each worker would go on holding the most that any of its tasks took.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from work(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc's
            if trim:
                trim(0)

    return run


def in_batches(
    df: DataFrame, work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema
) -> DataFrame:
    """``mapInArrow`` with batches of few rows, since one text may be very long.

    The row limit of a batch is a session setting; it is lowered here if nobody has chosen one.
    """
    conf = df.sparkSession.conf
    if conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":
        conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS_PER_BATCH))
    return df.mapInArrow(handed_back(work), schema)


def fold(column: str, parts: int, seed: str = "") -> Column:
    """crc32 of the id as text, modulo ``parts``; NULL for a NULL id."""
    return F.crc32(F.concat(F.col(column).cast("string"), F.lit(seed))) % parts


def kept_share(column: Column) -> Column:
    """A number in [0, 1) that depends on the value alone; used to take bounded samples."""
    return F.pmod(F.xxhash64(column, F.lit("share")), F.lit(1 << 30)) / float(1 << 30)
