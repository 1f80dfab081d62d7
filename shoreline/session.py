"""Where intermediate tables go, and how large a plan's input is estimated to be."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


_made_up: dict[str, str] = {}


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder under the one the cluster names in ``spark.checkpoint.dir``.

    Every executor must be able to reach it, so a machine-local folder is only made up when the
    setting is missing on a local master.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        application = spark.sparkContext.applicationId
        if application not in _made_up:
            _made_up[application] = tempfile.mkdtemp(prefix="shoreline-")
        base = _made_up[application]
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex[:12]}"


def settings_for(shuffle_bytes: int, cores: int) -> dict[str, str]:
    """Session settings for a job whose largest shuffle moves that much on that many cores.

    Partitions hold 256 MB, which executors sort without spilling, and are never fewer than the
    cores. Beyond 20,000 of them they grow to 1 GB instead, since every mapper keeps a block for
    every partition. Adaptive execution merges those that turn out small and splits those that
    turn out hot, also where splitting costs another shuffle.
    """
    usual, large = -(-shuffle_bytes // (256 << 20)), -(-shuffle_bytes // (1 << 30))
    partitions = max(cores, min(usual, max(20_000, large)))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": "256m" if shuffle_bytes >= 1 << 40 else "128m",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.session.timeZone": "UTC",
    }


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A session setting that holds for some statements only."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the path as that system's object."""
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path


def input_bytes(df: DataFrame) -> int:
    """The bytes that a plan reads: the sizes of its leaves, whatever it then does with them.

    Leaves whose size Spark does not know, such as rows handed over by the driver, count as none.
    """
    unknown = df.sparkSession._jsparkSession.sessionState().conf().defaultSizeInBytes()
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves().iterator()
    total = 0
    while leaves.hasNext():
        size = int(leaves.next().stats().sizeInBytes())
        total += size if size < unknown else 0
    return total


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate. An upper-leaning guess: joins multiply their inputs."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def fits_broadcast(df: DataFrame) -> bool:
    """True when Catalyst itself would broadcast this side under the session's threshold."""
    jvm_conf = df.sparkSession._jsparkSession.sessionState().conf()
    limit = jvm_conf.autoBroadcastJoinThreshold()
    return 0 <= estimated_bytes(df) <= limit
