"""Unbounded reads: the change topic, or a landed folder that keeps receiving files."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, types as T

from shoreline.session import file_system

# A new consumer reads the topic from its start and outlives expired offsets.
KAFKA_DEFAULTS = {"startingOffsets": "earliest", "failOnDataLoss": "false"}
# Bounds a micro-batch of a landed folder.
FILES_PER_TRIGGER = 1000


def read_change_stream(
    spark: SparkSession, servers: str, topic: str, **options: str
) -> DataFrame:
    """The raw messages of a topic. Needs Spark's Kafka connector on the class path.

    Two consumers are two queries with their own checkpoints. Options such as ``minPartitions``
    and ``maxOffsetsPerTrigger`` set the parallelism and the size of a micro-batch.
    """
    settings = {**KAFKA_DEFAULTS, "kafka.bootstrap.servers": servers, "subscribe": topic}
    return spark.readStream.format("kafka").options(**{**settings, **options}).load()


def read_file_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    max_files_per_trigger: int = FILES_PER_TRIGGER,
) -> DataFrame:
    """New Parquet files under ``path`` as a stream, so many of them per micro-batch.

    The file source takes a folder or a glob of files but not the bare name of one, so a single
    file is given as a glob that matches nothing else; letters a glob would read are escaped.
    """
    path = path.rstrip("/")
    fs, place = file_system(spark, path)
    if fs.isFile(place):
        head, _, name = path.rpartition("/")
        path = f"{head}/{re.sub(r'([][{}*?\\,])', r'\\\1', name[:-1])}[{name[-1]}]"
    reader = spark.readStream.schema(schema)
    return reader.option("maxFilesPerTrigger", max_files_per_trigger).parquet(path)
