"""Shards of near-equal bytes by Karmarkar-Karp differencing; rows of equal text stay together.

A row weighs its text's UTF-8 bytes plus ``ROW_BYTES``; a group is all rows of one text.

1. Groups are summed by a 64-bit hash of their text. Two texts with one hash would merely share a
   shard.
2. A group heavier than the ``ITEMS``-th part of all bytes is an item of its own; there are fewer
   than ``ITEMS`` of them whatever the input. All lighter groups are dealt by their hash to
   ``ITEMS`` bundles, each an item. So differencing gets at most ``2 * ITEMS`` numbers, and the
   rule is the same at every size: on small tables nearly every group is an item of its own.
3. Differencing: every item starts as a partition with one filled place. The two partitions with
   the largest spread (heaviest place less lightest) are combined, the heaviest place of one with
   the lightest of the other, until one partition is left. It says which shard each item goes to.
4. Rows learn their shard by two joins with tables of at most ``ITEMS`` rows, and their slot from
   counts per written file and shard, so that no task sees all rows of a shard.

NULL texts weigh ``ROW_BYTES`` and stay with empty texts. NULL ids and repeated rows are dealt like
all others. A text of any length is one group and goes to one shard, however heavy. An empty table
gives no rows. Other columns of the input are ignored.
"""

from __future__ import annotations

import heapq

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shoreline.llm.common import written

SHARDS = 24
ROW_BYTES = 8
# how finely the bytes are cut up for differencing
ITEMS = 24_000


def difference(sizes: list[int], shards: int = SHARDS) -> np.ndarray:
    """The shard of each size, by largest differencing; equal spreads are taken in given order.

    A partition is its places' sums in falling order. ``places[k]`` says, for the k-th combination,
    where the places of its two halves went, so that items are followed down from the last one.
    """
    n = len(sizes)
    if n == 0:
        return np.empty(0, np.int64)
    heap = [(-size, i, [size] + [0] * (shards - 1)) for i, size in enumerate(sizes)]
    heapq.heapify(heap)
    halves = np.zeros((n - 1, 2), np.int64)
    places = np.zeros((n - 1, 2, shards), np.int16)
    for k in range(n - 1):
        _, a, high = heapq.heappop(heap)
        _, b, low = heap[0]
        sums = [x + y for x, y in zip(high, reversed(low), strict=True)]
        order = sorted(range(shards), key=sums.__getitem__, reverse=True)
        halves[k] = a, b
        places[k, 0, order] = np.arange(shards)
        places[k, 1] = places[k, 0, ::-1]
        sums = [sums[i] for i in order]
        heapq.heapreplace(heap, (sums[-1] - sums[0], n + k, sums))
        # places[k, 0, i] is now where place i of the heavier half went
    shard = np.zeros(n, np.int64)
    # from the last combination down: where its places end up in the whole
    ends: dict[int, np.ndarray] = {2 * n - 2: np.arange(shards)}
    for k in range(n - 2, -1, -1):
        whole = ends.pop(n + k)
        for side in (0, 1):
            child, to = int(halves[k, side]), whole[places[k, side]]
            if child < n:
                shard[child] = to[0]
            else:
                ends[child] = to
    return shard


def weighed(docs: DataFrame) -> DataFrame:
    """``doc_id, size, text_crc32, text_hash`` of every row."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + F.lit(ROW_BYTES)).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("text_hash"),
    )


def assigned(spark: SparkSession, rows: DataFrame, shards: int = SHARDS, items: int = ITEMS) -> DataFrame:
    """The rows of ``weighed`` with their ``shard``."""
    bundle = F.pmod("text_hash", F.lit(items)).alias("bundle")
    groups = written(rows.groupBy("text_hash").agg(F.sum("size").alias("bytes")).select("*", bundle), "groups")
    total = groups.agg(F.coalesce(F.sum("bytes"), F.lit(0))).head()[0]
    heavy = F.col("bytes") * items > total
    # fewer than ``items`` heavy groups, and at most that many bundles
    alone = groups.where(heavy).select("text_hash", "bytes").orderBy("text_hash").collect()
    light = groups.where(~heavy).groupBy("bundle").agg(F.sum("bytes").alias("bytes")).orderBy("bundle").collect()
    shard = difference([r["bytes"] for r in [*alone, *light]], shards).tolist()
    first, rest = shard[: len(alone)], shard[len(alone) :]
    own = spark.createDataFrame(
        [(r["text_hash"], s) for r, s in zip(alone, first, strict=True)], "text_hash long, own int"
    )
    shared = spark.createDataFrame(
        [(r["bundle"], s) for r, s in zip(light, rest, strict=True)], "bundle long, shared int"
    )
    placed = rows.withColumn("bundle", F.pmod("text_hash", F.lit(items)))
    placed = placed.join(F.broadcast(own), "text_hash", "left").join(F.broadcast(shared), "bundle", "left")
    return placed.select(*rows.columns, F.coalesce("own", "shared").alias("shard"))


def numbered(rows: DataFrame) -> DataFrame:
    """Rows that were written with a ``shard``, and their ``slot``: gapless from 0 in each shard.

    A row's number is the rows of its shard in earlier files plus those before it in its own file,
    which a lost executor's rerun finds unchanged.
    """
    columns = rows.columns
    placed = rows.select(
        *columns, F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row_index")
    )
    counts = placed.groupBy("shard", "file").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("shard").orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("shard", "file", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    inside = Window.partitionBy("shard", "file").orderBy("row_index")
    return (
        placed.withColumn("inside", F.row_number().over(inside) - 1)
        .join(counts, ["shard", "file"])
        .select(*columns, (F.col("before") + F.col("inside")).cast("long").alias("slot"))
    )


def deal(spark: SparkSession, docs: DataFrame, shards: int = SHARDS, items: int = ITEMS) -> DataFrame:
    """``doc_id, size, text_crc32, text_hash, shard, slot`` of every row of ``doc_id, text``."""
    rows = written(weighed(docs), "weighed")
    return numbered(written(assigned(spark, rows, shards, items), "dealt"))
