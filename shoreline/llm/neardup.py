"""Near-duplicate documents: DartMinHash signatures, banded buckets, exact verification.

A document is the weighted set of its five-word shingles (lower-cased words of letters, digits and
underscores; the weight is how often the shingle occurs). Documents of one to four words have one
shingle, all their words. Two documents are near copies if the weighted Jaccard similarity of
their sets (sum of smaller weights over sum of larger ones) is 0.8 or more.

Signatures: every unit of weight of every element is a region in which hashed darts arrive as a
Poisson process in rank; enough rank is taken for about ``k (ln k + 2)`` darts in all. Each dart
aims at one of ``k`` coordinates, and each coordinate keeps the dart of lowest rank. Darts depend
on element and unit only, so similar documents throw mostly the same ones. A document whose darts
leave a coordinate empty throws again with twice the rank.

Documents with the same words are one node to begin with. Nodes that agree in all ``ROWS``
coordinates of one of ``BANDS`` bands share a bucket (a pair at 0.8 does with probability 0.9987,
one at 0.9 practically always), pairs of a bucket are verified on their whole texts, and linked
nodes form classes.

Texts that are NULL or have no word resemble nothing. Rows that share an id are one document, which
is linked to whatever any of its texts is linked to. Rows without an id take no part: they have no
row in ``near_duplicates`` and all stay in ``deduplicated``. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shoreline.llm import linking, text
from shoreline.llm.common import in_batches, written

SHINGLE = 5
SIMILARITY = 0.8
CHARACTERS = 1 << 17  # shingled together by a task
BANDS, ROWS = 28, 7
K = BANDS * ROWS
DARTS = K * (np.log(K) + 2)
AT_ONCE = 64
MOST_BROADCAST = 1_000_000
SIGNATURES = "doc_id long, high long, low long, bands array<long>"


def shingles(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all shingles with the number of their text, and two hashes of each text's words
    (0 without words)."""
    laid = text.Laid([t.lower() for t in texts])
    starts, ends = laid.words()
    hashes, owner = laid.hashes(starts, ends), laid.owner(starts)
    n = len(texts)
    words = np.bincount(owner, minlength=n)
    first = np.cumsum(words) - words
    place = np.arange(len(hashes)) - first[owner]
    whole = []
    for base in (0xD6E8FEB86659FD93, 0xA0761D6478BD642F):
        sums = np.zeros(len(hashes) + 1, np.uint64)
        np.cumsum(text.mix(hashes ^ np.uint64(base)) * text.powers(int(words.max(initial=0)) + 1, base)[place], out=sums[1:])
        whole.append(np.where(words > 0, text.mix(sums[first + words] - sums[first] + words.astype(np.uint64)), 0))
    found, begin = text.windows(hashes, owner, SHINGLE)
    short = np.flatnonzero((words > 0) & (words < SHINGLE))
    found = np.concatenate([found, whole[0][short]])
    owners = np.concatenate([owner[begin], short])
    return found, owners, whole[0], whole[1]


def units(found: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One hash for every unit of weight: the u-th occurrence of an element in its text."""
    order = np.lexsort((found, owner))
    found, owner = found[order], owner[order]
    new = np.ones(len(found), bool)
    new[1:] = (found[1:] != found[:-1]) | (owner[1:] != owner[:-1])
    at = np.flatnonzero(new)
    occurrence = np.arange(len(found)) - np.repeat(at, np.diff(np.append(at, len(found))))
    return text.mix(found + occurrence.astype(np.uint64) * np.uint64(0xE7037ED1A0B428DB)), owner


def _throw(unit: np.ndarray, owner: np.ndarray, rank: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Lowest-ranked dart of every coordinate of ``n`` texts; 0 where there is none."""
    best = np.full(n * K, np.inf)
    dart = np.zeros(n * K, np.uint64)
    at_once = AT_ONCE if len(rank) and rank.max(initial=0) > 4 else 1
    now, arrived = np.zeros(len(unit)), 0
    slots, ranks, darts = [], [], []
    while len(unit):
        number = np.arange(arrived + 1, arrived + at_once + 1, dtype=np.uint64) * np.uint64(0x8EBC6AF09C88C6E3)
        thrown = text.mix(unit[:, None] + number)
        gaps = -np.log(((thrown >> np.uint64(11)).astype(np.float64) + 0.5) / (1 << 53))
        arrival = now[:, None] + np.cumsum(gaps, axis=1)
        inside = arrival < rank[owner][:, None]
        thrown = text.mix(thrown[inside])
        slots.append(np.broadcast_to(owner[:, None], inside.shape)[inside] * K + (thrown % np.uint64(K)).astype(np.int64))
        ranks.append(arrival[inside])
        darts.append(thrown)
        on = inside[:, -1]
        unit, owner, now = unit[on], owner[on], arrival[on, -1]
        arrived += at_once
    if slots:
        slot, arrival, thrown = np.concatenate(slots), np.concatenate(ranks), np.concatenate(darts)
        np.minimum.at(best, slot, arrival)
        won = arrival == best[slot]
        dart[slot[won]] = thrown[won]
    return dart.reshape(n, K), np.isfinite(best).reshape(n, K)


def signatures(found: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """``n`` rows of ``K`` darts; texts without shingles get zeros."""
    unit, owner = units(found, owner)
    weight = np.bincount(owner, minlength=n)
    rank = DARTS / np.maximum(weight, 1)
    out = np.zeros((n, K), np.uint64)
    for some in (rank <= 4, rank > 4):  # long texts throw a dart at a time, short ones many
        todo = some & (weight > 0)
        wide = 1.0
        while todo.any():
            texts = np.flatnonzero(todo)
            number = np.full(n, -1)
            number[texts] = np.arange(len(texts))
            mine = todo[owner]
            darts, hit = _throw(unit[mine], number[owner[mine]], rank[texts] * wide, len(texts))
            full = hit.all(1)
            out[texts[full]] = darts[full]
            todo[texts[full]] = False
            wide *= 2
    return out


def bands(signature: np.ndarray) -> np.ndarray:
    """One bucket number for each band of each signature."""
    parts = signature.reshape(len(signature), BANDS, ROWS)
    out = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), parts.shape[:2])
    for row in range(ROWS):
        out = text.mix(out + parts[:, :, row])
    return out


def signed(docs: DataFrame) -> DataFrame:
    """``doc_id, high, low, bands`` of every row with an id; NULL hashes if it has no word."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for start, stop in text.chunks(texts, CHARACTERS):
                n = stop - start
                found, owner, high, low = shingles(texts[start:stop])
                buckets = bands(signatures(found, owner, n)).view(np.int64)
                wordless = np.bincount(owner, minlength=n) == 0
                cuts = pa.array(np.arange(0, n * BANDS + 1, BANDS), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(start, n),
                        pa.array(high.view(np.int64), mask=wordless),
                        pa.array(low.view(np.int64), mask=wordless),
                        pa.ListArray.from_arrays(cuts, pa.array(buckets.ravel())),
                    ],
                    names=["doc_id", "high", "low", "bands"],
                )

    return in_batches(docs.where("doc_id IS NOT NULL"), work, SIGNATURES)


def similarities(pairs: list[tuple[str, str]]) -> np.ndarray:
    """Weighted Jaccard similarity of the texts of each pair; 0 if neither has a word."""
    found, owner, _, _ = shingles([t for pair in pairs for t in pair])
    pair, second = owner // 2, owner % 2 == 1
    keys, which = np.unique(found ^ text.mix(pair.astype(np.uint64)), return_inverse=True)
    a = np.bincount(which[~second], minlength=len(keys))
    b = np.bincount(which[second], minlength=len(keys))
    pair_of = np.zeros(len(keys), np.int64)
    pair_of[which] = pair
    shared = np.bincount(pair_of, weights=np.minimum(a, b), minlength=len(pairs))
    return shared / np.maximum(np.bincount(pair_of, weights=np.maximum(a, b), minlength=len(pairs)), 1)


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The ``a, b`` whose texts are similar enough. ``texts`` holds ``doc_id, text``."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = list(zip(batch.column("text_a").to_pylist(), batch.column("text_b").to_pylist(), strict=True))
            for start, stop in text.chunks([a + b for a, b in both], CHARACTERS):
                alike = pa.array(similarities(both[start:stop]) >= SIMILARITY)
                yield batch.slice(start, stop - start).select(["a", "b"]).filter(alike)

    for side in ("a", "b"):
        pairs = pairs.join(texts.select(F.col("doc_id").alias(side), F.col("text").alias(f"text_{side}")), side)
    return in_batches(pairs.select("a", "b", "text_a", "text_b"), work, "a long, b long").distinct()


def rarities(nodes: DataFrame, texts: DataFrame) -> DataFrame:
    """``node, fact``: the weight of a node's shingles, and of those that other nodes have, too.

    Nodes with several texts have no fact, so nothing is concluded about them.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sources = batch.column("text").to_pylist()
            for start, stop in text.chunks(sources, CHARACTERS):
                found, owner, _, _ = shingles(sources[start:stop])
                order = np.lexsort((found, owner))
                found, owner = found[order], owner[order]
                new = np.ones(len(found), bool)
                new[1:] = (found[1:] != found[:-1]) | (owner[1:] != owner[:-1])
                first = np.flatnonzero(new)
                weight = np.diff(np.append(first, len(found)))
                rows = pa.array(owner[first] + start)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("node").take(rows), pa.array(found[first].view(np.int64)), pa.array(weight)],
                    names=["node", "shingle", "weight"],
                )

    mine = texts.join(nodes.select(F.col("node").alias("doc_id")), "doc_id").select(F.col("doc_id").alias("node"), "text")
    mine = written(mine, "mine")
    several = mine.groupBy("node").count().where("count > 1").select("node")
    held = written(in_batches(mine.join(several, "node", "left_anti"), work, "node long, shingle long, weight long"), "shingles")
    total = held.groupBy("node").agg(F.sum("weight").alias("total"))
    alone = held.groupBy("shingle").agg(F.count("*").alias("n"), F.max("node").alias("node"), F.max("weight").alias("weight"))
    own = alone.where("n = 1").groupBy("node").agg(F.sum("weight").alias("own"))
    shared = F.col("total") - F.coalesce("own", F.lit(0))
    return total.join(own, "node", "left").select("node", F.struct("total", shared.alias("shared")).alias("fact"))


def possible(a: Column, b: Column) -> Column:
    """Whether two nodes can be similar enough, given how much of each any other node has: they
    share at most the smaller of these weights, and together they have all the rest."""
    most = F.least(a["shared"], b["shared"])
    return most >= (a["total"] + b["total"] - most) * SIMILARITY - 1e-6


def linkable(a: Column) -> Column:
    """Whether a node can be similar enough to any other: a partner that has nothing of its own still
    shares no more than ``shared``, out of at least the node's whole weight."""
    return a["shared"] >= a["total"] * SIMILARITY - 1e-6


def near_duplicates(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """``doc_id, class_id, kept`` for every document: the class is named by its least id, and the
    document of that id stands for it."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = written(signed(docs), "signatures")
    words = rows.where("high IS NOT NULL")
    nodes = words.groupBy("high", "low").agg(F.min("doc_id").alias("node"), F.first("bands").alias("bands"))
    nodes = written(nodes, "nodes")
    members = nodes.select("node", F.explode("bands").alias("bucket")).distinct()

    shared = members.groupBy("bucket").agg(F.min("node").alias("least"), F.max("node").alias("most"))
    shared = written(shared.where("least < most").select("bucket"), "shared")
    members = written(members.join(shared, "bucket"), "members")
    wanted = written(members.select(F.col("node").alias("doc_id")).distinct(), "candidates")
    # candidates are few where little is copied; their ids are broadcast only up to a fixed size
    few = F.broadcast(wanted) if wanted.count() <= MOST_BROADCAST else wanted
    texts = written(docs.where("text IS NOT NULL").join(few, "doc_id", "left_semi"), "texts")
    roots = linking.classes(
        members, lambda pairs: verified(pairs, texts), possible, lambda nodes: rarities(nodes, texts), linkable
    )

    placed = rows.select("doc_id", "high", "low").join(nodes.select("high", "low", "node"), ["high", "low"], "left")
    placed = placed.select("doc_id", F.coalesce("node", "doc_id").alias("node"))
    repeated = rows.groupBy("doc_id").count().where("count > 1")
    if repeated.isEmpty():
        named = placed.join(roots, "node", "left").select("doc_id", F.coalesce("root", "node").alias("class_id"))
    else:  # texts that share an id bring their classes together
        named = placed.join(roots, "node", "left").select("doc_id", F.coalesce("root", "node").alias("node"))
        same = linking.connected(named.select(F.col("doc_id").alias("a"), F.col("node").alias("b")))
        named = named.select("doc_id").distinct().join(same, F.col("doc_id") == F.col("node"), "left").select(
            "doc_id", F.coalesce("root", "doc_id").alias("class_id")
        )
    return named.select("doc_id", "class_id", (F.col("doc_id") == F.col("class_id")).alias("kept"))


def deduplicated(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The documents with all their columns, one of each class: that with the least id.

    Where ids repeat, each text of an id is a document of its own, and of a class the one with the least
    hash of id and text stays; so no text goes that has no copy left. Of rows that agree in id and text
    the last one by all their columns stays.
    """
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("doc_id"))
    repeated = rows.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1")
    several = not repeated.isEmpty()
    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    if several:
        key = F.when(F.col("doc_id").isNotNull(), F.xxhash64("doc_id", "text"))
        named = named.select(key.alias("doc_id"), "text")
        key = F.when(F.col("doc_id").isNotNull(), F.xxhash64("doc_id", F.col("row.text").cast("string")))
        rows = rows.select("row", key.alias("doc_id"))
        last = F.max_by("row", F.to_json("row", {"ignoreNullFields": "false"})).alias("row")
        one = rows.where("doc_id IS NOT NULL").groupBy("doc_id").agg(last)
        rows = rows.where("doc_id IS NULL").unionByName(one)
    copies = near_duplicates(spark, named).where("NOT kept").select(F.col("doc_id").alias("copy")).distinct()
    copies = written(copies, "copies")
    return rows.join(copies, F.col("doc_id") == F.col("copy"), "left_anti").select("row.*")
