"""Fuzzy line deduplication: SimHash blocks find candidates, edit similarity decides.

Lines are normalised: lower-cased words (letters, digits, underscores) with one blank between and 0
for every digit. Lines of fewer than ``LEAST_CHARS`` normalised characters are structure rather
than passages and are left alone. Equal normalised lines are one node. The rest are linked if

* the 64-bit SimHashes of their words (weighted by length, each distinct word once) differ in at
  most ``DISTANCE`` bits. The 64 bits are cut into five blocks, of which two must then agree
  (pigeonhole), so lines meet in a bucket for each pair of blocks; and
* their edit distance is at most a fifth of the longer one's length.

Of each connected group the first occurrence stays, by document id and then line number; all other
occurrences are removed, within a document as well as across documents.

A text that loses lines keeps its other lines as they are, also blank ones. NULL and empty texts
have no line to lose. Rows that agree in id and text count as one document, which is returned once,
as the last of them by all their columns; documents without an id are returned unchanged, as nothing names their lines.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from shoreline.llm import linking, text
from shoreline.llm.common import in_batches, written

LEAST_CHARS = 20
DISTANCE = 3
BLOCKS = ((0, 13), (13, 13), (26, 13), (39, 13), (52, 12))
SIMILARITY = 0.8
MOST_BROADCAST = 1_000_000
CHARACTERS = 1 << 17  # normalised together by a task
NODES_PER_TASK = 100_000  # each of which is in ten buckets
LINES = "doc_id long, version long, line int, node long, simhash long"


WORDS_AT_ONCE = 256  # of weight 255 at most: their sum fits in 16 bits
QUARTERS = np.array([sum(((n >> b) & 1) << (16 * b) for b in range(4)) for n in range(16)], np.uint64)


def sums_before(values: np.ndarray) -> np.ndarray:
    """Running sums modulo 2**64; a span's sum is the difference of two."""
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values, out=out[1:])
    return out


class Normal:
    """The normalised lines of a run of texts."""

    def __init__(self, texts: list[str]):
        laid = text.Laid([t.lower() for t in texts])
        zeros = np.where(text.table("digit")[laid.codes], np.uint32(ord("0")), laid.codes)
        self.laid, self.codes = laid, zeros
        laid.codes = zeros
        self.starts, self.ends = laid.lines()
        self.owner = laid.owner(self.starts)
        self.number = np.arange(len(self.starts)) - np.searchsorted(self.owner, self.owner)
        self.word_starts, self.word_ends = laid.words()
        self.first = np.searchsorted(self.word_starts, self.starts)
        self.last = np.searchsorted(self.word_starts, self.ends)
        self.words = self.last - self.first
        letters = np.concatenate([[0], np.cumsum(self.word_ends - self.word_starts)])
        self.chars = letters[self.last] - letters[self.first] + np.maximum(self.words - 1, 0)
        self.long = np.flatnonzero(self.chars >= LEAST_CHARS)

    def nodes(self) -> tuple[np.ndarray, np.ndarray]:
        """Hash and SimHash of each long line."""
        hashes = self.laid.hashes(self.word_starts, self.word_ends)
        line = np.repeat(np.arange(len(self.starts)), self.words)
        place = np.arange(len(hashes)) - self.first[line]
        spread = text.powers(int(self.words.max(initial=0)) + 1, 0xD6E8FEB86659FD93)
        sums = sums_before(text.mix(hashes) * spread[place])
        whole = text.mix(sums[self.last[self.long]] - sums[self.first[self.long]] + self.words[self.long].astype(np.uint64))
        return whole, self._simhash(hashes)

    def _simhash(self, hashes: np.ndarray) -> np.ndarray:
        """The sign of each hash bit's weighted sum. Longer words weigh more, the shortest hardly.

        Four bits at a time are spread over the 16-bit quarters of a number, so that running sums
        of such numbers add up four bits' weights at once; lines too long for that come in parts.
        """
        weight = np.minimum(np.maximum(4 * (self.word_ends - self.word_starts - 3), 1), 255).astype(np.uint64)
        first, last = self.first[self.long], self.last[self.long]
        total = sums_before(weight)
        half = (total[last] - total[first]).astype(np.int64)
        parts = np.maximum(1, -(-(last - first) // WORDS_AT_ONCE))
        begin = np.repeat(first, parts) + WORDS_AT_ONCE * (np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts))
        end = np.minimum(begin + WORDS_AT_ONCE, np.repeat(last, parts))
        line = np.repeat(np.arange(len(first)), parts)
        out = np.zeros(len(first), np.uint64)
        for shift in range(0, 64, 4):
            sums = sums_before(QUARTERS[(hashes >> np.uint64(shift)) & np.uint64(15)] * weight)
            packed = sums[end] - sums[begin]
            for bit in range(4):
                lane = (packed >> np.uint64(16 * bit)) & np.uint64(0xFFFF)
                weighted = np.bincount(line, weights=lane, minlength=len(first))
                out |= (2 * weighted > half).astype(np.uint64) << np.uint64(shift + bit)
        return out

    def text(self, i: int) -> str:
        """The normalised line of number ``i`` in the run."""
        spans = zip(self.word_starts[self.first[i] : self.last[i]], self.word_ends[self.first[i] : self.last[i]], strict=True)
        return " ".join(self.codes[s:e].astype("<u4").tobytes().decode("utf-32-le", "surrogatepass") for s, e in spans)


def occurrences(docs: DataFrame) -> DataFrame:
    """Every long line as ``doc_id, version, line, node, simhash``."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for start, stop in text.chunks(texts, CHARACTERS):
                found = Normal(texts[start:stop])
                nodes, simhashes = found.nodes()
                rows = pa.array(found.owner[found.long] + start)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").take(rows),
                        batch.column("version").take(rows),
                        pa.array(found.number[found.long].astype(np.int32)),
                        pa.array(nodes.view(np.int64)),
                        pa.array(simhashes.view(np.int64)),
                    ],
                    names=["doc_id", "version", "line", "node", "simhash"],
                )

    return in_batches(docs.where("text IS NOT NULL AND doc_id IS NOT NULL"), work, LINES)


def wordings(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``node, wording`` of the wanted nodes, from the documents that ``wanted`` names."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, wanted = batch.column("text").to_pylist(), batch.column("nodes").to_pylist()
            for start, stop in text.chunks(texts, CHARACTERS):
                found = Normal(texts[start:stop])
                nodes, _ = found.nodes()
                rows, lists = [], [set(nodes) for nodes in wanted[start:stop]]
                for node, i in zip(nodes.view(np.int64).tolist(), found.long.tolist(), strict=True):
                    if node in lists[found.owner[i]]:
                        rows.append((node, found.text(i)))
                columns = list(zip(*rows, strict=True)) or [[], []]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.string())], names=["node", "wording"]
                )

    lists = wanted.groupBy("doc_id").agg(F.collect_list("node").alias("nodes"))
    lists = written(lists, "wanted")
    if lists.count() <= MOST_BROADCAST // 10:
        lists = F.broadcast(lists)
    found = in_batches(docs.join(lists, "doc_id").select("text", "nodes"), work, "node long, wording string")
    return found.groupBy("node").agg(F.min("wording").alias("wording"))


def block_keys(simhash: Column) -> list[Column]:
    parts = [F.shiftrightunsigned(simhash, start).bitwiseAND((1 << bits) - 1) for start, bits in BLOCKS]
    return [
        F.xxhash64(F.lit(f"{i},{j}"), parts[i], parts[j]) for i, j in combinations(range(len(BLOCKS)), 2)
    ]


# How many words of either line may be passed over, fewest first, until the lines agree again.
STEPS = sorted(((i, j) for i in range(5) for j in range(5) if i or j), key=lambda step: (max(step), sum(step)))


def bound(a: str, b: str, limit: int) -> int:
    """An upper bound of the edit distance, or something above the limit.

    Both lines are walked word by word. Where they differ, the fewest words are passed over after
    which they agree again, at the price of the longer of the two stretches.
    """
    x, y = a.split(" "), b.split(" ")
    i = j = cost = 0
    while i < len(x) and j < len(y):
        if x[i] == y[j]:
            i, j = i + 1, j + 1
            continue
        for over, more in STEPS:
            if i + over < len(x) and j + more < len(y) and x[i + over] == y[j + more]:
                break
        else:
            over = more = 1
        cost += max(sum(map(len, x[i : i + over])) + over, sum(map(len, y[j : j + more])) + more)
        if cost > limit:
            return cost
        i, j = i + over, j + more
    return cost + max(sum(map(len, x[i:])) + len(x) - i, sum(map(len, y[j:])) + len(y) - j)


def distance(a: str, b: str) -> int:
    """Edit distance, a whole column of the table at a time: the bits of two long numbers say where
    neighbouring cells of the column go up and down."""
    start = 0
    while start < min(len(a), len(b)) and a[start] == b[start]:
        start += 1
    a, b = a[start:], b[start:]
    if not a or not b:
        return len(a) + len(b)
    where: dict[str, bytearray] = {}
    for i, letter in enumerate(a):
        bits = where.setdefault(letter, bytearray(len(a) // 8 + 1))
        bits[i >> 3] |= 1 << (i & 7)
    masks = {letter: int.from_bytes(bits, "little") for letter, bits in where.items()}
    every, last = (1 << len(a)) - 1, len(a) - 1
    up, down, score = every, 0, len(a)
    for letter in b:
        same = masks.get(letter, 0)
        level = (((same & up) + up) ^ up) | same
        rises, falls = (down | ~(level | up)) & every, up & level
        score += (rises >> last & 1) - (falls >> last & 1)
        rises, falls, same = rises << 1 | 1, falls << 1, same | down
        up, down = (falls | ~(same | rises)) & every, rises & same & every
    return score


def near(a: str, b: str) -> bool:
    """Whether the edit distance is at most a fifth of the longer line's length. Nearly all near
    lines are known by the bound already; the distance decides the others."""
    longest = max(len(a), len(b))
    limit = int(longest * (1 - SIMILARITY) + 1e-9)
    if longest - min(len(a), len(b)) > limit:
        return False
    return bound(a, b, limit) <= limit or distance(a, b) <= limit


def near_pairs(pairs: DataFrame) -> DataFrame:
    """The ``a, b`` whose wordings are near."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = zip(batch.column("a_wording").to_pylist(), batch.column("b_wording").to_pylist(), strict=True)
            yield batch.select(["a", "b"]).filter(pa.array([near(a, b) for a, b in both], pa.bool_()))

    return in_batches(pairs.select("a", "b", "a_wording", "b_wording"), work, "a long, b long")


def close(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b)) <= DISTANCE


def groups(docs: DataFrame, lines: DataFrame) -> DataFrame:
    """``node, root`` of lines with a near line. ``docs`` and ``lines`` are prepared and written.

    The SimHashes travel with the bucket's members, so only pairs that are close enough leave the
    joins; only for those the wordings are fetched, from one document each.
    """
    nodes = written(
        lines.groupBy("node").agg(F.first("simhash").alias("simhash"), F.min("doc_id").alias("doc_id")), "nodes"
    )
    keys = F.explode(F.array(*block_keys(F.col("simhash"))))
    tasks = nodes.count() // NODES_PER_TASK + 1
    members = nodes.repartition(tasks, "node").select("node", F.col("simhash").alias("fact"), keys.alias("bucket"))

    def alike(pairs: DataFrame) -> DataFrame:
        asked = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
        known = written(wordings(docs, nodes.join(asked, "node")), "wordings")
        for side in ("a", "b"):
            named = known.select(F.col("node").alias(side), F.col("wording").alias(f"{side}_wording"))
            pairs = pairs.join(named, side)
        return near_pairs(pairs)

    return linking.classes(members, alike, close)


def removals(docs: DataFrame) -> DataFrame:
    """``doc_id, version, lines`` for each document that loses lines: the numbers of those lines."""
    lines = written(occurrences(docs), "lines")
    roots = written(groups(docs, lines), "roots")
    counts = lines.groupBy("node").agg(F.count("*").alias("n"))
    several = counts.join(roots, "node", "left").where("n > 1 OR root IS NOT NULL")
    several = written(several.select("node", F.coalesce("root", "node").alias("root")), "several")
    place = F.struct("doc_id", "line", "version")
    held = written(lines.join(several, "node").select("root", "doc_id", "line", "version"), "repeated")
    first = written(held.groupBy("root").agg(F.min(place).alias("first")), "first")
    return (
        held.join(first, "root")
        .where(place != F.col("first"))
        .groupBy("doc_id", "version")
        .agg(F.collect_list("line").alias("lines"))
    )


@F.pandas_udf(StringType())
def without(texts, lines):
    import pandas as pd

    out = []
    for whole, gone in zip(texts, lines, strict=True):
        if gone is not None and whole is not None:
            gone = set(gone.tolist())
            whole = "\n".join(line for i, line in enumerate(whole.split("\n")) if i not in gone)
        out.append(whole)
    return pd.Series(out, dtype=object)


# A filter on what is left would otherwise be pushed below the projection with a copy of the call: every
# text would go to Python twice, and every task would hold two workers.
without = without.asNondeterministic()


def prepared(docs: DataFrame) -> DataFrame:
    """The columns that the lines come from; the version tells texts of one id apart."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64(F.col("text").cast("string")).alias("version"),
        F.col("text").cast("string").alias("text"),
    )


def dedup(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Every row as struct ``row`` with ``text`` (what is left of it), ``n_lines`` and ``n_removed``."""
    gone = written(removals(prepared(docs)), "removals")
    size = gone.agg(F.count("*").alias("n"), F.sum(F.size("lines")).alias("lines")).first()
    # line numbers of few documents are broadcast, or else the texts meet them by shuffle
    small = size["n"] <= MOST_BROADCAST // 4 and (size["lines"] or 0) <= MOST_BROADCAST * 2
    gone = F.broadcast(gone) if small else gone
    rows = docs.select(
        F.struct("*").alias("row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64(F.col("text").cast("string")).alias("version"),
    )
    # repeated rows are one document; nothing needs to be dropped where ids are unique
    named = docs.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.col("text").cast("string")).alias("version"))
    repeated = named.groupBy("doc_id", "version").count().where("count > 1")
    if not repeated.isEmpty():
        last = F.max_by("row", F.to_json("row", {"ignoreNullFields": "false"})).alias("row")
        one = rows.where("doc_id IS NOT NULL").groupBy("doc_id", "version").agg(last)
        rows = rows.where("doc_id IS NULL").unionByName(one.select(*rows.columns))
    whole = F.col("row.text").cast("string")
    return rows.join(gone, ["doc_id", "version"], "left").select(
        "row",
        F.when(F.col("lines").isNull(), whole).otherwise(without(whole, F.col("lines"))).alias("text"),
        F.when(whole.isNull() | (whole == ""), 0).otherwise(F.size(F.split(whole, "\n"))).alias("n_lines"),
        F.coalesce(F.size("lines"), F.lit(0)).alias("n_removed"),
    )


def cleaned(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The documents with all their columns; those that lost all their lines go. ``n_chars``, where
    there is one, counts what is left."""
    rows = dedup(spark, docs)
    left = F.trim(F.translate("text", "\n\t\r", "   ")) != ""
    kept = rows.where((F.col("n_removed") == 0) | left)
    now = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        counted = F.length("text").cast(docs.schema["n_chars"].dataType)
        now["n_chars"] = F.when(F.col("n_removed") == 0, F.col("row.n_chars")).otherwise(counted)
    return kept.select(*(now.get(c, F.col("row")[c]).alias(c) for c in docs.columns))
