"""Ranked lexical search by scanning the documents with one automaton of all query terms.

There is no index of the documents. The terms of all items, each between two guards, make an
Aho-Corasick automaton; one pass over a text yields every occurrence of every term as a whole term.

1. Items are dealt by their hash to blocks of a bounded number of bytes and items; each block gets an
   automaton of its own, broadcast as its list of terms, and its own two scans of the documents.
   One block is enough until the items exceed ``BLOCK_BYTES`` or ``BLOCK_ITEMS``.
2. The first scan counts documents, terms and, for each term of the block, the documents that hold
   it; a task sends one row per term.
3. The second scan turns occurrences into scores with 64-bit integers and maps them to items through
   the terms' postings. A task keeps the ``k`` best documents of each item; ties at the border are
   settled by the id, so nothing that could be among the best is dropped.
4. The tasks' lists are merged in two steps, so that no task sees all lists of an item.

Texts are scanned in windows that end between terms: a window holds some ``WINDOW`` bytes, and a
longer single term is scanned whole. Texts are never cut short.

NULL texts, and texts without a term, have no terms and are never found; items without a term find
nothing. Items are searched row by row: an item that is there twice is answered twice, and
documents that are there twice are ranked twice. Equal scores go by ascending id, NULL ids last.
Other columns are ignored. No documents or no items give no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shoreline.llm.common import in_batches, written

BEST = 10
BLOCK_BYTES = 1 << 20
BLOCK_ITEMS = 2000
WINDOW = 1 << 20
LISTS = 64  # first-step merges of the tasks' lists, for each item
GUARD = b" "
# What a byte of UTF-8 becomes: a guard, if it is ASCII other than a letter or digit; A-Z lower.
FOLD = bytes(
    c if c >= 0x80 else ord(chr(c).lower()) if chr(c).isalnum() else GUARD[0] for c in range(256)
)


def folded(text: bytes | None) -> bytes:
    return (text or b"").translate(FOLD)


def weight(documents: int, holding: int) -> int:
    """Of a term that ``holding`` of ``documents`` documents hold."""
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


class Terms:
    """The automaton of some terms: finds which of them stand where in folded bytes."""

    def __init__(self, terms: list[bytes]):
        import ahocorasick

        self.size = len(terms)
        self.automaton = ahocorasick.Automaton()
        for i, term in enumerate(terms):
            self.automaton.add_word((GUARD + term + GUARD).decode("latin-1"), i)
        if terms:
            self.automaton.make_automaton()

    def scan(self, text: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Where the guard after each occurrence stands, and which term it is."""
        if not self.size:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        found = np.fromiter(chain.from_iterable(self.automaton.iter(text.decode("latin-1"))), np.int64)
        return found[::2], found[1::2]

    def counts(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of folded texts: the number of terms of each, and ``text, term, occurrences`` of the
        known terms that each holds, by text and term."""
        n, keys = np.zeros(len(texts), np.int64), [np.empty(0, np.int64)]
        times = [np.empty(0, np.int64)]
        for first, laid, ends in windows(texts):
            blank = np.frombuffer(laid, np.uint8) == GUARD[0]
            stops = np.flatnonzero(blank[1:] & ~blank[:-1]) + 1
            owner = np.searchsorted(ends, stops)
            n[first : first + len(ends)] += np.bincount(owner, minlength=len(ends))
            at, term = self.scan(laid)
            # the same text may go on in the next window, hence the sum below
            key, often = np.unique((first + np.searchsorted(ends, at)) * max(1, self.size) + term, return_counts=True)
            keys.append(key)
            times.append(often)
        key, where = np.unique(np.concatenate(keys), return_inverse=True)
        tf = np.zeros(len(key), np.int64)
        np.add.at(tf, where, np.concatenate(times))
        return n, key // max(1, self.size), key % max(1, self.size), tf


def windows(texts: list[bytes]) -> Iterator[tuple[int, bytes, np.ndarray]]:
    """Texts laid end to end between guards, some ``WINDOW`` bytes at a time: the first text's
    number, the bytes, and where the last guard of each text stands. A long text is cut at guards
    into windows of its own."""
    first, held, size = 0, [], 0
    for i, text in enumerate([*texts, None]):
        if held and (text is None or size + len(text) >= WINDOW):
            laid = GUARD + GUARD.join(held) + GUARD
            yield first, laid, np.cumsum([len(t) + 1 for t in held])
            held, size = [], 0
        if text is None:
            return
        start = 0
        while len(text) - start > WINDOW:
            stop = text.find(GUARD, start + WINDOW)
            if stop < 0:
                break
            yield i, GUARD + text[start:stop] + GUARD, np.array([stop - start + 1])
            start = stop + 1
        if not held:
            first = i
        held.append(text[start:])
        size += len(text) - start + 1


class Best:
    """The ``k`` best documents of each item among those offered so far."""

    def __init__(self, items: int, k: int):
        self.items, self.k = items, k
        self.rows = np.empty((0, 4), np.int64)  # item, -score, 1 for a NULL id, id
        self.border = np.ones(items, np.int64)  # the least score that can still be among the best
        self.waiting: list[np.ndarray] = []
        self.size = 0

    def offer(self, item: np.ndarray, score: np.ndarray, no_id: np.ndarray, doc_id: np.ndarray) -> None:
        good = score >= self.border[item]
        if good.any():
            self.waiting.append(np.stack([item[good], -score[good], no_id[good], doc_id[good]], axis=1))
            self.size += int(good.sum())
        if self.size > 4 * self.k * self.items + 10_000:
            self.settle()

    def settle(self) -> np.ndarray:
        rows = np.concatenate([self.rows, *self.waiting])
        rows = rows[np.lexsort(rows.T[::-1])]
        starts = np.flatnonzero(np.diff(rows[:, 0], prepend=-1))
        place = np.arange(len(rows)) - np.repeat(starts, np.diff(starts, append=len(rows)))
        last = rows[place == self.k - 1]
        self.border[last[:, 0]] = -last[:, 1]
        self.rows, self.waiting, self.size = rows[place < self.k], [], 0
        return self.rows


def _blocks(items: DataFrame) -> tuple[DataFrame, int]:
    """Items with the block each belongs to, and how many blocks there are."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = items.select(F.col("item_id").cast("long").alias("item_id"), text.cast("binary").alias("text"))
    size = rows.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("bytes")).head()
    blocks = max(1, math.ceil(size["n"] / BLOCK_ITEMS), math.ceil(size["bytes"] / BLOCK_BYTES))
    return rows.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))), blocks


def _search_block(spark: SparkSession, docs: DataFrame, queries: list[tuple[int | None, bytes]], k: int) -> DataFrame:
    """The best documents of a bounded list of items: ``item, rank, doc_id, score``."""
    terms: dict[bytes, int] = {}
    postings: list[tuple[int, int]] = []  # term, item; repeats count
    for item, (_, text) in enumerate(queries):
        postings += [(terms.setdefault(t, len(terms)), item) for t in folded(text).split()]
    shared = spark.sparkContext.broadcast(list(terms))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Terms(shared.value)
        holding = np.zeros(known.size + 2, np.int64)  # then documents with a term, and all terms
        for batch in batches:
            n, _, term, _ = known.counts([folded(t) for t in batch.column("text").to_pylist()])
            holding += np.append(np.bincount(term, minlength=known.size), [np.count_nonzero(n), n.sum()])
        number = np.flatnonzero(holding)
        yield pa.RecordBatch.from_arrays([pa.array(number), pa.array(holding[number])], names=["number", "n"])

    found = in_batches(docs.select("text"), count, "number long, n long").groupBy("number").agg(F.sum("n").alias("n"))
    # at most one row for each term of the block, and two
    holding = {r["number"]: r["n"] for r in written(found, "holding").collect()}
    documents, length = holding.get(len(terms), 0), holding.get(len(terms) + 1, 0)
    pairs, often = np.unique(np.array(postings, np.int64).reshape(-1, 2), axis=0, return_counts=True)
    weights = np.array([weight(documents, holding.get(i, 0)) for i in range(len(terms))], np.int64)
    # postings by term: the items that a term stands for and its weight times its repeats in each
    starts = np.searchsorted(pairs[:, 0], np.arange(len(terms) + 1))
    gains = weights[pairs[:, 0]] * often if len(pairs) else np.empty(0, np.int64)
    lists = spark.sparkContext.broadcast((starts, pairs[:, 1].copy(), gains))
    items = len(queries)

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, (starts, to, gain) = Terms(shared.value), lists.value
        best = Best(items, k)
        for batch in batches:
            n, doc, term, tf = known.counts([folded(t) for t in batch.column("text").to_pylist()])
            ids = batch.column("doc_id")
            no_id = np.array(ids.is_null().to_numpy(zero_copy_only=False), np.int64)
            ids = ids.fill_null(0).to_numpy()
            # Python numbers: n times N times 75 may be more than 64 bits hold
            m = np.array([25 + 75 * int(x) * documents // max(1, length) for x in n], np.int64)
            part = 1_000_000_000 * tf // (1000 * tf + 8 * m[doc]) if len(doc) else tf
            size = starts[term + 1] - starts[term]
            at = np.repeat(starts[term] - np.cumsum(size) + size, size) + np.arange(size.sum())
            scores = np.zeros(len(n) * items, np.int64)
            np.add.at(scores, np.repeat(doc, size) * items + to[at], np.repeat(part, size) * gain[at])
            scored = np.flatnonzero(scores)
            best.offer(scored % items, scores[scored], no_id[scored // items], ids[scored // items])
        rows = best.settle()
        columns = [rows[:, 0], pa.array(rows[:, 3], mask=rows[:, 2] == 1), -rows[:, 1]]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["item", "doc_id", "score"])

    scanned = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    offers = in_batches(scanned, rank, "item long, doc_id long, score long")
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    partly = Window.partitionBy("item", "list").orderBy(*order)
    offers = offers.withColumn("list", F.pmod(F.xxhash64("doc_id"), F.lit(LISTS)))
    offers = offers.withColumn("place", F.row_number().over(partly)).where(F.col("place") <= k)
    whole = Window.partitionBy("item").orderBy(*order)
    return offers.withColumn("rank", F.row_number().over(whole)).where(F.col("rank") <= k).select("item", "rank", "doc_id", "score")


def search(spark: SparkSession, docs: DataFrame, items: DataFrame, k: int = BEST) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` documents of ``doc_id, text`` that score highest
    for each row of ``item_id, text``."""
    texts = docs.select("doc_id", F.col("text").cast("string").cast("binary").alias("text"))
    dealt, blocks = _blocks(items)
    dealt = written(dealt, "items")
    answers = None
    for block in range(blocks):
        # bounded by BLOCK_BYTES and BLOCK_ITEMS on average; a longer single item is a row anyway
        queries = [(r["item_id"], bytes(r["text"])) for r in dealt.where(F.col("block") == block).collect()]
        names = spark.createDataFrame([(i, q[0]) for i, q in enumerate(queries)], "item long, item_id long")
        found = _search_block(spark, texts, queries, k).join(F.broadcast(names), "item")
        found = found.select("item_id", "rank", "doc_id", "score")
        if blocks > 1:  # at most k rows an item; keeps the plan short
            found = written(found, "answers")
        answers = found if answers is None else answers.unionByName(found)
    return answers


def sql() -> str:
    """The same ranking from counted terms, for ids that are neither NULL nor repeated."""
    term = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    terms = f"unnest(regexp_extract_all(translate(text, '{upper}', '{lower}'), '{term}')) AS term"
    return f"""
    WITH words AS (SELECT doc_id, {terms} FROM documents),
    counted AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY ALL),
    lengths AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM counted GROUP BY ALL),
    totals AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS len FROM lengths),
    wanted AS (
      SELECT item_id, term, count(*) AS often
      FROM (SELECT item_id, {terms} FROM benchmark) GROUP BY ALL),
    weights AS (
      SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
      FROM counted, totals WHERE term IN (SELECT term FROM wanted) GROUP BY term, docs),
    norms AS (SELECT doc_id, 25 + (75 * n * docs) // len AS m FROM lengths, totals),
    scores AS (
      SELECT item_id, doc_id,
             CAST(sum(often * w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
      FROM wanted JOIN weights USING (term) JOIN counted USING (term) JOIN norms USING (doc_id)
      GROUP BY ALL),
    ranked AS (
      SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank,
             doc_id, score
      FROM scores WHERE score > 0)
    SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= {BEST}
    """
