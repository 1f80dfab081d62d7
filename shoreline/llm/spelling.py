"""Spelling variants: words one edit apart, found with a bidirectional FM-index search scheme.

1. Tasks count words of whole texts; a task holds at most ``HELD`` words before it sends them on.
2. Two words one edit apart agree exactly in one half of the first: the edit lies either in the
   left half or in the right one. So every word is looked up among the words that end like its
   right half, and among those that begin like its left half. These halves deal the words to
   shards, so that a word meets only the shard of its halves. A word is indexed under the halves
   of words one shorter, of its own length and one longer, which are at most two of each kind.
3. A shard is an FM-index over its delimited words: forward for equal ends, over the reversed words
   for equal beginnings. An exact half narrows an interval of suffix ranks, and the interval is then
   extended across the other half with one inserted, deleted or replaced letter allowed. The words
   of a shard are searched together, a length at a time, with array kernels.
4. A half that very many words share is dealt on to several shards by the word's hash, and looked up
   in each. Beyond ``SHARD`` letters under one half, look-ups therefore grow with the square of that
   half's words (in units of a shard); letters and lengths bound how many words share a half.
5. A word's form is its near word of largest count, if that is at least twice its own; equal counts
   go to the smallest word in code-point order. Forms are followed from the roots down: each step
   settles the words whose form was settled by the step before. Counts double along forms, so
   there are at most as many steps as the largest count has bits.

NULL texts have no words. A NULL id reads as an empty one. Repeated rows count each time. Texts and
words may have any length. An empty table, or one without words, gives no rows. Other columns are
ignored.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shoreline.llm.common import in_batches, written

LETTERS = re.compile("[a-zÀ-ÿ]+")
PIECE = 1 << 22
HELD = 500_000
LEAST_LENGTH, LEAST_COUNT = 5, 3
DELETED_IN = 97
SHARD = 1_000_000  # letters and delimiters
TOGETHER = 20_000  # words searched at once
DELIMITER = 0


# Words --------------------------------------------------------------------------------------------


def runs(text: bytes) -> Counter:
    """How often each run of letters stands in UTF-8 text, with A-Z lower-cased."""
    lowered = text.lower().decode()
    if len(lowered) <= PIECE:
        return Counter(LETTERS.findall(lowered))
    found, start = Counter(), 0
    while start < len(lowered):
        stop = min(len(lowered), start + PIECE)
        last = LETTERS.match(lowered, stop)
        stop = last.end() if last else stop  # a run is not cut
        found.update(LETTERS.findall(lowered, start, stop))
        start = stop
    return found


def spelled(run: str, start: int) -> str:
    """The run, or what is left of it where its checksum deletes a letter; ``start`` is the checksum
    of the id and the colon."""
    check = zlib.crc32(run.encode(), start)
    if check % DELETED_IN:
        return run
    at = check % len(run)
    return run[:at] + run[at + 1 :]


def counted(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """``word, n`` of all words that are long and frequent enough."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: defaultdict[str, int] = defaultdict(int)

        def given() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays(
                [pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"]
            )
            held.clear()
            return out

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                for run, n in runs(text or b"").items():
                    word = spelled(run, start)
                    if len(word) >= least_length:
                        held[word] += n
            if len(held) >= HELD:
                yield given()
        yield given()

    texts = docs.select("doc_id", F.col("text").cast("string").cast("binary").alias("text"))
    words = in_batches(texts, work, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return words.where(F.col("n") >= least_count)


# The index ----------------------------------------------------------------------------------------


class Index:
    """An FM-index over distinct words in rising order, each between two delimiters.

    Rows are the suffixes in order. The step to the delimiter before the i-th word, from 0, leads to
    row i + 1, so the row where a search ends names the word. ``steps`` holds the letters before the suffixes with their rows, in
    order: the rank of a letter at a row, counted from where the letter's suffixes begin, is a binary
    search in it.
    """

    def __init__(self, words: list[str]):
        points = np.frombuffer("".join(words).encode("utf-32-le"), "<u4")
        self.letters = np.unique(points)
        ends = np.cumsum(np.fromiter((len(w) + 1 for w in words), np.int64, len(words)))
        text = np.zeros(int(ends[-1]) + 1, np.int64)
        inside = np.ones(len(text), bool)
        inside[0] = inside[ends] = False
        text[inside] = np.searchsorted(self.letters, points) + 1
        self.size = len(text)
        self.words = len(words) + 1  # rows of delimiters
        order = self._suffixes(text, max(map(len, words)))
        before = text[order - 1]
        before[order == 0] = -1  # no letter steps across the ends
        self.before = before
        by_letter = np.argsort(before, kind="stable")
        self.steps = before[by_letter] * self.size + by_letter
        self.next = np.empty(self.size, np.int64)
        self.next[by_letter] = np.arange(self.size)

    def _suffixes(self, text: np.ndarray, longest: int) -> np.ndarray:
        """The suffixes in order, by doubling. Delimiters rise with their place, which is how the
        words after them are ordered, so no comparison goes beyond one."""
        rank = np.where(text == DELIMITER, np.cumsum(text == DELIMITER) - 1, text + self.words)
        reach = 1
        while True:
            ahead = np.zeros(self.size, np.int64)
            ahead[:-reach] = rank[reach:] + 1
            key = rank * (self.size + len(self.letters) + 2) + ahead
            order = np.argsort(key, kind="stable")
            new = np.concatenate([[False], np.diff(key[order]) != 0])
            rank[order] = np.cumsum(new)
            reach *= 2
            if reach > longest or new[1:].all():
                return order

    def codes(self, words: list[str]) -> np.ndarray:
        """Words of one length as a matrix of letters; those that the index lacks match nothing."""
        points = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").reshape(len(words), -1)
        at = np.minimum(np.searchsorted(self.letters, points), len(self.letters) - 1)
        return np.where(self.letters[at] == points, at + 1, len(self.letters) + 2).astype(np.int64)

    def step(self, letter: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals one letter further left."""
        base = letter * self.size
        return np.searchsorted(self.steps, base + low), np.searchsorted(self.steps, base + high)

    def branches(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, ...]:
        """All ways to go on left from each interval: its number, the letter, the interval there."""
        size = high - low
        wide = size > 2 * len(self.letters)
        number, letter, lows, highs = [], [], [], []
        few = np.flatnonzero(~wide)
        if len(few):
            owner = np.repeat(few, size[few])
            row = np.repeat(low[few] - np.cumsum(size[few]) + size[few], size[few]) + np.arange(len(owner))
            key = owner * (len(self.letters) + 3) + self.before[row] + 1
            order = np.argsort(key, kind="stable")
            key, to = key[order], self.next[row[order]]
            starts = np.flatnonzero(np.diff(key, prepend=-1))
            number.append(key[starts] // (len(self.letters) + 3))
            letter.append(key[starts] % (len(self.letters) + 3) - 1)
            lows.append(to[starts])
            highs.append(to[starts] + np.diff(starts, append=len(key)))
        many = np.flatnonzero(wide)
        if len(many):
            each = np.tile(np.arange(1, len(self.letters) + 1), len(many))
            owner = np.repeat(many, len(self.letters))
            to_low, to_high = self.step(each, low[owner], high[owner])
            there = to_low < to_high
            number.append(owner[there])
            letter.append(each[there])
            lows.append(to_low[there])
            highs.append(to_high[there])
        if not number:
            return (np.empty(0, np.int64),) * 4
        number, letter = np.concatenate(number), np.concatenate(letter)
        order = np.argsort(number, kind="stable")
        real = order[letter[order] > DELIMITER]
        return number[real], letter[real], np.concatenate(lows)[real], np.concatenate(highs)[real]

    def near(self, patterns: np.ndarray, free: int) -> tuple[np.ndarray, np.ndarray]:
        """Patterns and words one edit apart in the first ``free`` letters, equal in the others.

        ``low, high, which`` are intervals without an edit so far, ``low1, high1, which1`` those
        with one. A pair may come several times, as an edit may have several places.
        """
        count, length = patterns.shape
        which = np.arange(count)
        low, high = np.zeros(count, np.int64), np.full(count, self.words, np.int64)
        for j in range(length - 1, free - 1, -1):
            low, high = self.step(patterns[which, j], low, high)
            live = low < high
            which, low, high = which[live], low[live], high[live]
        low1, high1, which1 = (np.empty(0, np.int64),) * 3
        for j in range(free - 1, -2, -1):
            # the letter that must come next; in front of the first one, the delimiter
            def expected(of: np.ndarray, j: int = j) -> np.ndarray:
                return patterns[of, j] if j >= 0 else np.zeros(len(of), np.int64)

            low1, high1 = self.step(expected(which1), low1, high1)
            first, group = np.unique(low, return_inverse=True)
            top = np.zeros(len(first), np.int64)
            top[group] = high
            of, letter, to_low, to_high = self.branches(first, top)
            begins = np.searchsorted(of, np.arange(len(first) + 1))
            size = (begins[1:] - begins[:-1])[group]
            at = np.repeat(begins[group] - np.cumsum(size) + size, size) + np.arange(size.sum())
            taker = np.repeat(which, size)
            letter, to_low, to_high = letter[at], to_low[at], to_high[at]
            # one more letter in the word, before the expected one
            more_low, more_high = self.step(expected(taker), to_low, to_high)
            lows, highs, takers = [low1, more_low], [high1, more_high], [which1, taker]
            if j >= 0:
                other = letter != expected(taker)  # another letter instead
                lows += [to_low[other], low]  # and none at all
                highs += [to_high[other], high]
                takers += [taker[other], which]
            low1, high1, which1 = np.concatenate(lows), np.concatenate(highs), np.concatenate(takers)
            live = low1 < high1
            low1, high1, which1 = low1[live], high1[live], which1[live]
            low, high = self.step(expected(which), low, high)
            live = low < high
            which, low, high = which[live], low[live], high[live]
        return which1, low1 - 1


def near_words(words: list[str], queries: list[str], backward: bool) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a query and a word one edit apart, as places in the lists.

    The edit lies in the query's left half and the rest is equal; ``backward``, in the right half.
    """
    turn = (lambda w: w[::-1]) if backward else (lambda w: w)
    turned = [turn(w) for w in words]
    order = sorted(range(len(words)), key=turned.__getitem__)
    index = Index([turned[i] for i in order])
    by_length: defaultdict[int, list[int]] = defaultdict(list)
    for i, query in enumerate(queries):
        by_length[len(query)].append(i)
    pairs = [np.empty(0, np.int64)]
    for length, group in by_length.items():
        group.sort(key=lambda i: turn(queries[i])[::-1])  # neighbours share their intervals
        free = length - length // 2 if backward else length // 2
        for start in range(0, len(group), TOGETHER):
            part = group[start : start + TOGETHER]
            which, row = index.near(index.codes([turn(queries[i]) for i in part]), free)
            pairs.append(np.unique(np.array(part)[which] * len(words) + np.array(order)[row]))
    found = np.concatenate(pairs)
    return found // len(words), found % len(words)


# Over all words -----------------------------------------------------------------------------------


def _half(word: Column, of_length: Column, backward: bool) -> Column:
    """The half that words of that length look up: the beginning or the end."""
    left = F.floor(of_length / 2).cast("int")
    return F.left(word, left) if backward else F.right(word, (of_length - left).cast("int"))


def pairs(spark: SparkSession, words: DataFrame, shard: int = SHARD) -> DataFrame:
    """``word, near, near_n``: all pairs of ``word, n`` rows one edit apart, each both ways."""
    length = F.char_length("word")

    def asked(backward: bool) -> Column:
        return F.struct(F.lit(backward).alias("backward"), _half(F.col("word"), length, backward).alias("half"))

    def indexed(backward: bool) -> Column:
        others = [_half(F.col("word"), length + d, backward) for d in (-1, 0, 1)]
        halves = F.array_distinct(F.array(*others))
        return F.transform(halves, lambda h: F.struct(F.lit(backward).alias("backward"), h.alias("half")))

    sought = words.select("word", "n", F.explode(F.array(asked(True), asked(False))).alias("key"))
    held = words.select("word", "n", F.explode(F.concat(indexed(True), indexed(False))).alias("key"))
    rows = held.withColumn("sought", F.lit(False)).unionByName(sought.withColumn("sought", F.lit(True)))
    rows = rows.select("word", "n", "sought", "key.backward", "key.half")
    letters = F.sum(F.when(~F.col("sought"), F.char_length("word") + 1).otherwise(0))
    # one row for each half; only those that outgrow a shard are kept
    large = rows.groupBy("backward", "half").agg(letters.alias("letters")).where(F.col("letters") > shard)
    large = written(large.select("backward", "half", F.ceil(F.col("letters") / shard).alias("parts")), "large_halves")
    total = held.agg(F.coalesce(F.sum(F.char_length("word") + 1), F.lit(0))).head()[0]
    shards = max(1, math.ceil(total / shard))
    rows = rows.join(large, ["backward", "half"], "left")
    own = F.pmod(F.xxhash64("word"), F.coalesce("parts", F.lit(1)))
    parts = F.when(F.col("sought") & F.col("parts").isNotNull(), F.sequence(F.lit(0), F.col("parts") - 1)).otherwise(F.array(own))
    rows = rows.withColumn("part", F.explode(parts))
    rows = rows.withColumn("shard", F.pmod(F.xxhash64("half", "part"), F.lit(shards)).cast("int"))
    rows = rows.select("backward", "shard", "word", "n", "sought")

    def search(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        word, n = table.column("word").to_pylist(), table.column("n").to_pylist()
        sought = table.column("sought").to_pylist()
        there = {w: c for w, c, s in zip(word, n, sought, strict=True) if not s}
        queries = list({w for w, s in zip(word, sought, strict=True) if s})
        names = list(there)
        found = (np.empty(0, np.int64),) * 2
        if names and queries:
            found = near_words(names, queries, key[0].as_py())
        columns = [pa.array(queries, pa.string()).take(pa.array(found[0])), pa.array(names, pa.string()).take(pa.array(found[1]))]
        counts = pa.array(list(there.values()), pa.int64()).take(pa.array(found[1]))
        return pa.Table.from_arrays([*columns, counts], names=["word", "near", "near_n"])

    dealt = rows.repartition(2 * shards, "backward", "shard").groupBy("backward", "shard")
    found = dealt.applyInArrow(search, "word string, near string, near_n long")
    # an edit between the halves is found from both sides
    return found.groupBy("word", "near").agg(F.first("near_n").alias("near_n"))


def grouped(spark: SparkSession, words: DataFrame, shard: int = SHARD) -> DataFrame:
    """``word, n, n_near, form, form_n, root`` of ``word, n`` rows with distinct words."""
    words = written(words, "words")
    found = pairs(spark, words, shard)
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("near")))
    near = found.groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    forms = words.join(near, "word", "left").withColumn("large", -F.col("best.less") >= 2 * F.col("n"))
    forms = forms.select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(F.col("large"), F.col("best.near")).alias("form"),
        F.when(F.col("large"), -F.col("best.less")).alias("form_n"),
    )
    forms = written(forms, "forms")
    settled = [forms.where(F.col("form").isNull()).withColumn("root", F.col("word"))]
    waiting = forms.where(F.col("form").isNotNull())
    while not waiting.isEmpty():
        above = settled[-1].select(F.col("word").alias("form"), "root")
        step = written(waiting.join(above, "form", "left"), "roots").select(*forms.columns, "root")
        settled.append(step.where(F.col("root").isNotNull()))
        waiting = step.where(F.col("root").isNull()).drop("root")
    out = settled[0]
    for step in settled[1:]:
        out = out.unionByName(step)
    return out


def variants(spark: SparkSession, docs: DataFrame, shard: int = SHARD) -> DataFrame:
    """The words of ``doc_id, text`` rows with their near words, forms and roots."""
    return grouped(spark, counted(docs), shard)
