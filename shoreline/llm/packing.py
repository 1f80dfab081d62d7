"""Packing token sequences: shortest pack first over the length histogram.

1. Tasks tokenise whole texts, end each document with ``end_id`` and cut it into pieces of at most
   ``length`` ids. Only the pieces' places, lengths and checksums leave the tasks.
2. The histogram of piece lengths has at most ``length`` bins whatever the input. On it, lengths
   are placed longest first, all pieces of a length at once: they go to the open pattern with the
   fewest ids so far; where even that pattern has no room for the whole length, new patterns are
   opened, each of which takes as many of the length as fit. A pattern is a list of lengths and a count of sequences that look like it.
3. Pieces of one length are numbered 0, 1, ... across all tasks (counts per length and block, then
   numbers inside a block), and a piece's number says which sequence of which pattern it fills.

Full pieces are patterns of their own. Blocks are made from row hashes, so no task gets all pieces
of a length; pieces that are equal in every column may swap numbers, which changes nothing.

NULL texts count as empty: one piece holding ``end_id`` alone. NULL ids and repeated rows are
packed like all others, row by row. Other columns of the input are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shoreline.llm import text
from shoreline.llm.common import in_batches, written

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
WHITE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
CACHED_WORDS = 1 << 20
PIECES_PER_BLOCK = 2000


@cache
def _classes() -> np.ndarray:
    """0 letter, 1 number, 2 other, 3 white space, as byte-level vocabularies split texts."""
    import unicodedata

    kinds = {"L": 0, "N": 1}
    out = np.fromiter(
        (kinds.get(unicodedata.category(chr(i))[0], 2) for i in range(text.CODES)), np.int8, text.CODES
    )
    out[WHITE] = 3
    return out


def word_starts(laid: text.Laid) -> np.ndarray:
    """Where the vocabulary's words start: runs of one class, with one blank before them.

    A run of several white-space characters gives up its last one to what follows. Contractions
    with an apostrophe are the caller's matter.
    """
    codes = laid.codes
    kind = _classes()[codes]
    blank = kind == 3
    edge = np.zeros(len(codes), bool)
    edge[laid.starts] = True
    last = np.zeros(len(codes), bool)
    last[laid.ends] = True
    before = np.concatenate([[2], kind[:-1]])
    before_blank = (before == 3) & ~edge
    after_blank = np.concatenate([blank[1:] | last[1:], [True]])
    plain = np.where(before_blank, np.concatenate([[0], codes[:-1]]) != 0x20, kind != before)
    return np.flatnonzero((edge | np.where(blank, ~before_blank | ~after_blank, plain)) & ~last)


class Tokens:
    """Ids of whole texts. A word is encoded the first time it is met and kept in an open hash table
    of arrays, so that all words of a batch are found at once. The table starts anew once it is a
    quarter full, since the next texts can bring as many words as they have characters."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.whole.encode_special_tokens = True
        self._forget()

    def _forget(self) -> None:
        self.slots = np.zeros(2 * CACHED_WORDS, np.uint64)
        self.rows = np.zeros(2 * CACHED_WORDS, np.int64)
        self.first, self.size = np.zeros(1, np.int64), np.zeros(1, np.int64)
        self.ids = np.empty(0, np.uint32)

    def _find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each key the slot that holds it, or else the free slot where its search ended."""
        at = (keys & np.uint64(len(self.slots) - 1)).astype(np.int64)
        missed = np.flatnonzero((self.slots[at] != keys) & (self.slots[at] != 0))
        while len(missed):
            at[missed] = (at[missed] + 1) % len(self.slots)
            held = self.slots[at[missed]]
            missed = missed[(held != keys[missed]) & (held != 0)]
        return at, self.slots[at] == keys

    def _learn(self, keys: np.ndarray, words: list[str]) -> None:
        """Add words under their keys, which are distinct and new."""
        new = [self.whole.encode(w, add_special_tokens=False).ids for w in words]
        sizes = np.fromiter(map(len, new), np.int64, len(new))
        rows = len(self.first) + np.arange(len(new))
        self.first = np.append(self.first, len(self.ids) + np.cumsum(sizes) - sizes)
        self.size = np.append(self.size, sizes)
        self.ids = np.concatenate([self.ids, np.array([i for ids in new for i in ids], np.uint32)])
        while len(keys):
            at, _ = self._find(keys)
            self.slots[at], self.rows[at] = keys, rows
            lost = self.slots[at] != keys
            keys, rows = keys[lost], rows[lost]

    def encode(self, texts: list[str]) -> Iterator[np.ndarray]:
        for start, stop in text.chunks(texts, CACHED_WORDS):
            yield from self._encode(texts[start:stop])

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        out: list[np.ndarray | None] = [
            np.array(self.whole.encode(t, add_special_tokens=False).ids, np.uint32)
            if "'" in t or len(t) > CACHED_WORDS
            else None
            for t in texts
        ]
        rest = [i for i, ids in enumerate(out) if ids is None]
        if not rest:
            return out
        laid = text.Laid([texts[i] for i in rest])
        starts = word_starts(laid)
        owner = laid.owner(starts)
        ends = np.minimum(np.append(starts[1:], len(laid.codes)), laid.ends[owner])
        keys = laid.hashes(starts, ends)
        if len(self.first) > CACHED_WORDS // 2:
            self._forget()
        unknown = np.flatnonzero(~self._find(keys)[1])
        if len(unknown):
            new, at = np.unique(keys[unknown], return_index=True)
            at = unknown[at]
            base = laid.starts[owner[at]]
            spans = zip(owner[at].tolist(), (starts[at] - base).tolist(), (ends[at] - base).tolist(), strict=True)
            self._learn(new, [texts[rest[o]][s:e] for o, s, e in spans])
        rows = self.rows[self._find(keys)[0]]
        lengths = self.size[rows]
        places = np.cumsum(lengths) - lengths
        ids = self.ids[np.repeat(self.first[rows] - places, lengths) + np.arange(lengths.sum())]
        counts = text.per_owner(lengths, owner, len(rest))
        for i, part in zip(rest, np.split(ids, np.cumsum(counts)[:-1]), strict=True):
            out[i] = part
        return out


def pieces(docs: DataFrame, vocabulary: str, length: int, end_id: int) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens``."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Tokens(vocabulary)  # the task's own, gone with it
        for batch in batches:
            rows = []
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), known.encode(texts), strict=True):
                data = np.append(ids, np.uint32(end_id)).astype("<u4").tobytes()
                total = len(data) // 4
                for start in range(0, total, length):
                    piece = data[4 * start : 4 * (start + length)]
                    rows.append((doc_id, start, len(piece) // 4, zlib.crc32(piece), total))
            columns = list(zip(*rows, strict=True)) or [[]] * 5
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)

    return in_batches(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), work, PIECES)


def shortest_pack_first(histogram: dict[int, int], length: int) -> list[tuple[int, list[int]]]:
    """Patterns ``(count, lengths)`` that hold exactly the histogram's pieces.

    ``held[n]`` are the open patterns that hold n ids so far. The shortest open pattern takes the
    next length if it has room; when there are fewer pieces than such patterns, the pattern is
    split into those that took one and those still open.
    """
    held: dict[int, list[tuple[int, list[int]]]] = {0: []}
    for size in sorted(histogram, reverse=True):
        left = histogram[size]
        while left:
            shortest = min((n for n, open_ in held.items() if open_), default=length)
            if shortest + size > length:
                # a new pattern is the shortest one until it is full
                fit = length // size
                for count, many in ((left // fit, fit), (1, left % fit)):
                    if count and many:
                        held.setdefault(size * many, []).append((count, [size] * many))
                break
            count, lengths = held[shortest].pop()
            taken = min(left, count)
            if taken < count:
                held[shortest].append((count - taken, lengths))
            held.setdefault(shortest + size, []).append((taken, [*lengths, size]))
            left -= taken
    return [pattern for n in sorted(held, reverse=True) for pattern in held[n]]


def slots(patterns: list[tuple[int, list[int]]]) -> dict[int, np.ndarray]:
    """For each length, columns ``first number, first sequence, pieces per sequence, first offset``,
    sorted by first number: where the pieces with these numbers go."""
    out: dict[int, list[tuple[int, int, int, int]]] = {}
    numbered: dict[int, int] = {}
    sequence = 0
    for count, lengths in patterns:
        offset = 0
        for size in dict.fromkeys(lengths):
            many = lengths.count(size)
            out.setdefault(size, []).append((numbered.get(size, 0), sequence, many, offset))
            numbered[size] = numbered.get(size, 0) + many * count
            offset += size * many
        sequence += count
    return {size: np.array(rows, np.int64) for size, rows in out.items()}


def pack(spark: SparkSession, docs: DataFrame, vocabulary: str, length: int = 1024, end_id: int = 0) -> DataFrame:
    """Pack ``doc_id, text`` into sequences of at most ``length`` ids; one row per piece."""
    cut = written(pieces(docs, vocabulary, length, end_id), "pieces")
    order = ["doc_id", "start", "ids_crc32", "doc_tokens"]
    sizes = written(cut.groupBy("length").agg(F.count("*").alias("all")), "lengths")
    table = slots(shortest_pack_first({r["length"]: r["all"] for r in sizes.collect()}, length))
    # at most ``length`` rows; a frequent length gets more blocks
    blocks = F.ceil(F.col("all") / PIECES_PER_BLOCK)
    dealt = (
        cut.join(F.broadcast(sizes), "length")
        .withColumn("block", F.pmod(F.xxhash64(*order), blocks))
        .select(*order, "length", "block")
    )
    counts = dealt.groupBy("length", "block").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    counts = written(counts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))), "counts")

    inside = Window.partitionBy("length", "block").orderBy(*order)
    numbered = (
        dealt.withColumn("inside", F.row_number().over(inside) - 1)
        .join(counts.drop("n"), ["length", "block"])
        .select(*order, "length", (F.col("before") + F.col("inside")).alias("number"))
    )

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column("length").to_numpy()
            numbers = batch.column("number").to_numpy()
            sequence, offset = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
            for size in np.unique(sizes):
                mine = np.flatnonzero(sizes == size)
                rows = table[int(size)]
                row = rows[np.searchsorted(rows[:, 0], numbers[mine], side="right") - 1]
                inner = numbers[mine] - row[:, 0]
                sequence[mine] = row[:, 1] + inner // row[:, 2]
                offset[mine] = row[:, 3] + inner % row[:, 2] * size
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), pa.array(sequence), pa.array(offset)],
                names=[*names, "sequence_id", "offset"],
            )

    return numbered.mapInArrow(place, f"{PIECES}, sequence_id long, offset long")
