"""Quality rules: a conditional random field labels lines as content or boilerplate.

``fit`` learns the labels of lines from a bounded sample of documents with a quality label (lines of
good documents count as content, those of poor ones as boilerplate; lines of both kinds that occur
in either are told apart by their features) and from a few fixed lines of web boilerplate.
``score`` decodes every line of every whole text with Viterbi; a document is kept if the words in
lines labelled content are at least ``least_content`` of its words and the base rules hold.

A word is ``[^\\x20\\x09-\\x0D]+``. NULL texts have no words and fail the base rules, as do empty
ones. Repeated rows are judged one by one; rows with NULL ids too. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoreline.llm import crf, text
from shoreline.llm.common import in_batches, kept_share

SYMBOLS = "#*$%&|<>"
WINDOW = 8
FEWEST_WORDS = 20
REPEATED_SHARE = 30

# Fixed lines of common web boilerplate, as seeds of the boilerplate label.
SEEDS = (
    "Home | About | Contact | Privacy",
    "Home > Products > Details",
    "Copyright 2024. All rights reserved.",
    "Click here to subscribe to our newsletter!",
    "Accept all cookies",
    "Share this: Facebook | Twitter | Email",
    "Log in | Register | Help",
    "Read more >>",
    "Terms of use | Privacy policy",
    "*** ADVERTISEMENT ***",
    "Page 1 2 3 4 5 Next >",
    "Menu | Search | Login",
)
SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
    "n_repeat_words long, base_failed boolean, kept boolean, content_share double"
)


class Lines:
    """Counts of a run of texts: per document the base numbers, per line the features."""

    def __init__(self, texts: list[str]):
        laid = text.Laid(texts)
        self.n = n = len(texts)
        blank = text.table("blank")[laid.codes]
        symbol = text.only(SYMBOLS)[laid.codes]
        word_starts, word_ends = laid.runs(~blank)
        word_owner = laid.owner(word_starts)
        line_starts, line_ends = laid.lines()
        self.owner = laid.owner(line_starts)
        self.lengths = np.bincount(self.owner, minlength=n)
        self.words = np.bincount(word_owner, minlength=n)
        self.word_chars = text.per_owner(word_ends - word_starts, word_owner, n)
        self.symbols = laid.count(symbol, laid.starts, laid.ends)

        at_start = np.zeros(len(laid.codes), bool)
        at_start[word_starts] = True
        self.line_words = laid.count(at_start, line_starts, line_ends)
        own = text.mix(np.arange(n, dtype=np.uint64))
        lines = laid.hashes(line_starts, line_ends) ^ own[self.owner]
        full = np.flatnonzero(self.line_words > 0)
        _, firsts = np.unique(lines[full], return_index=True)
        again = np.ones(len(full), bool)
        again[firsts] = False
        self.repeated_line = np.zeros(len(lines), bool)
        self.repeated_line[full[again]] = True
        self.dup_lines = np.bincount(self.owner[full[again]], minlength=n)

        hashes = laid.hashes(word_starts, word_ends)
        keys, begin = text.windows(hashes, word_owner, WINDOW)
        _, which, seen = np.unique(keys ^ own[word_owner[begin]], return_inverse=True, return_counts=True)
        covered = np.zeros(len(word_starts) + 1, np.int64)
        twice = begin[seen[which] > 1] if len(begin) else begin
        np.add.at(covered, twice, 1)
        np.add.at(covered, twice + WINDOW, -1)
        covered = np.cumsum(covered)[:-1] > 0
        self.repeat_words = np.bincount(word_owner[covered], minlength=n)

        def share(kind: np.ndarray, of: np.ndarray) -> np.ndarray:
            return laid.count(kind, line_starts, line_ends) / np.maximum(of, 1)

        chars = laid.count(~blank, line_starts, line_ends)
        letters = text.table("letter")[laid.codes]
        n_letters = laid.count(letters, line_starts, line_ends)
        last = laid.codes[np.maximum(line_ends - 1, line_starts)]
        first_word = np.searchsorted(word_starts, line_starts)
        neighbours = np.concatenate([[False], (hashes[1:] == hashes[:-1]) & (word_owner[1:] == word_owner[:-1])])
        same = np.concatenate([[0], np.cumsum(neighbours)])
        stop_word = np.minimum(first_word + self.line_words, len(word_starts))
        stutter = (same[stop_word] - same[np.minimum(first_word, len(word_starts))]) / np.maximum(self.line_words, 1)
        bits = [
            np.ones(len(lines), bool),
            self.line_words == 0,
            (self.line_words > 0) & (self.line_words < 4),
            (self.line_words >= 4) & (self.line_words < 10),
            self.line_words >= 10,
            *binned(share(symbol, chars), (0.005, 0.03, 0.1)),
            *binned(share(text.only("!")[laid.codes], chars), (0.01, 0.05, 0.1)),
            *binned(share(text.table("upper")[laid.codes], n_letters), (0.3, 0.6, 0.9)),
            *binned(share(text.table("digit")[laid.codes], chars), (0.2, 0.5)),
            *binned(n_letters / np.maximum(chars, 1), (0.4, 0.7, 0.9)),
            *binned(stutter, (0.1, 0.3, 0.6)),
            np.isin(last, [ord(c) for c in ".!?\"'…"]),
            self.repeated_line,
        ]
        self.features = np.stack(bits, 1).astype(np.float64)


def binned(values: np.ndarray, limits: tuple[float, ...]) -> list[np.ndarray]:
    """One truth value per limit that is reached."""
    return [values >= limit for limit in limits]


def fit(docs: DataFrame, labels: DataFrame, sample: int = 1000) -> crf.Chain:
    """Learn from about ``sample`` labelled documents of each quality, chosen by a hash of the id.

    At most 64 lines, spread evenly, of a document enter the training sequences; this bounds what the driver holds.
    """
    known = labels.where("quality IN (0, 1) AND doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.min("quality").alias("quality")
    )
    counts = {r["quality"]: r["count"] for r in known.groupBy("quality").count().collect()}
    rate = F.when(F.col("quality") == 1, sample / max(1, counts.get(1, 0))).otherwise(
        sample / max(1, counts.get(0, 0))
    )
    chosen = known.where(kept_share(F.col("doc_id")) < rate)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            qualities = batch.column("quality").to_pylist()
            for start, stop in text.chunks(texts):
                found = Lines(texts[start:stop])
                rows = []
                for features, quality in zip(
                    np.split(found.features, np.cumsum(found.lengths)[:-1]), qualities[start:stop], strict=True
                ):
                    picked = features[np.unique(np.linspace(0, len(features) - 1, min(64, len(features))).astype(int))]
                    rows.append((np.packbits(picked.astype(bool)).tobytes(), len(picked), int(quality)))
                columns = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, (pa.binary(), pa.int32(), pa.int32()), strict=True)],
                    names=["bits", "lines", "quality"],
                )

    joined = (
        docs.select("doc_id", F.col("text").cast("string"))
        .where("text IS NOT NULL")
        .join(F.broadcast(chosen), "doc_id")
        .select("text", "quality")
    )
    rows = in_batches(joined, work, "bits binary, lines int, quality int").collect()
    seeds = Lines(list(SEEDS))
    width = seeds.features.shape[1]
    features = [
        np.unpackbits(np.frombuffer(r["bits"], np.uint8), count=r["lines"] * width).reshape(-1, width) for r in rows
    ]
    answers = [np.full(r["lines"], 1 - r["quality"], np.int8) for r in rows]
    if not any(r["quality"] == 1 for r in rows):  # nothing good to learn from: plain prose stands in
        plain = Lines(["This is a sentence of plain prose that tells the reader something of interest."] * len(SEEDS))
        features.append(plain.features)
        answers.append(np.zeros(len(SEEDS), np.int8))
    for _ in range(max(1, len(rows) // (20 * len(SEEDS)))):
        features.append(seeds.features)
        answers.append(np.ones(len(SEEDS), np.int8))
    lengths = np.array([len(a) for a in answers], np.int64)
    return crf.fit(np.concatenate(features).astype(np.float64), np.concatenate(answers), lengths)


def score(docs: DataFrame, chain: crf.Chain, least_content: float = 0.5) -> DataFrame:
    """One row per document: the base numbers, the share of words in content lines, the verdict."""
    weights, steps = chain.weights, chain.steps

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = crf.Chain(weights, steps)
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            ids = batch.column("doc_id")
            for start, stop in text.chunks(texts):
                found = Lines(texts[start:stop])
                content = model.decode(found.features, found.lengths) == 0
                good = text.per_owner(np.where(content, found.line_words, 0), found.owner, found.n)
                share = good / np.maximum(found.words, 1)
                failed = (found.words < FEWEST_WORDS) | (100 * found.repeat_words > REPEATED_SHARE * found.words)
                numbers = (found.words, found.word_chars, found.symbols, found.dup_lines, found.repeat_words)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(start, stop - start),
                        *(pa.array(x.astype(np.int64)) for x in numbers),
                        pa.array(failed),
                        pa.array(~failed & (share >= least_content)),
                        pa.array(share),
                    ],
                    names=[c.split()[0] for c in SCHEMA.split(", ")],
                )

    return in_batches(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), work, SCHEMA)


def judge(spark: SparkSession, docs: DataFrame, labels: DataFrame, sample: int = 1000) -> DataFrame:
    return score(docs, fit(docs, labels, sample))
