"""Toxicity: a counterfactually regularised linear classifier on the words of whole texts.

``fit`` takes a bounded sample of labelled documents. Words, and beginnings of words (which stand
for their derived forms), whose presence differs between the two labels become the vocabulary, together with all identity terms. Weights are fitted by logistic loss
with an L1 penalty. Besides, every labelled text with an identity term is paired with copies in
which another term of the same kind, or a neutral word, stands in its place, and the squared change
of the score between the two is penalised. So a group's mention moves no score by itself, however
the terms are spread over the labels in the sample. A term in more texts makes more pairs, by the
logarithm of their number, which bounds the pairs.

``score`` reads whole texts. NULL and empty texts have no words and get the score of the bias.
NULL labels are left out; a document labelled twice counts as toxic if any label says so. Several
rows of one id are all scored, and learned from once per different text. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoreline.llm import text
from shoreline.llm.common import fold, in_batches, kept_share, written

# Identity terms by kind; the last of each kind is its neutral word.
IDENTITY = {
    "faith": "muslim christian jewish hindu buddhist sikh atheist catholic protestant believer".split(),
    "faiths": "muslims christians jews hindus buddhists sikhs atheists catholics protestants believers".split(),
    "origin": "african american asian european latino arab chinese indian mexican russian turkish local".split(),
    "colour": "black white brown coloured".split(),
    "gender": "woman man girl boy transgender nonbinary person".split(),
    "genders": "women men girls boys people".split(),
    "love": "gay lesbian bisexual straight queer heterosexual homosexual married".split(),
    "body": "disabled blind deaf autistic old young elderly healthy".split(),
    "status": "immigrant refugee foreigner migrant native citizen".split(),
    "de": "frau mann muslim christ jude ausländer flüchtling schwuler lesbe mensch".split(),
    "fr": "femme homme musulman chrétien juif étranger immigré gay lesbienne personne".split(),
    "es": "mujer hombre musulmán cristiano judío extranjero inmigrante gay lesbiana persona".split(),
}
BEGINNINGS = (3, 5, 7)
SCHEMA = "doc_id long, score double, predicted int"


@dataclass(frozen=True)
class Model:
    """Sorted word hashes, their weights, and the bias."""

    words: np.ndarray
    weights: np.ndarray
    bias: float


def word_hashes(words: list[str]) -> np.ndarray:
    laid = text.Laid(words)
    return laid.hashes(laid.starts, laid.ends)


@cache
def sorted_terms() -> np.ndarray:
    return np.unique(kinds()[0])


def marks(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All words of the texts, and the beginnings of longer ones, as (text, hash).

    Identity terms stand for themselves alone, so that a swap changes one mark.
    """
    laid = text.Laid([t.casefold() for t in texts])
    starts, ends = laid.words()
    owner = laid.owner(starts)
    words, terms = laid.hashes(starts, ends), sorted_terms()
    other = terms[np.minimum(np.searchsorted(terms, words), len(terms) - 1)] != words
    hashes, owners = [words], [owner]
    for size in BEGINNINGS:
        longer = (ends - starts > size) & other
        begin = starts[longer]
        hashes.append(text.mix(laid.hashes(begin, begin + size) + np.uint64(size)))
        owners.append(owner[longer])
    return np.concatenate(owners), np.concatenate(hashes)


def present(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Each text's distinct marks, sorted by text."""
    owner, hashes = marks(texts)
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    return owner[new], hashes[new]


def kinds() -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the identity terms and the number of each one's kind."""
    terms = [(w.casefold(), k) for k, words in enumerate(IDENTITY.values()) for w in words]
    return word_hashes([w for w, _ in terms]), np.array([k for _, k in terms])


def train(
    rows: np.ndarray, columns: np.ndarray, labels: np.ndarray, size: int, swaps: list[tuple[int, int]],
    rounds: int = 150, ridge: float = 1e-4, lasso: float = 3e-4, fairness: float = 5.0,
) -> tuple[np.ndarray, float]:
    """Weights and bias by accelerated proximal gradient.

    ``swaps`` are word pairs (out, in), one for each swapped sentence: as the score is linear, the
    change it makes is the difference of the two weights.
    """
    n = len(labels)
    weights, bias = np.zeros(size), 0.0
    ahead, ahead_bias, speed = weights, bias, 1.0
    share = np.where(labels == 1, 0.5 / max(1, labels.sum()), 0.5 / max(1, (1 - labels).sum()))
    pairs = np.array(swaps, np.int64).reshape(-1, 2)
    per_doc = np.bincount(rows, minlength=n).mean() + 1
    rate = 1 / (0.25 * per_doc + ridge + (4 * fairness if len(pairs) else 0))
    for _ in range(rounds):
        scores = np.bincount(rows, weights=ahead[columns], minlength=n) + ahead_bias
        miss = (1 / (1 + np.exp(-np.clip(scores, -40, 40))) - labels) * share
        slope = np.bincount(columns, weights=miss[rows], minlength=size) + ridge * ahead
        if len(pairs):
            change = fairness * (ahead[pairs[:, 0]] - ahead[pairs[:, 1]]) / len(pairs)
            slope += np.bincount(pairs[:, 0], weights=change, minlength=size)
            slope -= np.bincount(pairs[:, 1], weights=change, minlength=size)
        stepped = ahead - rate * slope
        new = np.sign(stepped) * np.maximum(np.abs(stepped) - rate * lasso, 0)
        new_bias = ahead_bias - rate * miss.sum()
        faster = (1 + np.sqrt(1 + 4 * speed**2)) / 2
        ahead = new + (speed - 1) / faster * (new - weights)
        ahead_bias = new_bias + (speed - 1) / faster * (new_bias - bias)
        weights, bias, speed = new, new_bias, faster
    return weights, float(bias)


def labelled(docs: DataFrame, labels: DataFrame, learn_from, sample: int) -> DataFrame:
    """A bounded sample of labelled documents as ``id, toxic, words`` (distinct hashes)."""
    known = (
        labels.where("toxic IN (0, 1) AND doc_id IS NOT NULL")
        .where(learn_from)
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.max("toxic").alias("toxic"))
    )
    counts = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    half = sample / 2
    rate = F.when(F.col("toxic") == 1, half / max(1, counts.get(1, 0))).otherwise(half / max(1, counts.get(0, 0)))
    chosen = known.where(kept_share(F.col("doc_id")) < rate)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for start, stop in text.chunks(texts):
                owner, hashes = present(texts[start:stop])
                cuts = np.searchsorted(owner, np.arange(stop - start + 1))
                words = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(hashes.view(np.int64)))
                part = batch.slice(start, stop - start)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("toxic"), words], names=["id", "toxic", "words"]
                )

    joined = (
        docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
        .where("text IS NOT NULL")
        .join(F.broadcast(chosen), "doc_id")
        .select("doc_id", "text", F.col("toxic").cast("int"))
    )
    return in_batches(joined, work, "id long, toxic int, words array<long>").dropDuplicates(["id", "words"])


def fit(
    docs: DataFrame, labels: DataFrame, learn_from=None, sample: int = 12_000, vocabulary: int = 4096,
    fewest: int = 4,
) -> Model:
    """Learn from about ``sample`` labelled documents, half of them toxic if there are so many.

    The driver holds the ``vocabulary`` words whose presence tells most about the label (by the
    normal score of the difference in shares, among words in at least ``fewest`` documents), and
    for each sampled document which of them it has.
    """
    learn_from = F.coalesce(fold("doc_id", 5) != 0, F.lit(False)) if learn_from is None else learn_from
    rows = written(labelled(docs, labels, learn_from, sample), "toxicity")
    totals = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    bad, good = totals.get(1, 0), totals.get(0, 0)
    terms, kind = kinds()
    if not bad or not good:
        return Model(np.empty(0, np.uint64), np.empty(0), -4.0 if good or not bad else 4.0)
    rate = (F.col("bad") + F.col("good")) / (bad + good)
    counted = (
        rows.select("toxic", F.explode("words").alias("word"))
        .groupBy("word")
        .agg(F.sum("toxic").alias("bad"), F.sum(1 - F.col("toxic")).alias("good"))
        .where(F.col("bad") + F.col("good") >= fewest)
        .withColumn(
            "tells",
            F.abs(F.col("bad") / bad - F.col("good") / good) / F.sqrt(rate * (1 - rate) * (1 / bad + 1 / good) + 1e-9),
        )
    )
    best = counted.orderBy(F.desc("tells"), "word").limit(vocabulary).select("word")
    listed = np.array([r["word"] for r in best.collect()], np.int64).view(np.uint64)
    words = np.union1d(listed, terms)

    known = words.view(np.int64)

    def narrow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sorted_words = known.view(np.uint64)
        for batch in batches:
            held = batch.column("words")
            values = held.flatten().to_numpy().view(np.uint64)
            places = np.minimum(np.searchsorted(sorted_words, values), len(sorted_words) - 1)
            hit = sorted_words[places] == values
            sums = np.concatenate([[0], np.cumsum(hit)])
            offsets = np.concatenate([[0], np.cumsum(held.value_lengths().to_numpy())])
            cuts = pa.array(sums[offsets], pa.int32())
            lists = pa.ListArray.from_arrays(cuts, pa.array(places[hit], pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), lists], names=["toxic", "places"])

    sampled = rows.select("toxic", "words").mapInArrow(narrow, "toxic int, places array<int>").collect()
    answers = np.array([r["toxic"] for r in sampled], np.int64)
    sizes = [len(r["places"]) for r in sampled]
    columns = np.array([p for r in sampled for p in r["places"]], np.int64)
    doc = np.repeat(np.arange(len(sampled)), sizes)

    places = np.searchsorted(words, terms)
    kind_of = dict(zip(places.tolist(), kind.tolist(), strict=True))
    members = {k: places[kind == k].tolist() for k in set(kind.tolist())}
    mentions = np.bincount(columns[np.isin(columns, places)], minlength=len(words))
    swaps = [
        (int(old), new)
        for old in np.flatnonzero(mentions)
        for new in members[kind_of[int(old)]]
        if new != old
        for _ in range(int(min(mentions[old], 1 + np.log2(mentions[old]) * 8)))
    ]
    weights, bias = train(doc, columns, answers, len(words), swaps)
    used = np.flatnonzero(weights)
    return Model(words[used], weights[used], bias)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, score, predicted`` of every row; the score needs nothing but the text."""
    words, weights, bias = model.words.view(np.int64), model.weights, model.bias

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = words.view(np.uint64)
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            ids = batch.column("doc_id")
            for start, stop in text.chunks(texts):
                logit = np.full(stop - start, bias)
                if len(known):
                    owner, hashes = marks(texts[start:stop])
                    places = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
                    hit = np.flatnonzero(known[places] == hashes)
                    pairs = np.unique(owner[hit] * len(known) + places[hit])
                    logit += np.bincount(pairs // len(known), weights=weights[pairs % len(known)], minlength=stop - start)
                chance = 1 / (1 + np.exp(-np.clip(logit, -40, 40)))
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(start, stop - start), pa.array(chance), pa.array((chance >= 0.5).astype(np.int32))],
                    names=["doc_id", "score", "predicted"],
                )

    return in_batches(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), work, SCHEMA)
