"""Language identification: nearest of several centroids per language, by cosine of TF-IDF vectors.

A text's vector counts its letter 1-, 2- and 3-grams (words bounded by blanks) in ``DIMENSIONS``
hashed places; counts are damped by a logarithm, weighted by inverse document frequency and scaled
to length 1. Document frequencies come from all rows to learn from; the centroids of each language
(spherical k-means) from a bounded sample of them.

A text belongs to the language of its nearest centroid. It is rejected when it is farther from it
than learning texts of similar length are: each band of lengths has its own limit, since short
texts have few n-grams and lie far from everything. What short texts are like is learned from
windows cut out of the learning texts, as few of these may be short themselves.

NULL texts and texts without a letter are ``und`` with score 0, and rejected. Ties go to the first
language in alphabetical order. NULL ids are never learned from. If there is nothing to learn from,
every text is ``und``. Repeated rows are predicted one by one, other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoreline.llm import text
from shoreline.llm.common import fold, in_batches, kept_share

BITS = 12
DIMENSIONS = 1 << BITS
TEXTS = 64
SPANS = (2, 3, 5, 8, 12, 18, 27, 40, 60, 90, 130, 190, 280)
SCHEMA = "doc_id long, lang_pred string, score double, rejected boolean"


@dataclass(frozen=True)
class Model:
    languages: list[str]
    idf: np.ndarray
    centroids: np.ndarray  # one row each, of unit length
    language_of: np.ndarray  # number of each centroid's language
    limits: np.ndarray  # least cosine by band of lengths


def counts(texts: list[str]) -> np.ndarray:
    """N-gram counts of each text, one row per text. Rows without a letter are all zero."""
    laid = text.Laid([t.lower() for t in texts])
    letter = text.table("letter")[laid.codes]
    # 0 stands for any run of other characters: only the first of a run is looked at
    begin = np.concatenate([[True], letter[:-1]]) | letter
    codes = np.where(letter, laid.codes, 0)[begin].astype(np.uint64)
    owner = laid.owner(np.flatnonzero(begin))
    real = codes > 0
    n = len(codes)
    one = text.mix(codes + np.uint64(1))
    places, owners = [], []

    def add(hashes: np.ndarray, chosen: np.ndarray, at: np.ndarray) -> None:
        places.append((hashes[chosen] >> np.uint64(64 - BITS)).astype(np.int64))
        owners.append(at[chosen])

    add(one, real, owner)
    if n > 1:
        two = text.mix(one[:-1] * np.uint64(3) + one[1:])
        add(two, (real[:-1] | real[1:]) & (owner[:-1] == owner[1:]), owner[:-1])
    if n > 2:
        three = text.mix(one[:-2] * np.uint64(7) + one[1:-1] * np.uint64(5) + one[2:])
        add(three, real[1:-1] & (owner[:-2] == owner[2:]), owner[:-2])
    flat = np.concatenate(owners) * DIMENSIONS + np.concatenate(places)
    return np.bincount(flat, minlength=len(texts) * DIMENSIONS).reshape(len(texts), DIMENSIONS).astype(np.float32)


def vectors(found: np.ndarray, idf: np.ndarray) -> np.ndarray:
    weighted = np.log1p(found) * idf
    return weighted / np.maximum(np.linalg.norm(weighted, axis=1, keepdims=True), 1e-12)


def runs(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Bounds of runs of texts, short enough for a dense matrix of their counts."""
    for start, stop in text.chunks(texts, 1 << 17):
        for at in range(start, stop, TEXTS):
            yield at, min(at + TEXTS, stop)


def windows(whole: str) -> list[str]:
    """Three pieces of the text, of lengths and from a place that its hash chooses."""
    number = zlib.crc32(whole.encode("utf-8", "surrogatepass"))
    spans = [SPANS[(number + 4 * i) % len(SPANS)] for i in range(3)]
    starts = [(number // len(SPANS)) % max(1, len(whole) - span + 1) for span in spans]
    return [whole[at : at + span] for at, span in zip(starts, spans, strict=True) if span < len(whole)]


def band(found: np.ndarray) -> np.ndarray:
    """Band of lengths: the binary logarithm of the number of n-grams."""
    return np.log2(1 + found.sum(1)).astype(np.int64)


def cluster(points: np.ndarray, many: int, rounds: int = 20) -> np.ndarray:
    """Spherical k-means; starts from points far from those already chosen."""
    chosen = [0]
    nearest = points @ points[0]
    while len(chosen) < min(many, len(points)):
        chosen.append(int(nearest.argmin()))
        nearest = np.maximum(nearest, points @ points[chosen[-1]])
    centroids = points[chosen]
    for _ in range(rounds):
        mine = (points @ centroids.T).argmax(1)
        sums = np.stack([points[mine == c].sum(0) for c in range(len(centroids))])
        norms = np.linalg.norm(sums, axis=1, keepdims=True)
        centroids = np.where(norms > 0, sums / np.maximum(norms, 1e-12), centroids)
    return centroids


def fit(docs: DataFrame, learn_from=None, per_language: int = 400, most: int = 8000, clusters: int = 4) -> Model:
    """Learn from rows with ``text`` and ``lang``.

    The centroids use about ``per_language`` documents of each language and about ``most`` in all,
    chosen by a hash of the text.
    """
    learn_from = F.coalesce(fold("doc_id", 3) != 1, F.lit(False)) if learn_from is None else learn_from
    rows = docs.where(learn_from).select(F.col("text").cast("string"), F.col("lang").cast("string")).dropna()
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().orderBy("lang").collect()}
    languages = list(sizes)
    if not languages:
        empty = np.empty((0, DIMENSIONS), np.float32)
        return Model([], np.ones(DIMENSIONS, np.float32), empty, np.empty(0, np.int64), np.zeros(64))

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(DIMENSIONS + 1, np.int64)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for start, stop in runs(texts):
                total[:-1] += (counts(texts[start:stop]) > 0).sum(0)
                total[-1] += stop - start
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(DIMENSIONS + 1)), pa.array(total)], names=["place", "n"]
        )

    summed = in_batches(rows.select("text"), frequencies, "place long, n long").groupBy("place").agg(F.sum("n").alias("n"))
    seen = np.zeros(DIMENSIONS + 1)
    for r in summed.collect():
        seen[r["place"]] = r["n"]
    idf = np.log((1 + seen[-1]) / (1 + seen[:-1])).astype(np.float32) + 1

    each = min(per_language, max(1, most // len(languages)))
    rates = F.lit(1.0)
    for language, size in sizes.items():
        rates = F.when(F.col("lang") == language, each / size).otherwise(rates)

    def sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, langs = batch.column("text").to_pylist(), batch.column("lang").to_pylist()
            cut = [(piece, lang) for whole, lang in zip(texts, langs, strict=True) for piece in windows(whole)]
            pieces = [piece for piece, _ in cut]
            for whole, some, names in ((True, texts, langs), (False, pieces, [lang for _, lang in cut])):
                for start, stop in runs(some):
                    packed = []
                    for row in counts(some[start:stop]):
                        places = np.flatnonzero(row)
                        packed.append(places.astype("<u2").tobytes() + row[places].astype("<f4").tobytes())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(names[start:stop]), pa.array(packed, pa.binary()), pa.array([whole] * len(packed))],
                        names=["lang", "packed", "whole"],
                    )

    def dense(packed: list[bytes]) -> np.ndarray:
        found = np.zeros((len(packed), DIMENSIONS), np.float32)
        for i, row in enumerate(packed):
            n = len(row) // 6
            found[i, np.frombuffer(row, "<u2", n)] = np.frombuffer(row, "<f4", n, 2 * n)
        return found

    sample = in_batches(rows.where(kept_share(F.col("text")) < rates), sparse, "lang string, packed binary, whole boolean")
    sample = sorted(sample.collect(), key=lambda r: (r["lang"], r["packed"]))
    cut = [bytes(r["packed"]) for r in sample if not r["whole"] and r["packed"]]
    sample = [r for r in sample if r["whole"]]
    found = dense([r["packed"] for r in sample])
    number = np.array([languages.index(r["lang"]) for r in sample], np.int64)
    points = vectors(found, idf)
    full = found.any(1)
    centroids, language_of = [], []
    for i in range(len(languages)):
        mine = points[(number == i) & full]
        if len(mine):
            centroids.append(cluster(mine, clusters))
            language_of += [i] * len(centroids[-1])
    if not centroids:
        return Model([], idf, np.empty((0, DIMENSIONS), np.float32), np.empty(0, np.int64), np.zeros(64))
    centroids = np.concatenate(centroids)
    near = (points[full] @ centroids.T).max(1)
    cut_near, cut_bands = [np.empty(0)], [np.empty(0, np.int64)]
    for at in range(0, len(cut), TEXTS):
        pieces = dense(cut[at : at + TEXTS])
        cut_near.append((vectors(pieces, idf) @ centroids.T).max(1))
        cut_bands.append(band(pieces))
    limits = _limits(near, band(found[full]), np.concatenate(cut_near), np.concatenate(cut_bands))
    return Model(languages, idf, centroids, np.array(language_of), limits)


def _limits(
    near: np.ndarray, bands: np.ndarray, cut_near: np.ndarray, cut_bands: np.ndarray, slack: float = 6.0
) -> np.ndarray:
    """Least cosine of each band of lengths: ``slack`` deviations below its mean, or well below nearly
    all windows of that length where that is more, but always well below any of its learning texts,
    so that no text like them is turned away. Bands with few learning texts go by their windows, and
    with few of these, too, take the limit of the next shorter one (0 if there is none); none has more
    than a longer one."""
    limits = np.zeros(64)
    for b in range(64):
        mine, cut = near[bands == b], cut_near[cut_bands == b]
        least = 0.8 * np.quantile(cut, 0.001) if len(cut) >= 10 else 0.0
        if len(mine) >= 10:
            limits[b] = min(max(least, mine.mean() - slack * max(mine.std(), 0.01)), 0.8 * mine.min())
        elif len(cut) >= 10:
            limits[b] = least
        elif b:
            limits[b] = limits[b - 1]
    return np.minimum.accumulate(limits[::-1])[::-1]


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, lang_pred, score, rejected`` of every row, from the text alone."""
    names, idf, centroids, language_of, limits = (
        model.languages, model.idf, model.centroids, model.language_of, model.limits,
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield label(batch, "text", names, idf, centroids, language_of, limits)

    return in_batches(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), work, SCHEMA)


def accepted(docs: DataFrame, model: Model) -> DataFrame:
    """The rows that are not rejected, with all their columns."""
    names, idf, centroids, language_of, limits = (
        model.languages, model.idf, model.centroids, model.language_of, model.limits,
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = label(batch, "text", names, idf, centroids, language_of, limits)
            yield batch.filter(pc.invert(found.column("rejected")))

    return in_batches(docs, work, docs.schema)


def label(batch, column, names, idf, centroids, language_of, limits) -> pa.RecordBatch:
    texts = [t or "" for t in batch.column(column).to_pylist()]
    languages, scores, rejected = [], [], []
    for start, stop in runs(texts):
        found = counts(texts[start:stop])
        if len(centroids):
            near = vectors(found, idf) @ centroids.T
            best, cosine = near.argmax(1), near.max(1)
            known = found.any(1)
            languages += [names[language_of[b]] if k else "und" for b, k in zip(best, known, strict=True)]
            scores.append(np.where(known, np.clip(cosine, 0, 1), 0).astype(np.float64))
            rejected.append(~known | (cosine < limits[band(found)]))
        else:
            languages += ["und"] * len(found)
            scores.append(np.zeros(len(found)))
            rejected.append(np.ones(len(found), bool))
    return pa.RecordBatch.from_arrays(
        [
            batch.column("doc_id"),
            pa.array(languages, pa.string()),
            pa.array(np.concatenate([*scores, np.empty(0)])),
            pa.array(np.concatenate([*rejected, np.empty(0, bool)])),
        ],
        names=["doc_id", "lang_pred", "score", "rejected"],
    )
