import re
from collections import Counter

import numpy as np
import pytest

from shoreline.llm import crf, linequality, registry


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {i + k for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for k in range(8)}
    seen, repeated = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            repeated += line in seen
            seen.add(line)
    failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), repeated, len(covered), failed


def test_base_numbers_equal_brute_force(spark, awkward):
    chain = crf.Chain(np.zeros((len(linequality.Lines([""]).features[0]), 2)), np.zeros((2, 2)))
    extra = ["x\n" * 30, "a b c d e f g h " * 5, "   　word\x85 ", "same line here\nother\nsame line here\n"]
    docs = awkward.select("doc_id", "text").unionByName(spark.createDataFrame([(100 + i, t) for i, t in enumerate(extra)], "doc_id bigint, text string"))
    got = linequality.score(docs, chain).collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert len(got) == docs.count()
    for r in got:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute(texts[r.doc_id])
        assert not (r.base_failed and r.kept)


def test_viterbi_equals_trying_all_labellings():
    rng = np.random.default_rng(0)
    features, chain = rng.normal(size=(6, 3)), crf.Chain(rng.normal(size=(3, 2)), rng.normal(size=(2, 2)))
    lengths = np.array([4, 0, 2])
    got = chain.decode(features, lengths)

    def best(rows):
        scores = rows @ chain.weights
        def value(bits):
            return sum(scores[i, b] for i, b in enumerate(bits)) + sum(chain.steps[a, b] for a, b in zip(bits, bits[1:]))
        return max(([(n >> i) & 1 for i in range(len(rows))] for n in range(2 ** len(rows))), key=value)

    assert got.tolist() == [*best(features[:4]), *best(features[4:])]


def test_fit_learns_runs():
    rng = np.random.default_rng(1)
    labels = np.repeat(rng.integers(0, 2, 60), 5)
    seen = np.where(rng.random(300) < 0.8, labels, 1 - labels)
    features = np.stack([np.ones(300), seen], 1)
    chain = crf.fit(features, labels, np.full(10, 30))
    decoded = chain.decode(features, np.full(10, 30))
    assert (decoded == labels).mean() > (seen == labels).mean()


def test_poor_lines_are_told_from_good_ones(spark):
    from llm.conftest import SF

    got = registry.op6_line_quality(spark, SF)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    judged = got.where("NOT base_failed").join(labels, "doc_id").groupBy("quality").agg({"kept": "count", "content_share": "avg"}).collect()
    kept = got.where("NOT base_failed").join(labels, "doc_id").where("kept = (quality = 1)").count()
    assert kept >= 0.95 * sum(r["count(kept)"] for r in judged)


@pytest.mark.parametrize("rows", [0, 3])
def test_few_or_no_labels(spark, documents, rows):
    docs = documents(*[(i, "A good sentence with some words. " * 5) for i in range(5)])
    labels = spark.createDataFrame([(i, None if i else 1) for i in range(rows)], "doc_id bigint, quality int")
    assert linequality.judge(spark, docs, labels).count() == 5
    assert linequality.judge(spark, docs.limit(0), labels).count() == 0
