"""Lexical search: kernels against regular expressions, ranking against a literal version."""

import math
import re
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from shoreline.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    lower = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})
    return TERM.findall((text or "").translate(lower))


def literal(docs, items, k=10):
    counted = [(d, Counter(terms(t))) for d, t in docs]
    counted = [(d, c) for d, c in counted if c]
    n_docs, length = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(w for _, c in counted for w in c)
    out = []
    for item, text in items:
        scores = []
        for doc, c in counted:
            m = 100 - 75 + (75 * sum(c.values()) * n_docs) // length
            w = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) for t in terms(text)}
            score = sum(w[t] * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in terms(text) if t in c)
            if score > 0:
                scores.append((-score, doc is None, doc or 0, doc))
        out += [(item, i + 1, doc, -s) for i, (s, _, _, doc) in enumerate(sorted(scores)[:k])]
    return Counter(out)


def found(spark, docs, items, **kw):
    items = spark.createDataFrame(items, "item_id long, text string, rank string, score string")
    return Counter(tuple(r) for r in lexical.search(spark, docs, items, **kw).collect())


def wide(items):
    return [(*i, "clash", None) for i in items]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("aB é.Ж0", max_size=30), min_size=1, max_size=6), st.integers(3, 40))
def test_counts_of_any_window(texts, window):
    vocabulary = sorted({t for text in texts[::2] for t in terms(text)})
    known = lexical.Terms([t.encode() for t in vocabulary])
    before, lexical.WINDOW = lexical.WINDOW, window
    try:
        n, doc, term, tf = known.counts([lexical.folded(t.encode()) for t in texts])
    finally:
        lexical.WINDOW = before
    assert n.tolist() == [len(terms(t)) for t in texts]
    got = {(d, vocabulary[t]): c for d, t, c in zip(doc.tolist(), term.tolist(), tf.tolist(), strict=True)}
    want = {(i, w): c for i, t in enumerate(texts) for w, c in Counter(terms(t)).items() if w in vocabulary}
    assert got == want


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 2), st.integers(1, 4), st.integers(0, 9)), max_size=60), st.integers(1, 4))
def test_best_keeps_the_best(offers, k):
    best = lexical.Best(3, k)
    for item, score, doc in offers:
        best.offer(*(np.array([x]) for x in (item, score, 0, doc)))
        if doc % 3 == 0:
            best.settle()
    want = [sorted((i, -s, 0, d) for i, s, d in offers if i == item)[:k] for item in range(3)]
    assert [tuple(r) for r in best.settle().tolist()] == [r for rows in want for r in rows]


def test_against_literal(spark, documents):
    words = ["alpha", "Beta", "gamma", "été", "ÉTÉ", "x1", "数据", "the"]
    rng = np.random.default_rng(1)
    texts = [" ".join(rng.choice(words, rng.integers(0, 12))) for _ in range(300)]
    docs = list(enumerate(texts)) + [(1000 + i, "alpha beta, gamma!") for i in range(40)]
    docs += [(None, "alpha beta"), (None, None), (7, texts[7]), (2000, "..."), (2001, "the " * 300_000 + "x1")]
    items = wide([(1, "alpha the alpha"), (2, "ÉTÉ unseen"), (2, "ÉTÉ unseen"), (3, None), (4, "--"), (None, "gamma 数据")])
    got = found(spark, documents(*docs).repartition(5), items)
    assert got == literal(docs, [i[:2] for i in items])


def test_blocks_of_items_change_nothing(spark, documents, monkeypatch):
    docs = documents(*[(i, f"term{i % 7} term{i % 11} common") for i in range(200)])
    items = wide([(i, f"term{i} common term{i + 1}") for i in range(9)])
    one = found(spark, docs, items, k=3)
    monkeypatch.setattr(lexical, "BLOCK_ITEMS", 2)
    assert found(spark, docs, items, k=3) == one


def test_awkward_and_empty(spark, awkward):
    docs = [(r["doc_id"], r["text"]) for r in awkward.collect()]
    items = wide([(1, "line word5 passage"), (2, "")])
    assert found(spark, awkward, items) == literal(docs, [i[:2] for i in items])
    assert not found(spark, awkward.limit(0), items)
    assert not found(spark, awkward, [])
