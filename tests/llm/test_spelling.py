"""Spelling variants: the index against edit distance, the query against a literal version."""

import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from shoreline.llm import registry, spelling
from llm.conftest import SF


def neighbours(word, letters):
    out = {word[:i] + word[i + 1 :] for i in range(len(word))}
    for i in range(len(word) + 1):
        out |= {word[:i] + c + word[i:] for c in letters}
        out |= {word[:i] + c + word[i + 1 :] for c in letters if i < len(word)}
    return out - {word}


def literal_near(counts):
    letters = {c for w in counts for c in w}
    return {w: sorted(neighbours(w, letters) & counts.keys()) for w in counts}


def literal_counts(docs):
    counts = Counter()
    for doc_id, text in docs:
        lower = (text or "").translate(str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}))
        for run in re.findall("[A-Za-zÀ-ÿ]+", lower):
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def literal(counts):
    near = literal_near(counts)
    form = {}
    for w, n in counts.items():
        best = min(near[w], key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= 2 * n else None
    out = set()
    for w, n in counts.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, n, len(near[w]), form[w], counts.get(form[w]), root))
    return out


def rows(df):
    got = [(r["word"], r["n"], r["n_near"], r["form"], r["form_n"], r["root"]) for r in df.collect()]
    assert len(got) == len(set(got))
    return set(got)


@settings(max_examples=200, deadline=None)
@given(st.sets(st.text("abé", min_size=5, max_size=9), min_size=1, max_size=60), st.sampled_from([1, 7, 20_000]))
def test_both_halves_find_all_near_words(words, together):
    words = sorted(words)
    before, spelling.TOGETHER = spelling.TOGETHER, together
    try:
        got = set()
        for backward in (False, True):
            query, word = spelling.near_words(words, words, backward)
            got |= set(zip(query.tolist(), word.tolist(), strict=True))
    finally:
        spelling.TOGETHER = before
    want = literal_near(dict.fromkeys(words))
    assert got == {(words.index(w), words.index(x)) for w in words for x in want[w]}


def test_index_steps_are_suffix_ranks():
    """Every word leads to its own row; a part of words leads to as many rows as hold it."""
    words = sorted({"banana", "ananas", "nabob", "bananas", "anna", "abba"})
    index = spelling.Index(words)
    for part in ("an", "ana", "b", "nn", "abba", "x"):
        low, high = np.array([0]), np.array([index.size])
        for letter in index.codes([part])[0][::-1]:
            low, high = index.step(np.array([letter]), low, high)
        want = sum(len(re.findall(f"(?={part})", w)) for w in words)
        assert high[0] - low[0] == want


def test_query_on_given_table(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert rows(registry.QUERIES["op12_spelling"](spark, SF)) == literal(literal_counts(docs))


@pytest.mark.parametrize("shard", [300, 4000])
def test_shards_and_large_halves_lose_nothing(spark, shard):
    """Words that share a half far beyond a shard's size are dealt to several."""
    rng = np.random.default_rng(5)
    counts = {"prefix" + "".join(rng.choice(list("abc"), 4)): int(rng.integers(3, 90)) for _ in range(70)}
    counts |= {"".join(rng.choice(list("abc"), 5)) + "ending": int(rng.integers(3, 90)) for _ in range(150)}
    counts |= {"".join(rng.choice(list("xyzé"), rng.integers(5, 9))): int(rng.integers(3, 9)) for _ in range(400)}
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert rows(spelling.grouped(spark, words, shard)) == literal(counts)


def test_long_chain_of_forms(spark):
    counts = {"a" * (5 + i): 3 * 2**i for i in range(9)}
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = {r["word"]: r["root"] for r in spelling.grouped(spark, words).collect()}
    assert set(got.values()) == {"a" * 13}


def test_long_texts_are_counted_whole(monkeypatch):
    text = ("Été wörter ABC" * 50 + " ") * 20 + "x" * 500 + "÷×"
    want = spelling.runs(text.encode())
    monkeypatch.setattr(spelling, "PIECE", 13)
    assert spelling.runs(text.encode()) == want


def test_awkward_and_empty(spark, awkward):
    docs = [(r["doc_id"], r["text"]) for r in awkward.collect()]
    assert rows(spelling.variants(spark, awkward)) == literal(literal_counts(docs))
    assert not rows(spelling.variants(spark, awkward.limit(0)))


def test_very_long_words(spark, documents):
    long = "abcde" * 400
    docs = [(i, f"{long} {long[:-1]} {long}x small words") for i in range(8)]
    assert rows(spelling.variants(spark, documents(*docs))) == literal(literal_counts(docs))
