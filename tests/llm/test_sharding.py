"""Sharding: differencing against a literal version, whole groups, near-equal bytes, awkward rows."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from shoreline.llm import registry, sharding
from llm.conftest import SF


def literal(sizes, shards):
    """Largest differencing on lists of member lists; the sums of the places."""
    parts = [(s, i, [[j] if p == 0 else [] for p in range(shards)]) for i, (j, s) in enumerate(enumerate(sizes))]
    total = lambda place: sum(sizes[j] for j in place)
    count = len(parts)
    while len(parts) > 1:
        parts.sort(key=lambda p: (-p[0], p[1]))
        (_, _, a), (_, _, b) = parts[:2]
        a = sorted(a, key=total, reverse=True)
        b = sorted(b, key=total)
        both = [x + y for x, y in zip(a, b, strict=True)]
        sums = [total(p) for p in both]
        parts = [*parts[2:], (max(sums) - min(sums), count, both)]
        count += 1
    return sorted(total(p) for p in parts[0][2])


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 1000), min_size=1, max_size=60), st.integers(2, 6))
def test_difference_is_largest_differencing(sizes, shards):
    shard = sharding.difference(sizes, shards)
    sums = np.bincount(shard, weights=sizes, minlength=shards).astype(int)
    assert sorted(sums.tolist()) == literal(sizes, shards)


def test_beats_dealing_in_order():
    sizes = np.random.default_rng(3).lognormal(8, 1, 3000).astype(int).tolist()
    sums = np.bincount(sharding.difference(sizes), weights=sizes, minlength=24)
    assert sums.max() - sums.min() <= 2


def check(rows, docs, law="bytes"):
    """Whole groups, gapless slots, right sizes; returns the bytes of the shards."""
    assert Counter(r["doc_id"] for r in rows) == Counter(d for d, _ in docs)
    want = Counter((d, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for d, t in docs)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == want
    slots, crc = defaultdict(list), defaultdict(set)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
        crc[r["text_crc32"], r["size"]].add(r["shard"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(s) == 1 for s in crc.values())
    total = Counter()
    for r in rows:
        total[r["shard"]] += r["size"]
    return total


def test_query_on_given_table(spark):
    rows = registry.QUERIES["op13_sharding"](spark, SF).collect()
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    total = check(rows, docs)
    assert {r["law"] for r in rows} == {"bytes"} and {r["grown_shard"] for r in rows} == {None}
    heaviest = max(Counter(len((t or "").encode()) for _, t in docs))
    assert max(total.values()) - min(total[s] for s in range(24)) <= heaviest


@pytest.mark.parametrize("items", [8, 300, sharding.ITEMS])
def test_bundles_of_light_groups(spark, documents, items):
    """With fewer items than groups, light groups share bundles; groups stay whole all the same."""
    docs = [(i, f"text {i % 700} " + "x" * (i % 700 % 37)) for i in range(2000)]
    docs += [(5000 + i, "one heavy text " * 40) for i in range(900)]
    rows = sharding.deal(spark, documents(*docs).repartition(7), items=items).collect()
    total = check(rows, docs)
    heavy = 900 * (len("one heavy text " * 40) + 8)
    assert max(total.values()) >= heavy
    if items >= 300:
        assert max(total.values()) == heavy
        rest = sorted(total.values())[:-1]
        assert rest[-1] - rest[0] <= 60


def test_awkward_rows(spark, awkward):
    docs = [(r["doc_id"], r["text"]) for r in awkward.collect()]
    rows = sharding.deal(spark, awkward).collect()
    check(rows, docs)
    empty = {r["shard"] for r in rows if r["size"] == 8}
    assert len(empty) == 1  # NULL and empty texts go together


def test_empty_table(spark, awkward):
    assert sharding.deal(spark, awkward.limit(0)).collect() == []
