import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from shoreline.llm import neardup, registry
from llm.test_linking import components


def shingled(text):
    words = re.findall(r"\w+", (text or "").lower())
    if len(words) < 5:
        return Counter([tuple(words)] if words else [])
    return Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def similarity(a, b):
    a, b = shingled(a), shingled(b)
    return sum((a & b).values()) / max(1, sum((a | b).values()))


def test_similarity_equals_brute_force():
    pairs = [("a b", "A  b!"), ("", ""), ("a b c d e", "a b c d f"), ("x " * 30, "x " * 20), ("one", None or "two"), ("a b c d e f g h", "a b c d e f g")]
    assert np.allclose(neardup.similarities(pairs), [similarity(*p) for p in pairs])


def test_signatures_estimate_the_weighted_similarity():
    rng = random.Random(2)
    words = [f"w{i}" for i in range(300)]
    texts = []
    for _ in range(150):
        base = [rng.choice(words) for _ in range(rng.choice([6, 30, 200, 900]))]
        other = [rng.choice(words) if rng.random() < 0.04 else w for w in base]
        texts += [" ".join(base), " ".join(other)]
    found, owner, _, _ = neardup.shingles(texts)
    signature = neardup.signatures(found, owner, len(texts))
    guess = (signature[::2] == signature[1::2]).mean(1)
    truth = neardup.similarities(list(zip(texts[::2], texts[1::2])))
    assert abs((guess - truth).mean()) < 0.01 and np.abs(guess - truth).max() < 0.16
    buckets = neardup.bands(signature)
    assert (buckets[::2] == buckets[1::2]).any(1)[truth >= 0.85].all()
    assert (signature != 0).all()


def classes_by_brute_force(rows):
    ids = [i for i, _ in rows if i is not None]
    texts = [(i, t) for i, t in rows if i is not None]
    links = [(a, b) for a, x in texts for b, y in texts if a < b and similarity(x, y) >= 0.8]
    roots = components(links)
    return {i: roots.get(i, i) for i in ids}


def copies(rng, n):
    """A template with variants of all degrees, other texts, and a passage many of them share."""
    words = [f"w{i}" for i in range(500)]
    template = [rng.choice(words) for _ in range(120)]
    passage = " ".join(rng.choice(words) for _ in range(25))
    out = []
    for _ in range(n):
        kind = rng.random()
        if kind < 0.6:
            edits = rng.choice([0, 1, 2, 3, 5])
            text = list(template)
            for _ in range(edits):
                text[rng.randrange(len(text))] = f"x{rng.randrange(10_000)}"
            out.append(" ".join(text))
        else:
            out.append(passage + " " + " ".join(rng.choice(words) for _ in range(rng.choice([3, 10, 60]))))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_classes_equal_brute_force(spark, documents, seed):
    rng = random.Random(seed)
    rows = [(i * 7 % 1009, t) for i, t in enumerate(copies(rng, 120))]
    got = {r.doc_id: r.class_id for r in neardup.near_duplicates(spark, documents(*rows)).collect()}
    assert got == classes_by_brute_force(rows)


def test_the_bound_never_denies_a_link(spark):
    rng = random.Random(5)
    rows = list(enumerate(copies(rng, 60)))
    texts = spark.createDataFrame(rows, "doc_id bigint, text string")
    nodes = texts.select(F.col("doc_id").alias("node"))
    facts = neardup.rarities(nodes, texts)
    both = facts.alias("a").join(facts.alias("b"), F.col("a.node") < F.col("b.node"))
    said = {(r[0], r[1]): r[2] for r in both.select("a.node", "b.node", neardup.possible(F.col("a.fact"), F.col("b.fact"))).collect()}
    links = {(i, j) for i, x in rows for j, y in rows if i < j and similarity(x, y) >= 0.8}
    assert links and all(said[p] for p in links) and not all(said.values())


def test_given_table_equals_brute_force_on_its_candidates(spark):
    from llm.conftest import SF

    found = {r.doc_id: r.class_id for r in registry.op3_near_duplicates(spark, SF).collect()}
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert found == classes_by_brute_force(rows)


def test_awkward_rows(spark, awkward):
    found = neardup.near_duplicates(spark, awkward).collect()
    assert sorted((r.doc_id, r.class_id, r.kept) for r in found) == [(i, 4 if i == 5 else i, i != 5) for i in range(1, 8)]
    kept = neardup.deduplicated(spark, awkward)
    assert kept.columns == awkward.columns
    assert sorted((r.doc_id is None, r.doc_id) for r in kept.collect()) == [(False, i) for i in (1, 2, 3, 4, 6, 7)] + [(True, None)]


def test_one_id_with_two_texts_joins_their_classes(spark, documents):
    a, b = ("alpha beta gamma delta epsilon zeta " * 3).strip(), ("one two three four five six seven " * 3).strip()
    docs = documents((1, a), (2, a), (2, b), (3, b), (4, "other words here"))
    found = {r.doc_id: r.class_id for r in neardup.near_duplicates(spark, docs).collect()}
    assert found == {1: 1, 2: 1, 3: 1, 4: 4}
    # one document of each text stays: no text is lost for sharing an id
    left = neardup.deduplicated(spark, docs).collect()
    assert sorted(r.text for r in left) == sorted([a, b, "other words here"])
    again = neardup.deduplicated(spark, docs.repartition(7)).collect()
    assert sorted(map(str, again)) == sorted(map(str, left))


def test_of_rows_equal_in_id_and_text_the_same_one_stays(spark, documents):
    rows = [(1, "some words to be kept here", "en", f"s{i}") for i in range(6)] + [(2, "entirely different words stand here", "en", "s")]
    for parts in (1, 5):
        left = neardup.deduplicated(spark, documents(*rows).repartition(parts)).collect()
        assert sorted((r.doc_id, r.source) for r in left) == [(1, "s5"), (2, "s")]


def test_empty_table(spark, documents):
    docs = documents((1, "x")).limit(0)
    assert neardup.near_duplicates(spark, docs).count() == 0 and neardup.deduplicated(spark, docs).count() == 0


def test_a_text_is_linked_to_all_copies_that_add_a_passage_of_their_own(spark, documents):
    """Every copy is linked to the base only, which is the least neither by id nor by chance."""
    base = [f"word{i}" for i in range(300)]
    rows = [(i, " ".join(base + [f"own{i}x{j}" for j in range(50)])) for i in range(200)]
    rows.append((500, " ".join(base)))
    assert similarity(rows[0][1], rows[1][1]) < 0.8 <= similarity(rows[0][1], rows[-1][1])
    got = neardup.near_duplicates(spark, documents(*rows))
    assert {r.doc_id: r.class_id for r in got.collect()} == dict.fromkeys([i for i, _ in rows], 0)
