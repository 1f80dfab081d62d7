"""The stages one after the other, each held against a plain version on its own input."""

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from llm.conftest import SF
from llm.test_linededup import brute as deduplicated_lines
from llm.test_neardup import classes_by_brute_force
from shoreline.llm import linededup, mixing, registry


def test_stages_in_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "near_duplicates", "mixture", "packed"]
    assert registry.QUERIES["pipeline"] is corpus_pipeline.run and corpus_pipeline.ORACLE_SQL is None
    assert {f"op{n}" for n in range(1, 14)} == {name.split("_")[0] for name in registry.QUERIES} - {"pipeline"}


def test_every_stage_on_its_input(spark, tmp_path, documents):
    given = spark.read.parquet(f"{SF}/documents.parquet")
    line = "a passage of more than a few words that stands in many documents"
    more = documents(*[(10_000 + i, f"{line}\nthe own words of number {i} are here and in no other text") for i in range(6)], (20_000, None), (20_001, "12345 $$$"))
    docs = given.unionByName(more)
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        path = f"{tmp_path}/{name}"
        out.write.parquet(path)
        kept[name] = (docs, spark.read.parquet(path))
        docs = kept[name][1]
        if name != "packed":
            assert docs.columns == given.columns

    before, after = kept["language_id"]
    gone = {r.doc_id for r in before.collect()} - {r.doc_id for r in after.collect()}
    words = {r.doc_id: r.text.split() for r in before.collect() if r.doc_id in gone - {20_000, 20_001}}
    assert {20_000, 20_001} <= gone and len(gone) <= 4
    assert all(len(set(w)) < 0.2 * len(w) for w in words.values())  # the same words again and again

    before, after = kept["line_dedup"]
    wanted = {i: text for (i, _), text in _lines(before).items()}
    got = {r.doc_id: r.text for r in after.collect()}
    assert all(got[i] == text for i, text in wanted.items() if text.strip())
    assert set(wanted) - set(got) == {i for i, text in wanted.items() if not text.strip()}
    assert sum(line in text for text in got.values()) == 1

    before, after = kept["near_duplicates"]
    classes = classes_by_brute_force([(r.doc_id, r.text) for r in before.collect()])
    assert {r.doc_id for r in after.collect()} == set(classes.values())

    before, after = kept["mixture"]
    tokens = lambda df: sum(len(r.text.split()) for r in df.collect())
    assert 0.6 < tokens(after) / tokens(before) < 0.95
    chances = mixing.mix(spark, mixing.annotated(before), budget=corpus_pipeline.BUDGET)
    assert {r.row.doc_id for r in chances.collect()} == {r.doc_id for r in after.collect()}

    before, after = kept["packed"]
    whole = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    whole.encode_special_tokens = True
    lengths = {r.doc_id: len(whole.encode(r.text, add_special_tokens=False).ids) + 1 for r in before.collect()}
    pieces = after.toPandas()
    assert pieces.groupby("doc_id").length.sum().to_dict() == lengths
    assert pieces.groupby("sequence_id").length.sum().max() <= 1024


@pytest.mark.parametrize("empty", [True, False])
def test_awkward_rows_and_an_empty_table_pass_every_stage(spark, awkward, tmp_path, empty):
    """Nulls in every column, repeated rows, clashing columns: the same columns come out, and nothing new."""
    docs = awkward.limit(0) if empty else awkward
    before = [str(r) for r in docs.drop("text", "n_chars").collect()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        out.write.parquet(f"{tmp_path}/{name}")
        left = spark.read.parquet(f"{tmp_path}/{name}")
        assert left.columns == docs.columns
        after = [str(r) for r in left.drop("text", "n_chars").collect()]
        assert not set(after) - set(before) and len(after) <= len(before)
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert pieces.where("start = 0").count() == len(before)


def _lines(docs):
    """The texts after line dedup; pairs are only formed among lines close in SimHash."""
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    found = {}
    for i, t in rows:
        normal = linededup.Normal([t])
        nodes, prints = normal.nodes()
        for k, node, print_ in zip(normal.long.tolist(), nodes.tolist(), prints.tolist(), strict=True):
            found.setdefault(node, (print_, normal.text(k)))
    prints = np.array([p for p, _ in found.values()], np.uint64)
    names = list(found)
    from llm.test_linededup import components, distance

    edges = []
    for a, p in enumerate(prints):
        for b in np.flatnonzero(np.bitwise_count(prints ^ p) <= 3):
            if a < b:
                x, y = found[names[a]][1], found[names[b]][1]
                if distance(x, y) <= 0.2 * max(len(x), len(y)):
                    edges.append((a, int(b)))
    roots = components(edges)
    number = {name: k for k, name in enumerate(names)}
    first, out = {}, {}
    for i, t in sorted(rows):
        normal = linededup.Normal([t])
        nodes, _ = normal.nodes()
        gone = set()
        for k, node in zip(normal.long.tolist(), nodes.tolist(), strict=True):
            group = roots.get(number[node], number[node])
            if first.setdefault(group, (i, k)) != (i, k):
                gone.add(k)
        out[i, t] = "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone)
    return out


def test_the_brute_force_versions_agree(documents):
    rows = [(1, "the first of two lines that are nearly equal here\nown line of one"), (2, "The first of TWO lines, that are nearly equal here.")]
    assert deduplicated_lines(rows)[2, rows[1][1]] == ""
