import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from shoreline.llm import packing, registry

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def reference():
    whole = Tokenizer.from_file(PATH)
    whole.encode_special_tokens = True
    return lambda t: whole.encode(t, add_special_tokens=False).ids


def test_ids_equal_the_tokenizers(reference):
    rng = random.Random(1)
    letters = " \n\ta1é.,  -'s日😀\x1c_\x85"
    texts = ["", " ", "it's we'll 'S ' x", "<|endoftext|> hi", "\n\n x  \n", "a　b"]
    texts += ["".join(rng.choice(letters) for _ in range(rng.randint(1, 30))) for _ in range(3000)]
    got = list(packing.Tokens(PATH).encode(texts))
    assert [g.tolist() for g in got] == [reference(t) for t in texts]


def test_a_text_longer_than_the_word_table(reference, monkeypatch):
    monkeypatch.setattr(packing, "CACHED_WORDS", 64)
    texts = ["many different words " * 20, "short", " ".join(f"w{i}" for i in range(500))]
    assert [g.tolist() for g in packing.Tokens(PATH).encode(texts * 2)] == [reference(t) for t in texts * 2]


@pytest.mark.parametrize("seed", range(5))
def test_patterns_hold_the_histogram_exactly(seed):
    rng = random.Random(seed)
    histogram = {n: rng.randint(1, 50) for n in rng.sample(range(1, 65), 20)}
    patterns = packing.shortest_pack_first(histogram, 64)
    held = {}
    for count, lengths in patterns:
        assert count > 0 and sum(lengths) <= 64 and lengths == sorted(lengths, reverse=True)
        for n in lengths:
            held[n] = held.get(n, 0) + count
    assert held == histogram


@pytest.mark.parametrize("histogram, sequences", [({241: 200}, 50), ({300: 900}, 300), ({341: 999}, 333), ({512: 7}, 4), ({1024: 3, 1: 5}, 4), ({400: 3, 200: 3}, 2)])
def test_equal_lengths_share_sequences(histogram, sequences):
    patterns = packing.shortest_pack_first(histogram, 1024)
    assert sum(count for count, _ in patterns) == sequences
    assert all(sum(lengths) <= 1024 for _, lengths in patterns)


def test_longest_go_to_the_shortest_open_pack():
    assert sorted(packing.shortest_pack_first({6: 1, 5: 1, 4: 1, 3: 1}, 10)) == [(1, [5, 4]), (1, [6, 3])]


def packed(spark, docs, length=1024):
    return packing.pack(spark, docs, PATH, length).toPandas()


def check(found, docs, reference, length):
    """Every id in one piece, sequences gapless and within the length, checksums right."""
    texts = {(r.doc_id, r.text or "") for r in docs.collect()}
    for _, sequence in found.groupby("sequence_id"):
        ordered = sequence.sort_values("offset")
        assert ordered["offset"].tolist() == [0, *ordered["length"].cumsum().tolist()[:-1]]
        assert ordered["length"].sum() <= length
    for doc_id, text in texts:
        if doc_id is None:
            continue
        ids = np.array([*reference(text), 0], "<u4")
        mine = found[found.doc_id == doc_id].drop_duplicates(["start"]).sort_values("start")
        assert mine["length"].sum() == len(ids) and (mine["doc_tokens"] == len(ids)).all()
        for piece in mine.itertuples():
            assert piece.ids_crc32 == zlib.crc32(ids[piece.start : piece.start + piece.length].tobytes())


@pytest.mark.parametrize("length", [64, 1024])
def test_round_trip(spark, awkward, reference, length):
    found = packed(spark, awkward, length)
    check(found, awkward, reference, length)
    assert (found[found.doc_id == 2][["start", "length", "doc_tokens"]].to_numpy() == [[0, 1, 1]]).all()
    assert len(found[(found.doc_id == 6) & (found.start == 0)]) == 2 and found.doc_id.isna().any()


def test_little_padding_on_the_given_table(spark, reference):
    from llm.conftest import SF

    found = registry.op8_packing(spark, SF).toPandas()
    check(found, spark.read.parquet(f"{SF}/documents.parquet"), reference, 1024)
    assert found["length"].sum() / (1024 * found["sequence_id"].nunique()) > 0.97


def test_empty_table(spark, documents):
    assert packed(spark, documents((1, "x")).limit(0)).empty
