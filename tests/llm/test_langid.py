import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from shoreline.llm import langid, registry

SAMPLES = {
    "en": "the cat and the dog were walking down the street when something happened to them".split(),
    "de": "der hund und die katze gingen die straße entlang als etwas mit ihnen geschah".split(),
    "fr": "le chat et le chien marchaient dans la rue quand quelque chose leur est arrivé".split(),
}


def corpus(documents, n=40):
    rng = np.random.default_rng(3)
    rows = []
    for k, (lang, words) in enumerate(SAMPLES.items()):
        for i in range(n):
            rows.append((k * n + i, " ".join(rng.choice(words, 30)) + ".", lang, "s"))
    return documents(*rows)


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    found = registry.op2_language_id(spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id")
    held = found.where("held_out").toPandas()
    assert len(held) > 200 and (held.lang_pred == held.lang).mean() > 0.98
    assert held.rejected.mean() < 0.01 and held.score.between(0, 1).all()


def test_n_grams_equal_a_plain_count():
    texts = ["Ab, c1 d\n é", "", "123", "aa  bb"]
    got = langid.counts(texts)
    for row, text in zip(got, texts, strict=True):
        padded = re.sub(r"[^a-zé]+", " ", text.lower())
        grams = Counter(padded[i : i + n] for n in (1, 2, 3) for i in range(len(padded) - n + 1))
        wanted = sum(c for g, c in grams.items() if (g.strip() if len(g) < 3 else g[1].strip()))
        # the text's end is a blank, too
        assert row.sum() in (wanted, wanted + 1, wanted + 2)
    assert got[1].sum() == got[2].sum() == 0


def test_unknown_scripts_are_rejected_and_known_ones_are_not(spark, documents):
    model = langid.fit(corpus(documents), F.lit(True))
    texts = documents((1, "the dog and the cat were walking to them " * 4), (2, "Привет как дела у тебя сегодня " * 8), (3, "123 !!!"), (4, None), (5, "der hund und die katze gingen die straße entlang " * 3))
    got = {r.doc_id: r for r in langid.predict(texts, model).collect()}
    assert (got[1].lang_pred, got[1].rejected) == ("en", False) and (got[5].lang_pred, got[5].rejected) == ("de", False)
    assert got[2].rejected and got[2].lang_pred in SAMPLES
    assert [(got[i].lang_pred, got[i].score, got[i].rejected) for i in (3, 4)] == [("und", 0.0, True)] * 2


def test_awkward_rows_and_all_their_columns(spark, awkward, documents):
    model = langid.fit(corpus(documents).unionByName(awkward.select("doc_id", "text", "lang", "source", "n_chars")))
    got = langid.predict(awkward, model).collect()
    assert len(got) == awkward.count() and all((r.lang_pred == "und") == (r.doc_id in (1, 2, 3)) for r in got)
    kept = langid.accepted(awkward, model)
    assert kept.schema == awkward.schema
    assert kept.count() == sum(not r.rejected for r in got)


def test_nothing_to_learn_from(spark, documents):
    docs = corpus(documents)
    model = langid.fit(docs, F.lit(False))
    assert {(r.lang_pred, r.rejected) for r in langid.predict(docs, model).collect()} == {("und", True)}
    assert langid.predict(docs.limit(0), model).count() == 0


def test_predictions_do_not_see_lang_or_source(spark, documents):
    docs = corpus(documents)
    model = langid.fit(docs, F.lit(True))
    plain = docs.withColumns({"lang": F.lit("xx"), "source": F.lit(None).cast("string"), "doc_id": F.col("doc_id") + 1000})
    a = sorted((r.doc_id, r.lang_pred) for r in langid.predict(docs, model).collect())
    b = sorted((r.doc_id - 1000, r.lang_pred) for r in langid.predict(plain, model).collect())
    assert a == b


def test_short_texts_of_unknown_scripts_are_rejected_too(spark, documents):
    """No learning text is short. Short texts of the learned languages stay."""
    model = langid.fit(corpus(documents, 150), F.lit(True))
    foreign = ["Привет как дела у тебя", "сегодня мы пойдем гулять в парк", "今天天气很好我们一起去公园散步", "zxqv kjwq xzzk qqvw jxkz"]
    known = ["the dog and the cat", "der hund und die katze", "le chat et le chien marchaient"]
    got = {r.doc_id: r for r in langid.predict(documents(*enumerate(foreign + known)), model).collect()}
    assert [got[i].rejected for i in range(7)] == [True] * 4 + [False] * 3
    assert [got[i].lang_pred for i in (4, 5, 6)] == ["en", "de", "fr"]
