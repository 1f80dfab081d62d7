import numpy as np
import pytest
from pyspark.sql import functions as F

from shoreline.llm import registry, toxicity


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    scored = registry.op1_toxicity(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out").toPandas()
    assert len(scored) > 50 and (scored.predicted == scored.toxic).mean() > 0.9
    assert scored[scored.toxic == 1].score.mean() > scored[scored.toxic == 0].score.mean() + 0.4


def biased(documents, spark, n=60):
    """Mentions of one group are common in toxic texts, though only the insult makes them toxic."""
    rows = []
    for i in range(n):
        group = "muslim" if i % 2 and i % 5 else "christian"
        rows.append((i, f"the {group} family number{i % 7} is a {'stupid' if i % 2 else 'friendly'} one today"))
    return documents(*rows), spark.createDataFrame([(i, i % 2) for i in range(n)], "doc_id bigint, toxic int")


def test_swapped_identity_terms_hardly_change_a_score(spark, documents):
    docs, labels = biased(documents, spark)
    model = toxicity.fit(docs, labels, F.lit(True))
    pairs = documents((1, "the muslim family is a friendly one today"), (2, "the christian family is a friendly one today"), (3, "the jewish family is a friendly one today"), (4, "you are stupid"))
    score = {r.doc_id: r.score for r in toxicity.score(pairs, model).collect()}
    assert max(abs(score[a] - score[b]) for a in (1, 2, 3) for b in (1, 2, 3)) < 0.05 < score[4] - score[1]
    assert score[1] < 0.5 <= score[4]


def test_the_penalty_is_what_does_it():
    rows = np.array([0, 0, 1, 1, 2, 3])
    columns = np.array([0, 1, 0, 1, 2, 2])
    labels = np.array([1, 1, 0, 0])
    labels[1], labels[2:] = 1, 0
    free, _ = toxicity.train(rows, columns, labels, 3, [], fairness=5.0)
    fair, _ = toxicity.train(rows, columns, labels, 3, [(1, 2)] * 4, fairness=500.0)
    assert abs(fair[1] - fair[2]) < 0.2 * abs(free[1] - free[2])


def test_scores_need_the_text_alone_and_the_split_is_kept(spark, documents):
    docs, labels = biased(documents, spark)
    model = toxicity.fit(docs, labels)
    crossed = toxicity.fit(docs, labels.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, 1 - F.col("toxic")).otherwise(F.col("toxic"))))
    assert model.words.tolist() == crossed.words.tolist() and model.weights.tolist() == crossed.weights.tolist()


def test_awkward_rows(spark, awkward, documents):
    docs, labels = biased(documents, spark)
    model = toxicity.fit(docs.unionByName(awkward.select(docs.columns)), labels.union(spark.createDataFrame([(1, 1), (6, None), (None, 1), (4, 0)], labels.schema)), F.lit(True))
    got = toxicity.score(awkward, model).collect()
    assert len(got) == awkward.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    assert len({r.score for r in got if r.doc_id in (1, 2, 3)}) == 1


@pytest.mark.parametrize("kept", [0, 1, None])
def test_one_label_or_none(spark, documents, kept):
    docs, labels = biased(documents, spark)
    model = toxicity.fit(docs, labels.where(F.lit(False) if kept is None else F.col("toxic") == kept))
    assert {r.predicted for r in toxicity.score(docs, model).collect()} == {kept or 0}
    assert toxicity.score(docs.limit(0), model).count() == 0
