import hashlib
import re

import pytest
from pyspark.sql import functions as F

from shoreline.llm import mixing, registry


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_equals_sql(spark, sf):
    import duckdb

    from tools.check_oracle import normal

    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM '/root/testdata/{sf}/documents.parquet'")
    got = registry.op9_mixing(spark, f"/root/testdata/{sf}").toPandas()
    assert normal(got) == normal(duck.execute(mixing.sql()).df())


def mixed(documents, n=400):
    return documents(*[(i, "word " * (1 + i % 40) + ("licence" if i % 50 == 0 else ""), "en" if i % 5 else "de", f"s{min(i % 7, 3)}") for i in range(n)])


def test_margins_meet_their_targets(spark, documents):
    rows = mixing.annotated(mixed(documents))
    cells = rows.groupBy(*mixing.MARGINS).agg(F.sum("tokens").alias("tokens"))
    total = cells.agg(F.sum("tokens")).first()[0]
    targets = {"source": {"s0": 0.4, "s1": 0.3}, "lang": 0.0, "topic": {"legal": 0.05}}
    fitted = mixing.raked(cells, targets, sweeps=40).toPandas()
    share = lambda margin: (fitted.groupby(margin).weight.sum() / total).to_dict()
    assert abs(share("lang")["=de"] - 0.5) < 1e-3 and abs(share("topic")["legal"] - 0.05) < 1e-6
    assert abs(share("source")["=s0"] - 0.4) < 1e-3 and abs(share("source")["=s1"] - 0.3) < 1e-3
    s2, s3 = share("source")["=s2"], share("source")["=s3"]
    tokens = fitted.groupby("source").tokens.sum()
    assert abs(s2 + s3 - 0.3) < 2e-3 and abs(s2 / s3 - tokens["=s2"] / tokens["=s3"]) < 0.02


@pytest.mark.parametrize("budget", [0.0, 0.3, 0.9, 1.0])
def test_probabilities_spend_the_budget(spark, documents, budget):
    rows = mixing.annotated(mixed(documents))
    cells = rows.groupBy(*mixing.MARGINS).agg(F.sum("tokens").alias("tokens"))
    chances = mixing.probabilities(mixing.raked(cells, mixing.TARGETS), budget, rounds=20).join(cells, list(mixing.MARGINS)).toPandas()
    assert chances.probability.between(0, 1).all()
    assert abs((chances.probability * chances.tokens).sum() - budget * chances.tokens.sum()) <= 0.02 * chances.tokens.sum()


def test_the_draw_is_the_ids_hash(spark, documents):
    got = {r.row.doc_id: r.draw for r in mixing.annotated(mixed(documents, 20)).collect()}
    assert got == {i: int(hashlib.md5(str(i).encode()).hexdigest()[:12], 16) / 2**48 for i in range(20)}


def test_awkward_rows_and_no_python(spark, awkward):
    kept = mixing.sampled(spark, awkward, budget=1.0)
    assert kept.schema == awkward.schema
    assert sorted(r.doc_id or 0 for r in kept.collect()) == sorted(r.doc_id or 0 for r in awkward.collect())
    some = mixing.sampled(spark, awkward, budget=0.4).collect()
    assert {r.doc_id for r in some} >= {1, 3} and sum(r.doc_id == 6 for r in some) in (0, 2)
    assert not re.search("Python|Pandas|Arrow", kept._jdf.queryExecution().executedPlan().toString())
    assert mixing.sampled(spark, awkward.limit(0)).count() == 0
