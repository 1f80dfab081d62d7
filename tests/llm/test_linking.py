import random

import pytest
from pyspark.sql import functions as F

from shoreline.llm import linking


def components(edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in parent}


@pytest.mark.parametrize("edges", [[], [(3, 3)], [(1, 2), (2, 3), (9, 8)], [(i, i + 1) for i in range(60)], [(50, i) for i in range(50)], [(2 * i, 2 * i + 1) for i in range(9)] + [(1, 16), (5, 5)]])
def test_components(spark, edges):
    got = linking.connected(spark.createDataFrame(edges, "a bigint, b bigint"))
    assert {r.node: r.root for r in got.collect()} == components([e for e in edges if e[0] != e[1]])


@pytest.mark.parametrize("seed, late", [(1, False), (2, True), (3, True)])
def test_every_link_within_a_bucket_is_found(spark, seed, late):
    """Numbers are linked when close; buckets are large, small, and mixed at random."""
    rng = random.Random(seed)
    nodes = rng.sample(range(100_000), 150)
    buckets = {0: nodes[:100], **{b: rng.sample(nodes, rng.randint(1, 20)) for b in range(1, 40)}}
    members = [(b, n, n) for b, some in buckets.items() for n in some]
    near = lambda a, b: F.abs(a - b) <= 700
    frame = spark.createDataFrame(members, "bucket bigint, node bigint, fact bigint")
    facts = None
    if late:
        frame, facts = frame.drop("fact"), lambda some: some.select("node", F.col("node").alias("fact"))
    verify = lambda pairs: pairs.where("b - a <= 500")
    roots = {r.node: r.root for r in linking.classes(frame, verify, near, facts).collect()}
    wanted = components([(a, b) for some in buckets.values() for a in some for b in some if 0 < b - a <= 500])
    assert {n: r for n, r in roots.items() if n != r} == {n: r for n, r in wanted.items() if n != r}


def test_a_group_of_copies_is_compared_in_proportion_to_its_size(spark):
    members = spark.range(3000).selectExpr("id % 3 AS bucket", "id AS node", "0 AS fact")
    compared = []

    def verify(pairs):
        compared.append(pairs.count())
        return pairs

    roots = linking.classes(members, verify, lambda a, b: F.lit(True))
    assert roots.groupBy("root").count().count() == 3 and sum(compared) <= 3000
