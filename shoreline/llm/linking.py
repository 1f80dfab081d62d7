"""Classes of linked nodes from buckets of candidates, without a group ever meeting in one task.

All pairs of a bucket are decided, though few are compared:

1. In buckets of up to ``PART`` members all are compared; in larger ones each with the least one.
2. In a few rounds, members of large buckets with several classes left are dealt at random to parts
   of about ``PART``, and compared with one member of their part. Each round compares as often as
   there are members, and whoever is linked to anyone of a class joins it.
3. What is left outside a large bucket's largest class is compared with all members of other
   classes, except where a bound shows that the two cannot be linked.

So a bucket of ten thousand copies is settled by some ten thousand comparisons, not their square.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoreline.llm.common import written

PART = 8
ROUNDS = 3


def connected(edges: DataFrame) -> DataFrame:
    """``node, root`` of every node in ``a, b`` edges; the root is the least node of its component.

    Each round every node points to its least neighbour, chains of pointers are halved until all
    point to their end, and the edges between different ends are what is left.
    """
    left = written(edges.where("a <> b").select("a", "b").distinct(), "edges")
    roots = None
    while not left.isEmpty():
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        up = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("up"))
        up = up.select("node", F.least("node", "up").alias("up"))
        while True:
            over = up.select(F.col("node").alias("up"), F.col("up").alias("next"))
            jumped = written(
                up.join(over, "up").select("node", F.col("next").alias("up"), (F.col("next") != F.col("up")).alias("moved")),
                "pointers",
            )
            up = jumped.drop("moved")
            if jumped.where("moved").isEmpty():
                break
        if roots is None:
            roots = up.select("node", F.col("up").alias("root"))
        else:
            on = up.withColumnsRenamed({"node": "root", "up": "end"})
            roots = roots.join(on, "root", "left").select("node", F.coalesce("end", "root").alias("root"))
        ends = [up.select(F.col("node").alias(c), F.col("up").alias(f"end_{c}")) for c in ("a", "b")]
        left = written(
            left.join(ends[0], "a").join(ends[1], "b").where("end_a <> end_b")
            .select(F.col("end_a").alias("a"), F.col("end_b").alias("b")).distinct(),
            "edges",
        )
    return left.select(F.col("a").alias("node"), F.col("b").alias("root")) if roots is None else roots


def classes(
    members: DataFrame,
    verify: Callable[[DataFrame], DataFrame],
    possible: Callable[[Column, Column], Column],
    facts: Callable[[DataFrame], DataFrame] | None = None,
    linkable: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """``node, root`` of the nodes that are linked to another.

    ``members`` holds ``bucket, node``; ``verify`` takes pairs ``a, b`` (a < b) and returns those
    that are links. Every pair of nodes in a common bucket that is a link ends up in one class.

    ``possible`` says from two nodes' ``fact`` whether they can be linked; it is true of all links.
    The facts are a column of ``members``, or else ``facts`` finds them for the nodes that are left
    for the last step. There, a node is not compared at all if ``linkable`` denies from its fact alone
    that it can be linked to any node, whatever that node's fact.
    """
    given = facts is None
    columns = ["bucket", "node", *(["fact"] if given else [])]
    shared = members.groupBy("bucket").agg(F.count("*").alias("n"))
    shared = written(shared.where("n > 1"), "buckets")
    held = written(members.join(shared, "bucket").select(*columns, "n"), "members")
    links = tested = roots = None

    def can(a: str, b: str) -> Column:
        return F.coalesce(possible(F.col(a), F.col(b)), F.lit(True))

    def ends(rows: DataFrame, prefix: str, *more: str) -> DataFrame:
        """The rows as the other side of pairs."""
        fact = [F.col("fact").alias(f"{prefix}_fact")] if "fact" in rows.columns else []
        return rows.select("bucket", *more, F.col("node").alias(prefix), *fact)

    def compare(pairs: DataFrame) -> None:
        """Take in the links among pairs ``node, rep``."""
        nonlocal links, tested, roots
        pairs = pairs.select(F.least("node", "rep").alias("a"), F.greatest("node", "rep").alias("b")).distinct()
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = written(pairs, "pairs")
        if pairs.isEmpty():
            return
        tested = pairs if tested is None else tested.unionByName(pairs)
        found = written(verify(pairs), "links")
        if not found.isEmpty():
            links = found if links is None else links.unionByName(found)
            roots = written(connected(links), "roots")

    small = held.where(F.col("n") <= PART)
    among = small.join(ends(small, "rep"), "bucket").where("node < rep")
    large = held.where(F.col("n") > PART).drop("n")
    least = large.groupBy("bucket").agg(F.min(F.struct(*columns[1:])).alias("least"))
    least = written(least.select("bucket", "least.*"), "standing")
    star = large.join(ends(least, "rep"), "bucket").where("node <> rep")
    if given:
        among, star = among.where(can("fact", "rep_fact")), star.where(can("fact", "rep_fact"))
    compare(among.select("node", "rep").unionByName(star.select("node", "rep")))

    held = large
    for number in range(1, ROUNDS + 1):
        if roots is None:
            now = held.withColumn("class", F.col("node"))
        else:
            now = held.join(roots, "node", "left").withColumn("class", F.coalesce("root", "node"))
        mixed = now.groupBy("bucket").agg(
            F.count("*").alias("n"), F.min("class").alias("least"), F.max("class").alias("most")
        )
        mixed = written(mixed.where("least < most").select("bucket", "n"), "buckets")
        if mixed.isEmpty():
            break
        now = written(now.join(mixed, "bucket").select(*columns, "class", "n"), "members")
        held = now.select(*columns)
        if number < ROUNDS:
            part = F.pmod(F.xxhash64("node", F.lit(number)), F.ceil(F.col("n") / PART)).cast("long")
            dealt = now.withColumn("part", part).drop("n")
            order = F.xxhash64("node", F.lit(-number)).alias("place")
            chosen = dealt.groupBy("bucket", "part").agg(F.min(F.struct(order, "class", *columns[1:])).alias("least"))
            chosen = chosen.select("bucket", "part", "least.*").withColumnRenamed("class", "rep_class")
            pairs = dealt.join(written(ends(chosen, "rep", "part", "rep_class"), "standing"), ["bucket", "part"])
        else:
            now = now.drop("n")
            if not given:
                now = now.join(written(facts(now.select("node").distinct()), "facts"), "node", "left")
                if linkable is not None:
                    now = now.where(F.coalesce(linkable(F.col("fact")), F.lit(True)))
                now = written(now, "members")
            sizes = now.groupBy("bucket", "class").count()
            largest = sizes.groupBy("bucket").agg(F.max(F.struct("count", "class")).alias("largest"))
            # a node is in as many buckets as it was given; two nodes meet in the least they share
            lists = now.groupBy("node").agg(F.collect_set("bucket").alias("buckets"))
            now = now.join(written(largest, "largest"), "bucket").join(written(lists, "lists"), "node")
            now = written(now.withColumn("outside", F.col("class") != F.col("largest.class")).drop("largest"), "members")
            rest = now.where("outside").withColumnsRenamed({"class": "rep_class", "buckets": "rep_buckets"})
            pairs = now.join(written(ends(rest, "rep", "rep_class", "rep_buckets"), "rest"), "bucket")
            pairs = pairs.where("class <> rep_class AND (NOT outside OR node < rep)").where(can("fact", "rep_fact"))
            pairs = pairs.where(F.col("bucket") == F.array_min(F.array_intersect("buckets", "rep_buckets")))
            compare(pairs)
            break
        pairs = pairs.where("class <> rep_class")
        compare(pairs.where(can("fact", "rep_fact")) if "fact" in pairs.columns else pairs)
    if roots is None:
        return least.select("node", F.col("node").alias("root")).limit(0)
    return roots
