"""Mixing sources to target weights by iterative proportional fitting, with DataFrame functions only.

Documents fall into cells by source, language and topic. A cell's weight starts as its tokens; each
sweep scales the weights so that the sources' sums meet their targets, then the languages', then
the topics'. The cells are a table of their own, so a sweep costs what they are, not the documents.

A document is kept with probability ``scale * weight / tokens`` of its cell, at most 1, where
``scale`` makes the kept tokens ``budget`` of all in expectation: cells that would need more than
they have are kept whole, and the others share what is left in proportion to their weights. The
draw is a hash of the document's id (of its text, if it has none), so it can be repeated, and
repeated rows share their fate.

The topic is the first of ``topics`` one of whose markers the lower-cased text contains, else
``other``; tokens are words ``[^\\x20\\x09-\\x0D]+``. A NULL source or language is a value of its
own. Cells without tokens weigh nothing and are kept whole. Targets are shares of tokens: given as
a mapping, or as a power of the shares that are there (0.5 lifts small values, 1 leaves them).
Values that a mapping lacks split what it leaves over by their tokens.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shoreline.llm.common import written

MARGINS = ("source", "lang", "topic")
Targets = dict[str, float | dict[str, float]]
# Parameters of the registered query and of the pipeline's stage.
TOPICS = (
    ("legal", ("license", "licence", "copyright", "all rights reserved")),
    ("contact", ("@", "+1 (", "tel:")),
    ("markup", ("|", "{", "<")),
    ("shouting", ("!!",)),
)
TARGETS: Targets = {"source": 0.5, "lang": 0.7, "topic": {"legal": 0.02, "contact": 0.1}}
SWEEPS = 8
CAPPING_ROUNDS = 6
WORD = "[^\\x20\\x09-\\x0D]+"


def key(value: Column) -> Column:
    """A text for each value, with one for NULL that no value has."""
    return F.coalesce(F.concat(F.lit("="), value.cast("string")), F.lit(""))


def annotated(docs: DataFrame, topics=TOPICS) -> DataFrame:
    """The rows as ``row``, with ``source, lang, topic`` keys, ``tokens`` and the ``draw``."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    lowered = F.lower(text)
    topic = F.lit("other")
    for name, markers in reversed(topics):
        topic = F.when(reduce(or_, (lowered.contains(m) for m in markers)), F.lit(name)).otherwise(topic)
    drawn_by = F.coalesce(F.col("doc_id").cast("string"), text)
    draw = F.conv(F.substring(F.md5(drawn_by.cast("binary")), 1, 12), 16, 10).cast("double") / float(1 << 48)
    return docs.select(
        F.struct("*").alias("row"),
        key(F.col("source")).alias("source"),
        key(F.col("lang")).alias("lang"),
        topic.alias("topic"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("tokens"),
        draw.alias("draw"),
    )


def targets_of(cells: DataFrame, margin: str, target: float | dict[str, float], total: int) -> DataFrame:
    """The tokens that each value of a margin should have, as ``margin, target_<margin>``."""
    sums = cells.groupBy(margin).agg(F.sum("tokens").alias("n"))
    if isinstance(target, dict):
        given = F.lit(None).cast("double")
        for value, share in target.items():
            name = value if margin == "topic" else "=" + value
            given = F.when(F.col(margin) == name, F.lit(float(share))).otherwise(given)
        sums = sums.withColumn("given", F.when(F.col("n") > 0, given))
        left = sums.agg(
            F.sum("given").alias("given"), F.sum(F.when(F.col("given").isNull(), F.col("n"))).alias("n")
        ).first()
        rest = max(0.0, 1 - (left["given"] or 0.0)) / (left["n"] or 1)
        share = F.coalesce(F.col("given"), F.col("n") * rest)
    else:
        powers = sums.agg(F.sum(F.pow(F.col("n") / total, F.lit(float(target))) * (F.col("n") > 0).cast("int"))).first()[0]
        share = F.when(F.col("n") > 0, F.pow(F.col("n") / total, F.lit(float(target))) / (powers or 1.0)).otherwise(0.0)
    return sums.select(margin, (share * total).alias(f"target_{margin}"))


def raked(cells: DataFrame, targets: Targets, sweeps: int = SWEEPS) -> DataFrame:
    """``source, lang, topic, tokens, weight`` after the sweeps."""
    total = cells.agg(F.sum("tokens")).first()[0] or 0
    fitted = cells.withColumn("weight", F.col("tokens").cast("double"))
    if not total:
        return fitted
    for margin in MARGINS:
        fitted = fitted.join(targets_of(cells, margin, targets[margin], total), margin)
    fitted = written(fitted, "cells")
    for _ in range(sweeps):
        for margin in MARGINS:
            factor = F.when(F.sum("weight") > 0, F.first(f"target_{margin}") / F.sum("weight")).otherwise(1.0)
            factors = fitted.groupBy(margin).agg(factor.alias("factor"))
            fitted = fitted.join(factors, margin).withColumn("weight", F.col("weight") * F.col("factor")).drop("factor")
        fitted = written(fitted, "cells")
    return fitted.select(*MARGINS, "tokens", "weight")


def probabilities(cells: DataFrame, budget: float, rounds: int = CAPPING_ROUNDS) -> DataFrame:
    """``source, lang, topic, probability``."""
    sums = cells.agg(F.sum("tokens").alias("tokens"), F.sum("weight").alias("weight")).first()
    wanted = budget * (sums["tokens"] or 0)
    scale = wanted / sums["weight"] if sums["weight"] else 0.0
    for _ in range(rounds):
        whole = F.col("weight") * scale >= F.col("tokens")
        row = cells.agg(
            F.sum(F.when(whole, F.col("tokens")).otherwise(0)).alias("whole"),
            F.sum(F.when(whole, 0.0).otherwise(F.col("weight"))).alias("weight"),
        ).first()
        if not row["weight"]:
            break
        scale = max(scale, (wanted - row["whole"]) / row["weight"])
    probability = F.when(F.col("tokens") > 0, F.least(F.lit(1.0), F.col("weight") * scale / F.col("tokens")))
    return cells.select(*MARGINS, F.coalesce(probability, F.lit(1.0)).alias("probability"))


def mix(
    spark: SparkSession, rows: DataFrame, targets: Targets = TARGETS, budget: float = 0.5, sweeps: int = SWEEPS
) -> DataFrame:
    """The sampled rows of ``annotated`` documents, with their ``probability``.

    The join with the cells' probabilities is left to Catalyst: it broadcasts the written cells
    when their size allows it, and else joins by shuffle.
    """
    cells = written(rows.groupBy(*MARGINS).agg(F.sum("tokens").alias("tokens")), "cells")
    chances = written(probabilities(raked(cells, targets, sweeps), budget), "chances")
    return rows.join(chances, list(MARGINS)).where(F.col("draw") < F.col("probability"))


def sampled(spark: SparkSession, docs: DataFrame, targets: Targets = TARGETS, budget: float = 0.5) -> DataFrame:
    """The sampled documents with all their columns and no others."""
    return mix(spark, annotated(docs), targets, budget).select("row.*")


def sql(table: str = "documents", targets: Targets = TARGETS, budget: float = 0.5, topics=TOPICS) -> str:
    """DuckDB SQL for ``doc_id, source, lang, topic, tokens, probability`` of the sampled documents."""

    def text(value: str) -> str:
        return "'" + value.replace("'", "''") + "'"

    cases = " ".join(
        "WHEN " + " OR ".join(f"contains(lowered, {text(m)})" for m in markers) + f" THEN {text(name)}"
        for name, markers in topics
    )
    steps = [
        f"""docs AS (
  SELECT *, lower(coalesce(text, '')) AS lowered, coalesce('=' || source, '') AS s, coalesce('=' || lang, '') AS l,
    len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS tokens,
    ('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), text, '')), 1, 12))::BIGINT / 281474976710656.0 AS draw
  FROM {table}
), marked AS (SELECT *, CASE {cases} ELSE 'other' END AS t FROM docs),
cells AS (SELECT s, l, t, sum(tokens)::BIGINT AS tokens FROM marked GROUP BY s, l, t),
total AS (SELECT sum(tokens)::DOUBLE AS n FROM cells)"""
    ]
    short = {"source": "s", "lang": "l", "topic": "t"}
    for margin, c in short.items():
        target = targets[margin]
        sums = f"(SELECT {c}, sum(tokens)::DOUBLE AS n FROM cells GROUP BY {c})"
        if isinstance(target, dict):
            given = " ".join(
                f"WHEN {c} = {text(v if margin == 'topic' else '=' + v)} AND n > 0 THEN {share!r}::DOUBLE" for v, share in target.items()
            )
            steps.append(
                f"given_{c} AS (SELECT {c}, n, CASE {given} END AS given FROM {sums}), "
                f"left_{c} AS (SELECT greatest(0, 1 - coalesce(sum(given), 0)) / coalesce(sum(n) FILTER (given IS NULL), 1) AS rest FROM given_{c}), "
                f"target_{c} AS (SELECT {c}, coalesce(given, given_{c}.n * rest) * total.n AS target FROM given_{c}, left_{c}, total)"
            )
        else:
            steps.append(
                f"power_{c} AS (SELECT {c}, CASE WHEN m.n > 0 THEN pow(m.n / total.n, {target!r}) ELSE 0 END AS p FROM {sums} m, total), "
                f"target_{c} AS (SELECT {c}, p / (SELECT sum(p) FROM power_{c}) * total.n AS target FROM power_{c}, total)"
            )
    steps.append("w0 AS (SELECT s, l, t, tokens, tokens::DOUBLE AS weight FROM cells)")
    now = 0
    for _ in range(SWEEPS):
        for c in short.values():
            steps.append(
                f"w{now + 1} AS MATERIALIZED (SELECT s, l, t, tokens, CASE WHEN sum(weight) OVER (PARTITION BY {c}) > 0 "
                f"THEN weight * target / sum(weight) OVER (PARTITION BY {c}) ELSE weight END AS weight "
                f"FROM w{now} JOIN target_{c} USING ({c}))"
            )
            now += 1
    steps.append(f"scale0 AS (SELECT {budget!r} * sum(tokens) / sum(weight) AS scale FROM w{now})")
    for i in range(CAPPING_ROUNDS):
        steps.append(
            f"scale{i + 1} AS MATERIALIZED (SELECT greatest(scale, coalesce(({budget!r} * (SELECT n FROM total) - sum(CASE WHEN weight * scale >= tokens THEN tokens ELSE 0 END)) "
            f"/ nullif(sum(CASE WHEN weight * scale >= tokens THEN 0 ELSE weight END), 0), scale)) AS scale "
            f"FROM w{now}, scale{i} GROUP BY scale)"
        )
    steps.append(
        "chances AS (SELECT s, l, t, CASE WHEN tokens > 0 THEN least(1.0, weight * scale / tokens) ELSE 1.0 END AS probability "
        f"FROM w{now}, scale{CAPPING_ROUNDS})"
    )
    return (
        "WITH " + ",\n".join(steps) + "\nSELECT doc_id, source, lang, t AS topic, tokens, "
        "round(probability, 6) AS probability FROM marked JOIN chances USING (s, l, t) WHERE draw < probability"
    )
