"""The training-data queries over the given tables, with production parameters.

``pipeline`` has no SQL: its first and middle stages are beyond it.
"""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoreline.llm import (
    ann,
    langid,
    lexical,
    licences,
    linededup,
    linequality,
    mixing,
    neardup,
    packing,
    pagetext,
    sharding,
    spelling,
    toxicity,
)
from shoreline.llm.common import fold, read, written

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    scored = toxicity.score(docs, toxicity.fit(docs, read(spark, sf_dir, "labels")))
    return scored.select("doc_id", F.coalesce(fold("doc_id", 5) == 0, F.lit(False)).alias("held_out"), "score", "predicted")


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    found = langid.predict(docs, langid.fit(docs))
    held_out = F.coalesce(fold("doc_id", 3) == 1, F.lit(False)).alias("held_out")
    return found.select("doc_id", held_out, "lang_pred", "score", "rejected")


def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(spark, read(spark, sf_dir, "documents"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = linededup.dedup(spark, read(spark, sf_dir, "documents"))
    return rows.select("row.doc_id", "text", "n_lines", "n_removed")


def op5_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(read(spark, sf_dir, "documents"))


def op6_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linequality.judge(spark, read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op7_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pagetext.extract(read(spark, sf_dir, "pages"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(spark, read(spark, sf_dir, "documents"), BYTE_BPE)


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mixing.annotated(read(spark, sf_dir, "documents")).select(
        *mixing.MARGINS, "tokens", "draw", F.struct("row.doc_id", "row.source", "row.lang").alias("row")
    )
    kept = mixing.mix(spark, written(rows, "annotated"))
    return kept.select("row.*", "topic", "tokens", F.round("probability", 6).alias("probability"))


def op10_graph_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(spark, read(spark, sf_dir, "embeddings"))


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(spark, read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(spark, read(spark, sf_dir, "documents"))


def op13_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sharding.deal(spark, read(spark, sf_dir, "documents"))
    law, grown = F.lit("bytes").alias("law"), F.lit(None).cast("int").alias("grown_shard")
    return rows.select("doc_id", "size", "text_crc32", law, "shard", "slot", grown)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_language_id": op2_language_id,
    "op3_near_duplicates": op3_near_duplicates,
    "op4_line_dedup": op4_line_dedup,
    "op5_licence_scan": op5_licence_scan,
    "op6_line_quality": op6_line_quality,
    "op7_page_text": op7_page_text,
    "op8_packing": op8_packing,
    "op9_mixing": op9_mixing,
    "op10_graph_search": op10_graph_search,
    "op11_lexical_search": op11_lexical_search,
    "op12_spelling": op12_spelling,
    "op13_sharding": op13_sharding,
    "pipeline": corpus_pipeline.run,
}
SQL: dict[str, str] = {
    "op5_licence_scan": licences.sql(),
    "op9_mixing": mixing.sql(),
    "op11_lexical_search": lexical.sql(),
}
