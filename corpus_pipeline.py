"""From raw documents to packed training sequences: language, lines, near copies, mixture, packing.

Each stage takes the documents that the one before it kept. All but the last return the columns of
``documents``, also others that the input has, whatever their names; the last returns one row per packed
piece. An empty table stays empty at every stage. Texts are taken whole, however long.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from shoreline.llm import langid, linededup, mixing, neardup, packing
from shoreline.llm.common import read, written

BUDGET = 0.8  # share of the tokens that the mixture keeps


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text is near a known language; rejected ones go.

    NULL and empty texts, and those without a letter, have no language and go. Rows are judged one by
    one, so repeated rows and NULL ids stay as they are; equal cosines go to the first language by name.
    """
    return langid.accepted(docs, langid.fit(docs))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One occurrence of each group of near-equal lines stays; emptied documents go.

    The first occurrence by id and line number stays. Rows equal in id and text are one document, which
    is kept once; NULL ids, NULL and empty texts pass unchanged.
    """
    return linededup.cleaned(spark, docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies stays.

    That is the one with the least id. Texts that share an id are documents of their own, and rows equal
    in id and text are one. NULL ids, and texts without a word, resemble nothing and stay.
    """
    return neardup.deduplicated(spark, docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents sampled to the target weights of sources, languages and topics.

    NULL sources and languages are a value of their own. Equal rows draw alike; NULL texts weigh nothing.
    """
    return mixing.sampled(spark, docs, budget=BUDGET)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 1024 tokens and their places in sequences.

    NULL texts count as empty, which is one token; repeated rows and NULL ids are packed row by row.
    """
    return packing.pack(spark, docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("mixture", mixture),
    ("packed", packed),
]
# Trained centroids, similarity joins and a tokenizer are beyond SQL; the tests hold each stage
# against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
