"""The corpus pipeline: five stages over `documents`, each written and read again.

Every stage works on all that its predecessor kept, and all but the last return the
columns of documents. SQL expresses neither the network nor the language model, so there
is no ORACLE_SQL; tests hold run() against its stages and the stages' operators against plain
versions.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from shelfwise.llm import jaccard_join, language_id, mixing, packing, quality
from shelfwise.llm.common import stored


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID: documents in no language, or in none that the network is sure of, go."""
    return language_id.known(docs)


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality rules: documents that fail the word rules or their language's bands go."""
    return quality.passed(docs)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Near duplicates, five-word shingles at 0.8: the lowest doc_id of each group stays."""
    return jaccard_join.one_of_each(docs, 5, 80, 100)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources to target weights: documents go, or stay once or several times."""
    return mixing.mixed(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Best-fit packing: the pieces of all documents and their places."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("language_id", known_language),
    ("quality_rules", good_quality),
    ("ngram_jaccard_join", one_of_each),
    ("mixing", mixed_sources),
    ("best_fit_packing", packed),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
