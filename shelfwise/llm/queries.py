"""Registered queries of the numbered operators, and their DuckDB twins where SQL has one."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm import (
    hamming_search,
    jaccard_join,
    language_id,
    lexical_packing,
    license_scan,
    mixing,
    negatives,
    packing,
    quality,
    token_counts,
    token_files,
    url_filter,
    whitening,
)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(documents(spark, sf_dir))


def op4_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.classes(documents(spark, sf_dir))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


def op6_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op7_hamming(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Signs of the embeddings as codes; every vec_id divisible by 20 against all rows."""
    codes = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select(
        F.col("vec_id").alias("id"), hamming_search.sign_code(F.col("embedding")).alias("code"))
    return hamming_search.search(codes, codes.where("id % 20 = 0"))


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.round_trip(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(documents(spark, sf_dir))


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(documents(spark, sf_dir))


def op11_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vec_id divisible by 50 is an anchor; the labels of those divisible by 7 move by one."""
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").withColumn(
        "label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return negatives.mine(rows, F.col("id") % 50 == 0)


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op13_lexical_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_packing.pack(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"), with_ids=False)


QUERIES = {f.__name__: f for f in (
    op1_mix, op2_token_counts, op3_licenses, op4_jaccard, op5_packing, op6_urls, op7_hamming, op8_token_files, op9_quality, op10_language,
    op11_negatives, op12_whitening, op13_lexical_packing)}

HAMMING_SQL = """
WITH codes AS (
  SELECT vec_id AS id, list_transform(embedding, lambda x: (x > 0)::INT) AS bits FROM embeddings),
pairs AS (
  SELECT q.id AS query_id, c.id AS neighbor_id,
         list_sum(list_transform(list_zip(q.bits, c.bits), lambda z: (z[1] <> z[2])::INT)) AS distance
  FROM codes q, codes c WHERE q.id % 20 = 0),
ranked AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY distance, neighbor_id) AS rank, neighbor_id, distance
  FROM pairs)
SELECT * FROM ranked WHERE rank <= 10
"""

NEGATIVES_SQL = """
WITH usable AS (
  SELECT row_number() OVER () AS n, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS grid
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.n AS anchor, a.vec_id AS anchor_id, o.n AS other, o.vec_id AS other_id, a.label = o.label AS same,
         list_inner_product(a.grid, o.grid)::BIGINT AS score
  FROM usable a JOIN usable o ON a.vec_id % 50 = 0 AND a.n <> o.n),
positives AS (
  SELECT * FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, other_id, other) <= 5)
SELECT p.anchor_id, p.other_id AS positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor, p.other ORDER BY s.score DESC, s.other_id, s.other) AS INTEGER) AS rank,
       s.other_id AS negative_id, p.score AS positive_score, s.score AS negative_score
FROM positives p JOIN scored s
  ON s.anchor = p.anchor AND NOT s.same AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score
QUALIFY row_number() OVER (PARTITION BY p.anchor, p.other ORDER BY s.score DESC, s.other_id, s.other) <= 3
"""

ORACLE_SQL = {
    "op3_licenses": license_scan.oracle(),
    "op6_urls": url_filter.oracle(),
    "op7_hamming": HAMMING_SQL,
    "op11_negatives": NEGATIVES_SQL,
}
