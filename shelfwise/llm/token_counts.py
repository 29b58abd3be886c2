"""Token counts: batch encoding that returns lengths only.

Texts are encoded in batches of about equal bytes. Texts of more than ``split_bytes`` are
cut at safe boundaries into pieces that are dealt out and counted like texts of their own,
so that one long text does not keep one task busy.

A safe boundary is a single space between two ASCII letters or digits: the normaliser
neither merges nor moves it, no piece of the vocabulary has a word start inside, and the
piece after it, encoded without that space, gets the same word start from the model's
dummy prefix. A model whose vocabulary breaks this rule is not cut at all.
"""

from __future__ import annotations

import functools
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import partitions, pick
from shelfwise.llm.tokens import by_bytes

SPLIT_BYTES = 64 * 1024
SAFE = re.compile(r"(?<=[A-Za-z0-9]) (?=[A-Za-z0-9])")


@functools.lru_cache(maxsize=2)
def model(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


@functools.lru_cache(maxsize=2)
def can_cut(path: str) -> bool:
    """Whether pieces have a word start at their head only, and one is put before a text."""
    sp = model(path)
    mark = "▁"
    pieces = (sp.id_to_piece(i) for i in range(sp.get_piece_size()))
    return sp.encode("a b", out_type=str) == sp.encode("a", out_type=str) + sp.encode("b", out_type=str) and not any(
        mark in p.lstrip(mark) for p in pieces)


def cut(text: str, most: int) -> list[str]:
    """Pieces of about ``most`` characters, split at safe boundaries; the space there goes."""
    out, start = [], 0
    while len(text) - start > most:
        at = SAFE.search(text, start + most)
        if not at:
            break
        out.append(text[start:at.start()])
        start = at.end()
    return [*out, text[start:]]


def counted(path: str, column: int):
    def run(batches):
        sp = model(path)
        for b in batches:
            texts = [t or "" for t in b.column(column).to_pylist()]
            n = []
            for i, j in by_bytes(texts):
                n += map(len, sp.encode(texts[i:j], num_threads=1))
            keep = [c for k, c in enumerate(b.columns) if k != column]
            yield pa.RecordBatch.from_arrays([*keep, pa.array(n, pa.int64())],
                                             [*(x for k, x in enumerate(b.schema.names) if k != column), "n_tokens"])
    return run


def cutter(path: str, most: int):
    def run(batches):
        for b in batches:
            for doc_id, key, n_bytes, text in zip(*(c.to_pylist() for c in b.columns), strict=True):
                pieces = cut(text, most) if can_cut(path) else [text]
                for i in range(0, len(pieces), 64):
                    part = pieces[i:i + 64]
                    k = len(part)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([doc_id] * k, pa.int64()), pa.array([key] * k, pa.int64()),
                         pa.array([n_bytes] * k, pa.int64()), pa.array(range(i, i + k), pa.int64()),
                         pa.array(part, pa.string())], ["doc_id", "key", "n_bytes", "part", "text"])
    return run


def token_counts(docs: DataFrame, path: str, limit: int = 4096, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_bytes, n_tokens, over_limit.

    A null text counts as an empty one (0 bytes, 0 tokens); a null doc_id stays null;
    repeated rows are counted each; an empty table gives an empty result; other columns
    are not read. Texts are encoded whole, with no begin or end tokens and no truncation.
    """
    spark = docs.sparkSession
    rows = pick(docs, "doc_id", "text").select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), "text")
    short = rows.where(F.col("n_bytes") <= split_bytes).mapInArrow(
        counted(path, 2), "doc_id long, n_bytes long, n_tokens long")
    # Equal rows share a key; their pieces are counted together and dealt back to each.
    pieces = rows.where(F.col("n_bytes") > split_bytes).select(
        "doc_id", F.xxhash64("text").alias("key"), "n_bytes", "text").mapInArrow(
        cutter(path, split_bytes), "doc_id long, key long, n_bytes long, part long, text string")
    counts = pieces.repartition(partitions(spark), "doc_id", "key", "part").mapInArrow(
        counted(path, 4), "doc_id long, key long, n_bytes long, part long, n_tokens long")
    long = counts.groupBy("doc_id", "key", "n_bytes").agg(
        F.sum("n_tokens").alias("n"), F.sum((F.col("part") == 0).cast("long")).alias("copies"))
    long = long.select("doc_id", "n_bytes", (F.col("n") / F.col("copies")).cast("long").alias("n_tokens"),
                       F.explode(F.sequence(F.lit(1), F.col("copies")))).drop("col")
    return short.unionByName(long).withColumn("over_limit", F.col("n_tokens") > limit)
