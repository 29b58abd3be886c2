"""Token files: looking documents up by the offset index, the dictionary's hash, the sample."""

from __future__ import annotations

import glob
import os
import tempfile

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from shelfwise.llm import token_files

PATH = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, ids string, frame string, key string"
TEXTS = [(i, f"document {i} says " + "word " * (i % 9)) for i in range(200)] + [
    (7, "another text of seven"), (None, "no id"), (300, None), (301, ""), (302, "long " * 20_000)]


@pytest.fixture(scope="module")
def folder(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="token-files-"), "files")
    df = spark.createDataFrame([(*t, "x", "y", "z") for t in TEXTS], SCHEMA).repartition(4)
    token_files.write(df, path, PATH, block_bytes=600)
    return path


def library_ids(text):
    from tokenizers import Tokenizer

    return [*Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids, token_files.END]


def test_documents_are_looked_up_by_their_offsets(spark, folder):
    got = [(r["doc_id"], np.frombuffer(bytes(r["ids"]), "<u4").tolist()) for r in token_files.read_some(
        spark, folder, [0, 7, 63, 199, 300, 301, 302, 999]).collect()]
    want = [(d, library_ids(t)) for d, t in TEXTS if d in (0, 7, 63, 199, 300, 301, 302)]
    assert sorted(got) == sorted(want)
    assert token_files.read_some(spark, folder, [-5]).collect() == []


def test_looking_up_agrees_with_reading_all(spark, folder):
    every = token_files.read(spark, folder).where("doc_id is not null").select("doc_id", "ids")
    some = token_files.read_some(spark, folder, [d for d, _ in TEXTS if d is not None])
    assert every.exceptAll(some).count() == 0 and some.exceptAll(every).count() == 0


def test_offsets_are_gapless_in_ascending_order(spark, folder):
    rows = sorted(token_files.read(spark, folder).collect(), key=lambda r: r["start"])
    at = 0
    for r in rows:
        assert r["start"] == at and len(r["ids"]) == 4 * r["n_tokens"]
        at += r["n_tokens"]
    ids = [r["doc_id"] for r in rows]
    assert ids[0] is None and ids[1:] == sorted(ids[1:])


def test_a_wrong_dictionary_is_refused(spark, folder):
    other = os.path.join(tempfile.mkdtemp(prefix="token-files-"), "files")
    named, _ = spark.read.parquet(f"{folder}/dictionary").first()
    spark.createDataFrame([(named, b"not it")], "dictionary string, bytes binary").write.parquet(f"{other}/dictionary")
    os.symlink(f"{folder}/blocks", f"{other}/blocks")
    os.symlink(f"{folder}/manifest", f"{other}/manifest")
    for read in (lambda: token_files.read(spark, other), lambda: token_files.read_some(spark, other, [1])):
        with pytest.raises(ValueError, match="does not have its hash"):
            read()
    assert glob.glob(f"{folder}/blocks/*.parquet")


def test_the_sample_is_bounded_and_reruns_agree(spark):
    rows = spark.range(9000).select((F.col("id") % 3).alias("doc_id"), F.concat(F.lit("text "), F.col("id") % 4000).alias("text"))
    one = token_files.sample(rows, PATH, 2, 2)
    assert one == token_files.sample(rows.repartition(5), PATH, 2, 2)
    assert 200 < len(one) <= 4 * token_files.SAMPLE_DOCS
    same = spark.range(50_000).selectExpr("1L AS doc_id", "'one text' AS text")
    assert len(token_files.sample(same, PATH, 2, 2)) <= 4 * token_files.SAMPLE_DOCS


def test_rows_without_an_id_or_with_one_id(spark):
    folder = os.path.join(tempfile.mkdtemp(prefix="token-files-"), "files")
    rows = [(None, f"t {i}") for i in range(40)] + [(5, f"u {i}") for i in range(40)]
    token_files.write(spark.createDataFrame(rows, "doc_id long, text string"), folder, PATH, block_bytes=50)
    got = token_files.read(spark, folder).collect()
    assert sorted(str(r["doc_id"]) for r in got) == sorted(str(d) for d, _ in rows)
    assert token_files.read_some(spark, folder, [5]).count() == 40
