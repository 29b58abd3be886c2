"""Token-id files: blocks of documents, each compressed for itself with one shared dictionary.

The format is a folder of two Parquet tables, written by Spark's committers to any store.
``dictionary`` has one row: the zstandard dictionary and its sha256. ``blocks`` has one row
for each block of consecutive documents: where it stands, the dictionary's hash, one entry
for each document (doc_id, number of ids, offset in the block) and the frames one after
another. A document is read by slicing its frame out of its block. Ids are stored as
little-endian unsigned 16-bit integers where the vocabulary allows it, else 32-bit.

Blocks keep starts relative to their range of doc_ids; ``manifest`` has the number of ids
of each range, and starts are absolute once the ranges before are added up.
"""

from __future__ import annotations

import bisect
import functools
import hashlib
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfwise.llm.common import partitions, pick, shared_folder
from shelfwise.llm.tokens import WordEncoder, gathered

END = 2
#: The dictionary is trained on about this many documents, of each at most so many bytes of ids.
SAMPLE_DOCS, SAMPLE_BYTES, DICTIONARY_BYTES = 1000, 16_384, 64 * 1024
#: Bytes of text that a task encodes at once: their ids and frames are held beside them.
GATHERED_BYTES = 16_000_000
#: Bytes of frames after which a block ends.
BLOCK_BYTES = 1 << 20

BLOCKS = ("range int, first_start long, dictionary string, width int, doc_ids array<long>, "
          "n_tokens array<long>, offsets array<long>, frames binary")


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    return WordEncoder(path, most_words=500_000)


def id_width(path: str) -> int:
    return 2 if encoder(path).library.get_vocab_size() <= 1 << 16 else 4


def serialised(path: str, texts: pa.Array | list[str | None], end: int, width: int):
    """Each text's ids with the end id, in the stored width."""
    tail = np.array([end], "<u4").tobytes()
    for coded in encoder(path).encode(texts):
        yield np.frombuffer(coded + tail, "<u4").astype(f"<u{width}").tobytes()


def sample(docs: DataFrame, path: str, end: int, width: int) -> list[bytes]:
    """Serialised ids of about SAMPLE_DOCS rows that a hash of doc_id and text picks, for the
    dictionary only; encoded where they lie. Repeated rows are picked together, the lowest
    hashes first and 4 * SAMPLE_DOCS at most."""
    n = docs.count()
    keyed = docs.select("text", F.xxhash64("doc_id", "text").alias("key"))
    picked = keyed.where(F.pmod("key", F.lit(1 << 20)) < (SAMPLE_DOCS << 20) // max(n, 1) + 1)

    def run(batches):
        for b in batches:
            texts = [t and t[:SAMPLE_BYTES] for t in b.column(0).to_pylist()]
            ids = [x[:SAMPLE_BYTES] for x in serialised(path, texts, end, width)]
            yield pa.RecordBatch.from_arrays([b.column(1), pa.array(ids, pa.binary())], ["key", "ids"])
    coded = picked.mapInArrow(run, "key long, ids binary").orderBy("key", "ids").limit(4 * SAMPLE_DOCS)
    return sorted(bytes(r["ids"]) for r in coded.select("ids").collect())


def train(samples: list[bytes]) -> bytes:
    """A dictionary; an empty one where the samples are too few or too short for one."""
    import zstandard

    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, k=256, d=8).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b""


def compressor(dictionary: bytes):
    import zstandard

    return zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(dictionary)) if dictionary else zstandard.ZstdCompressor(level=3)


def decompressor(dictionary: bytes):
    import zstandard

    return zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary)) if dictionary else zstandard.ZstdDecompressor()


def frames(path: str, dictionary: bytes, bounds: list[int], end: int, width: int):
    def run(batches):
        pack = compressor(dictionary)
        for t in gathered(batches, GATHERED_BYTES):
            ids, raw = t.column(0).to_pylist(), list(serialised(path, t.column(1).combine_chunks(), end, width))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array([len(x) // width for x in raw], pa.int64()),
                 pa.array([0 if d is None else bisect.bisect_right(bounds, d) for d in ids], pa.int32()),
                 pa.array([pack.compress(x) for x in raw], pa.binary())], ["doc_id", "n_tokens", "range", "frame"])
    return run


def blocks(dictionary_hash: str, width: int, block_bytes: int):
    """Blocks of the rows of a partition, which come by range and doc_id."""
    def run(batches):
        held, size, start, at = [], 0, 0, None

        def block():
            offsets = np.concatenate([[0], np.cumsum([len(f) for _, _, f in held])])[:-1]
            return pa.RecordBatch.from_arrays(
                [pa.array([at], pa.int32()), pa.array([start], pa.int64()), pa.array([dictionary_hash]),
                 pa.array([width], pa.int32()), pa.array([[d for d, _, _ in held]], pa.list_(pa.int64())),
                 pa.array([[n for _, n, _ in held]], pa.list_(pa.int64())),
                 pa.array([offsets.tolist()], pa.list_(pa.int64())), pa.array([b"".join(f for _, _, f in held)], pa.binary())],
                [f.split(" ")[0] for f in BLOCKS.split(", ")])

        for b in batches:
            for doc_id, n, r, frame in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if held and (r != at or size >= block_bytes):
                    yield block()
                    start = start + sum(n_ for _, n_, _ in held) if r == at else 0
                    held, size = [], 0
                elif r != at:
                    start = 0
                at = r
                held.append((doc_id, n, frame))
                size += len(frame)
        if held:
            yield block()
    return run


def write(docs: DataFrame, folder: str, path: str, end: int = END, block_bytes: int = BLOCK_BYTES) -> None:
    """Write the rows of ``docs`` in ascending doc_id order (nulls first) to a new ``folder``.

    Ranges of doc_ids are cut at quantiles, so that each text is encoded once and only its
    frame is shuffled. Rows with equal doc_ids stand in the order of their frames. A null
    text is an empty one; an empty table gives files without blocks.
    """
    spark = docs.sparkSession
    docs = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), "text")
    width = id_width(path)
    dictionary = train(sample(docs, path, end, width))
    named = hashlib.sha256(dictionary).hexdigest()
    spark.createDataFrame([(named, dictionary)], "dictionary string, bytes binary").coalesce(1).write.parquet(f"{folder}/dictionary")
    n = partitions(spark)
    cuts = docs.select(F.percentile_approx("doc_id", [k / n for k in range(1, n)] or [0.5], 10_000)).first()[0]
    bounds = sorted(set(cuts or []))
    rows = docs.mapInArrow(frames(path, dictionary, bounds, end, width),
                           "doc_id long, n_tokens long, range int, frame binary")
    rows = rows.repartition(n, "range").sortWithinPartitions("range", "doc_id", "frame").select("doc_id", "n_tokens", "range", "frame")
    rows.mapInArrow(blocks(named, width, block_bytes), BLOCKS).write.option("compression", "uncompressed").parquet(f"{folder}/blocks")
    spark.read.schema(BLOCKS).parquet(f"{folder}/blocks").select("range", F.aggregate(
        "n_tokens", F.lit(0).cast("long"), lambda a, x: a + x).alias("n")).groupBy("range").agg(
        F.sum("n").alias("n_tokens")).write.parquet(f"{folder}/manifest")


def read(spark: SparkSession, folder: str) -> DataFrame:
    """One row for each document of the files: doc_id, start, ids (little-endian, 32 bits each)."""
    named, dictionary = spark.read.parquet(f"{folder}/dictionary").first()
    if hashlib.sha256(dictionary).hexdigest() != named:
        raise ValueError(f"{folder}: the dictionary does not have its hash")
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sums = spark.read.schema("range int, n_tokens long").parquet(f"{folder}/manifest")  # a row for each range
    bases = sums.select("range", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("base"))
    rows = spark.read.schema(BLOCKS).parquet(f"{folder}/blocks").join(F.broadcast(bases), "range")

    def run(batches):
        unpack = decompressor(bytes(dictionary))
        for b in batches:
            for row in b.to_pylist():
                if row["dictionary"] != named:
                    raise ValueError(f"{folder}: a block names another dictionary")
                n = np.array(row["n_tokens"], np.int64)
                starts = row["base"] + row["first_start"] + np.cumsum(n) - n
                ends = [*row["offsets"][1:], len(row["frames"])]
                ids = [np.frombuffer(unpack.decompress(row["frames"][i:j]), f"<u{row['width']}").astype("<u4").tobytes()
                       for i, j in zip(row["offsets"], ends, strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(row["doc_ids"], pa.int64()), pa.array(starts), pa.array(n), pa.array(ids, pa.binary())],
                                                 ["doc_id", "start", "n_tokens", "ids"])
    return rows.mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary")


def read_some(spark: SparkSession, folder: str, doc_ids: list[int]) -> DataFrame:
    """(doc_id, ids) of just these documents: the offset index finds each one's frame in its
    block, and nothing else is cut out or decompressed. A repeated doc_id gives all its rows,
    one that is not in the files none."""
    named, dictionary = spark.read.parquet(f"{folder}/dictionary").first()
    if hashlib.sha256(dictionary).hexdigest() != named:
        raise ValueError(f"{folder}: the dictionary does not have its hash")
    wanted = F.array(*(F.lit(int(d)) for d in doc_ids)).cast("array<long>")
    blocks_ = spark.read.schema(BLOCKS).parquet(f"{folder}/blocks").where(F.arrays_overlap("doc_ids", wanted))
    end = F.concat(F.slice("offsets", 2, F.greatest(F.size("offsets") - 1, F.lit(0))), F.array(F.length("frames").cast("long")))
    places = F.filter(F.arrays_zip(F.col("doc_ids").alias("doc_id"), F.col("offsets").alias("at"), end.alias("end")),
                      lambda x: F.array_contains(wanted, x["doc_id"]))
    found = blocks_.select("dictionary", "width", "frames", F.explode(places).alias("place")).select(
        "dictionary", "width", F.col("place.doc_id").alias("doc_id"),
        F.substring("frames", F.col("place.at").cast("int") + 1, (F.col("place.end") - F.col("place.at")).cast("int")).alias("frame"))

    def run(batches):
        unpack = decompressor(bytes(dictionary))
        for b in batches:
            ids = []
            for row in b.to_pylist():
                if row["dictionary"] != named:
                    raise ValueError(f"{folder}: a block names another dictionary")
                ids.append(np.frombuffer(unpack.decompress(row["frame"]), f"<u{row['width']}").astype("<u4").tobytes())
            yield pa.RecordBatch.from_arrays([b.column(2), pa.array(ids, pa.binary())], ["doc_id", "ids"])
    return found.mapInArrow(run, "doc_id long, ids binary")


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """Write ``docs``, read the files back: doc_id, start, n_tokens, ids_crc32."""
    spark = docs.sparkSession
    folder = f"{shared_folder(spark)}/llm-token-files-{uuid.uuid4().hex}"
    write(docs, folder, path)

    return read(spark, folder).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
