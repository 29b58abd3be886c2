"""Best-fit packing by a plan over lengths.

Documents are encoded once; only lengths, places and checksums go on. The plan is made
over the histogram of lengths (at most ``max_len`` rows): best-fit decreasing over counts,
where bins of equal contents are one range of sequence numbers. Each length gets slots
``(rank from, rank to, first sequence, items a sequence, offset)``; documents take them by
their rank within their length, which is counted in buckets so that a hot length needs no
single task.
"""

from __future__ import annotations

import functools
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.llm.common import pick, stored
from shelfwise.llm.tokens import WordEncoder, gathered

MAX_LEN = 2048
SEPARATOR = 0
#: Rows of one length that one bucket ranks, on average.
BUCKET_ROWS = 20_000

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def cuts(n: int, most: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` ids: whole ones, the first may be shorter."""
    first = n % most
    return [(0, first)] * bool(first) + [(s, most) for s in range(first, n, most)]


def pieces_of(path: str, max_len: int, separator: int):
    def run(batches):
        end = np.array([separator], "<u4").tobytes()
        enc = encoder(path)
        for t in gathered(batches):
            out = []
            for doc_id, coded in zip(t.column(0).to_pylist(), enc.encode(t.column(1).combine_chunks()), strict=True):
                coded += end
                out += [(doc_id, k, s, n, zlib.crc32(coded[4 * s:4 * (s + n)]))
                        for k, (s, n) in enumerate(cuts(len(coded) // 4, max_len))]
            cols = list(zip(*out, strict=True)) or [[]] * 5
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)],
                                             ["doc_id", "piece", "start", "length", "ids_crc32"])
    return run


def plan(histogram: dict[int, int], max_len: int) -> list[tuple[int, int, int, int, int, int]]:
    """Slots (length, rank from, rank to, first sequence, items a sequence, offset).

    Lengths go from long to short. Open sequences are ranges by the room that is left;
    the tightest room that fits is filled first, with as many items as fit. A length
    splits at most one range, so ranges stay few, however many documents there are.
    """
    room: list[list[tuple[int, int]]] = [[] for _ in range(max_len + 1)]
    slots, used = [], 0
    for length in sorted((x for x, n in histogram.items() if n), reverse=True):
        left, rank = histogram[length], 0

        def fill(first: int, count: int, r: int) -> tuple[int, int]:
            """Fill sequences with room ``r``; gives what is left of the range."""
            nonlocal left, rank
            each = r // length
            for items, bins in ((each, min(count, left // each)), (left % each, 1)):
                if items and bins and count and left >= items and (items == each or left < each):
                    slots.append((length, rank, rank + items * bins, first, items, max_len - r))
                    room[r - items * length].append((first, bins))
                    rank, left = rank + items * bins, left - items * bins
                    first, count = first + bins, count - bins
            return first, count

        for r in range(length, max_len):
            open_, room[r] = room[r], []
            while open_:
                first, count = fill(*open_.pop(), r) if left else open_.pop()
                if count:
                    room[r].append((first, count))
            if not left:
                break
        if left:
            need = -(-left // (max_len // length))
            fill(used, need, max_len)
            used += need
    return slots


def placed(slots: list[tuple[int, ...]]):
    """Adds each row's sequence and offset, from its length and its rank within that length."""
    table = np.array(sorted(slots), np.int64).reshape(-1, 6)
    keys = table[:, 0] * (1 << 48) + table[:, 1]

    def run(batches):
        for b in batches:
            length, rank = (b.column(b.schema.names.index(c)).to_numpy() for c in ("length", "rank"))
            s = table[np.searchsorted(keys, length * (1 << 48) + rank, "right") - 1]
            k = rank - s[:, 1]
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:5], pa.array(s[:, 3] + k // s[:, 4]), pa.array(s[:, 5] + k % s[:, 4] * length)],
                [*b.schema.names[:5], "sequence_id", "offset"])
    return run


def pack(docs: DataFrame, path: str, max_len: int = MAX_LEN, separator: int = SEPARATOR,
         bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """One row for each piece of each row of ``docs``: doc_id, piece, start, length,
    ids_crc32, sequence_id, offset.

    A text's ids end with ``separator``, so a null or empty text is a piece of length 1.
    Null and repeated doc_ids are packed like others; an empty table gives no rows; other
    columns are not read. Ties within a length are broken by the stored row order.
    """
    pieces = stored(pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), "text")
                    .mapInArrow(pieces_of(path, max_len, separator), PIECES)
                    .withColumn("row", F.monotonically_increasing_id()), "pieces")
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    buckets = 1 + sum(histogram.values()) // bucket_rows
    rows = pieces.withColumn("bucket", F.pmod(F.xxhash64("row"), F.lit(buckets)))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = rows.groupBy("length", "bucket").agg(F.count("*").alias("n")).select(
        "length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ahead"))
    within = Window.partitionBy("length", "bucket").orderBy("row")
    ranked = rows.withColumn("k", F.row_number().over(within) - 1).join(offsets, ["length", "bucket"])
    ranked = ranked.select("doc_id", "piece", "start", "length", "ids_crc32",
                           (F.col("ahead") + F.col("k")).cast("long").alias("rank"))
    return ranked.mapInArrow(placed(plan(histogram, max_len)), f"{PIECES}, sequence_id long, offset long")
