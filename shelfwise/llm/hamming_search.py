"""Exact top-k search over binary codes with incremental multi-index hashing.

A 64-bit code is cut into segments of about log2(number of codes) bits, each an index of
its own. Radii grow one segment at a time: a step looks up, in one segment, all values that
differ from the query's in exactly so many bits. A code that no step has found differs from
the query in more bits than the radius in each segment, so after ``n`` steps every code
within Hamming distance ``n - 1`` has been seen. A query is done once its k-th verified
distance is no more than that; only the others grow on. Where a radius has more values than
the segment has codes, the codes are gone through instead.

Codes are dealt into blocks of bounded size by a hash, and each task builds the index of its
block; queries go to every block and stream past it, and the blocks' k nearest are merged.
Probes never leave the task. Equal codes are one code with its k lowest ids, so that a very
common code costs one row.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.llm.common import pick, stored
from shelfwise.llm.vectors import best

BITS = 64
K = 10
#: Codes of one block, and pairs that are verified at once.
BLOCK_CODES, MOST_PAIRS = 1 << 20, 1 << 21


def sign_code(vector: Column) -> Column:
    """Bit i is set where the vector's i-th number is above 0; at most 64 numbers."""
    bits = F.transform(vector, lambda x, i: F.when(x > 0, F.call_function("shiftleft", F.lit(1).cast("long"), i)).otherwise(F.lit(0).cast("long")))
    return F.aggregate(bits, F.lit(0).cast("long"), lambda a, x: a.bitwiseOR(x))


def segments(n_codes: int) -> list[tuple[int, int]]:
    """(first bit, width) of the segments, of about log2(n_codes) bits."""
    width = min(24, max(8, round(math.log2(max(n_codes, 2)))))
    count = -(-BITS // width)
    edges = [BITS * i // count for i in range(count + 1)]
    return [(a, b - a) for a, b in itertools.pairwise(edges)]


def segment(codes: np.ndarray, first: int, width: int) -> np.ndarray:
    return (codes >> np.uint64(first)) & np.uint64((1 << width) - 1)


class Index:
    """The segments' indexes of one block of distinct codes (unsigned) with their lowest ids."""

    def __init__(self, codes: np.ndarray, ids: np.ndarray) -> None:
        self.codes, self.ids = codes, ids
        self.parts = segments(len(codes))
        self.order, self.values = [], []
        for p in self.parts:
            value = segment(codes, *p)
            order = np.argsort(value, kind="stable")
            self.order.append(order)
            self.values.append(value[order])
        self.masks: dict[tuple[int, int], np.ndarray] = {}

    def mask(self, width: int, radius: int) -> np.ndarray:
        """All values of ``width`` bits of which ``radius`` are set."""
        if (width, radius) not in self.masks:
            self.masks[width, radius] = np.array(
                [sum(1 << b for b in c) for c in itertools.combinations(range(width), radius)], np.uint64)
        return self.masks[width, radius]

    def met(self, queries: np.ndarray, part: int, radius: int):
        """(place of the query, place of the code) of the pairs that differ in exactly ``radius``
        bits of ``part``, some of them at a time."""
        first, width = self.parts[part]
        own, order, values = segment(queries, first, width), self.order[part], self.values[part]
        if math.comb(width, radius) < len(values):
            probes = (own[:, None] ^ self.mask(width, radius)).ravel()
            start = np.searchsorted(values, probes, "left")
            count = np.searchsorted(values, probes, "right") - start
            of = np.repeat(np.arange(len(queries)), len(probes) // len(queries))
            of, start, count = (x[count > 0] for x in (of, start, count))
            ends = np.cumsum(count)
            i = 0
            while i < len(of):  # whole lookups of about MOST_PAIRS pairs
                j = max(i + 1, int(np.searchsorted(ends, (ends[i - 1] if i else 0) + MOST_PAIRS, "right")))
                n = count[i:j]
                places = np.arange(n.sum()) + np.repeat(start[i:j] - (np.cumsum(n) - n), n)
                yield np.repeat(of[i:j], n), order[places]
                i = j
        else:
            at_once = max(1, MOST_PAIRS // len(values))
            for i in range(0, len(queries), at_once):
                q, place = np.nonzero(np.bitwise_count(own[i:i + at_once, None] ^ values) == radius)
                yield q + i, order[place]

    def first_met(self, a: np.ndarray, b: np.ndarray, part: int, radius: int) -> np.ndarray:
        """Whether no earlier step has met the pairs of codes ``a`` and ``b``: no part differs in
        fewer bits than ``radius``, and no earlier part in as few."""
        apart = a ^ b
        new = np.ones(len(a), bool)
        for q, p in enumerate(self.parts):
            if q != part:
                bits = np.bitwise_count(segment(apart, *p))
                new &= (bits > radius) if q < part else (bits >= radius)
        return new

    def nearest(self, queries: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
        """(place of the query, place of the code, distance) of each query's ``k`` nearest codes,
        by distance, then lowest id; and the number of pairs verified."""
        held = [np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)]
        far = np.full(len(queries), BITS + 1)  # the k-th distance held
        going, verified = np.arange(len(queries)), 0
        steps = [(r, p) for r in range(max(w for _, w in self.parts) + 1) for p, (_, w) in enumerate(self.parts) if r <= w]
        for step, (radius, part) in enumerate(steps):
            for q, c in self.met(queries[going], part, radius):
                q = going[q]
                distance = np.bitwise_count(queries[q] ^ self.codes[c]).astype(np.int64)
                verified += len(q)
                near = distance <= far[q]
                q, c, distance = q[near], c[near], distance[near]
                new = self.first_met(queries[q], self.codes[c], part, radius)
                held = [np.concatenate(x) for x in zip(held, (q[new], c[new], distance[new]), strict=True)]
                keep = best(held[0], -held[2], self.ids[held[1]], held[1], k)
                held = [h[keep] for h in held]
                owner, first, count = np.unique(held[0], return_index=True, return_counts=True)
                full = count >= k
                far[owner[full]] = held[2][first[full] + k - 1]
            found = np.bincount(held[0], minlength=len(queries))
            going = going[(far[going] > step) & (found[going] < len(self.codes))]
            if not len(going):
                break
        return *held, verified


def searched(k: int):
    """Streams rows sorted by block, codes before queries; gives each query's nearest of the block."""
    def run(batches):
        current, codes, lists, index = None, [], [], None
        for b in batches:
            col = {n: b.column(i) for i, n in enumerate(b.schema.names)}
            key = np.stack([col["block"].to_numpy(), col["kind"].to_numpy()])
            edges = [0, *(np.flatnonzero((np.diff(key, axis=1) != 0).any(axis=0)) + 1).tolist(), b.num_rows]
            for i, j in itertools.pairwise(edges):
                if i == j:
                    continue
                if key[0, i] != current:
                    current, codes, lists, index = key[0, i], [], [], None
                if key[1, i] == 0:
                    codes.append(col["code"].slice(i, j - i).to_numpy())
                    lists.append(col["ids"].slice(i, j - i))
                    continue
                if not codes:
                    continue  # no code was dealt to this block
                if index is None:
                    ids = pa.concat_arrays(lists)
                    first = ids.flatten().to_numpy()[(ids.offsets.to_numpy() - ids.offsets[0].as_py())[:-1]]
                    index = Index(np.concatenate(codes).view(np.uint64), first)
                code, own = (col[n].slice(i, j - i) for n in ("code", "ids"))
                query, code = own.flatten().to_numpy(), code.to_numpy()
                q, c, distance, _ = index.nearest(code.view(np.uint64), k)
                near = ids.take(pa.array(c))
                times = np.diff(near.offsets.to_numpy())
                q, distance, id_ = np.repeat(q, times), np.repeat(distance, times), near.flatten().to_numpy()
                keep = best(q, -distance, id_, id_, k)
                q, distance, id_ = q[keep], distance[keep], id_[keep]
                yield pa.RecordBatch.from_arrays([pa.array(query[q]), pa.array(code[q]), pa.array(distance.astype(np.int32)), pa.array(id_)],
                                                 ["query", "query_code", "distance", "id"])
    return run


def search(items: DataFrame, queries: DataFrame, k: int = K, blocks: int | None = None) -> DataFrame:
    """The ``k`` rows of ``items`` (id, code) nearest each row of ``queries`` (id, code).

    Returns query_id, rank (from 1), neighbor_id, distance. Ties go to the lower id; a
    query that is among the items finds itself. Rows with a null id or code take no part,
    repeated ids of one code count once, and fewer than ``k`` items are all returned. An
    empty side gives no rows; other columns are not read.

    ``blocks`` changes the cost, not the result; by default there are no more blocks than
    keep the queries' rows below those of the codes, unless memory needs more.
    """
    spark = items.sparkSession
    items = pick(items, "id", "code").dropna().select(F.col("id").cast("long").alias("id"), F.col("code").cast("long").alias("code")).distinct()
    queries = stored(pick(queries, "id", "code").dropna().select(
        F.col("id").cast("long").alias("query"), F.col("code").cast("long").alias("query_code")).distinct(), "queries")
    first = Window.partitionBy("code").orderBy("id")
    lowest = items.withColumn("nth", F.row_number().over(first)).where(F.col("nth") <= k)
    codes = stored(lowest.groupBy("code").agg(F.array_sort(F.collect_list("id")).alias("ids")), "codes")
    n, asked = codes.count(), queries.count()
    if not n or not asked:
        return spark.createDataFrame([], "query_id long, rank int, neighbor_id long, distance int")
    if blocks is None:
        blocks = max(-(-n // BLOCK_CODES), min(spark.sparkContext.defaultParallelism, -(-n // asked)))
    dealt = codes.select(F.pmod(F.xxhash64("code"), F.lit(blocks)).cast("int").alias("block"), F.lit(0).alias("kind"), "code", "ids").unionByName(
        queries.select(F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.lit(1).alias("kind"),
                       F.col("query_code").alias("code"), F.array("query").alias("ids")))
    dealt = dealt.repartitionById(blocks, F.col("block")).sortWithinPartitions("block", "kind")
    found = dealt.mapInArrow(searched(k), "query long, query_code long, distance int, id long")
    rank = Window.partitionBy("query", "query_code").orderBy("distance", "id")
    ranked = found.withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= k)
    return ranked.select(F.col("query").alias("query_id"), "rank", F.col("id").alias("neighbor_id"), "distance")
