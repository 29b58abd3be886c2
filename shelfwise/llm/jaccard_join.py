"""Exact n-gram Jaccard join with pivots, regions and triangle-inequality windows.

Distance 1 - |A n B| / |A u B| is a metric on shingle sets, and so is |A ^ B|. Two sets
link when their similarity is at least num / den, that is within a distance tau.

Rings. The empty set is the first pivot: |A ^ {}| is A's size, so a ring holds sizes from
low to up, and by the triangle inequality a set links with one of the next ring only if
its size lies in a window below that ring's low end; sets there are replicated into it.

Regions. Two sets of a ring differ in at most d shingles. The shingle universe is dealt
into m = d + 1 + slack parts; |A ^ B| is the sum of its parts, so linked sets agree in at
least slack + 1 parts. A region is a ring's part with given contents, and each set lies in
the regions of its parts (all but its smallest, at most ``slack`` of them: of slack + 1
shared parts one is left on both sides). Pivots that are documents alone do not do here:
nearly all texts have distance 1 from all others, so they would lie in one region.

Pivots. A region's pivot is its lowest doc_id, and every set's distance to its pivot is
known, exactly where the two can link, else from below. Sets within tau of a pivot are one component by way of it and need no pairs
among themselves. Of the others, only sets of different components whose distances to the
pivot differ by at most tau (the window) are compared.

Large regions. Where more than ``most`` sets of a region are left, regions of one pivot are
joined as one. If they hold more than a block, each set goes to the cell of its size and of
its distance to the pivot, and large cells are dealt into blocks of bounded size. By the
triangle inequality a block meets only blocks of its own window of cells, and two blocks
that lie within tau of the pivot need not meet at all. Sketches meet first; the sets that
may link with another go into a second meeting, one matrix product, which gives back no
more than an edge for each of its sets.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.llm import common
from shelfwise.llm.common import Marks, at, marked, pick, unmarked

SHINGLE, NUM, DEN = 4, 85, 100
#: Ring width as a ratio of sizes; parts that may be left out, as a share of the differences.
RATIO, SLACK = 0.7, 0.2
#: Sets of a region whose pairs are compared one by one; larger regions meet in blocks.
MOST = 48
#: Cells of distance to a pivot; sets and shingles of a block.
CELL, BLOCK_SETS, BLOCK_ITEMS = 0.05, 1024, 1 << 20

#: Least buckets of a sketch: a set's shingle counts, at most 255, by the top bits of their
#: hashes. Larger sets have a quarter to half as many buckets as shingles; of two sketches
#: the longer is folded to the shorter. The sum of their differences is at most |A ^ B|, so
#: most pairs that cannot link are known without their sets.
SKETCH = 256
#: A write with this set deletes its shuffle files when it ends.
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``common.stored``, of which no shuffle file stays."""
    spark = df.sparkSession
    old = spark.conf.get(DROP_SHUFFLES, None)
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        return common.stored(df, name)
    finally:
        spark.conf.unset(DROP_SHUFFLES) if old is None else spark.conf.set(DROP_SHUFFLES, old)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: equal in, equal out, else as good as random."""
    x = (x ^ (x >> np.uint64(30))) * _MIX[1]
    x = (x ^ (x >> np.uint64(27))) * _MIX[2]
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None, k: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's k-word shingles (of all its words, if fewer)."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: ASCII only
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    w = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, n)
    k = min(k, n)
    h = np.full(n - k + 1, k, np.uint64)
    for i in range(k):
        h = mixed(h * _MIX[0] + w[i:n - k + 1 + i])
    return np.unique(h)


class Rings:
    """Rings of set sizes: (low, up, parts, slack)."""

    def __init__(self, num: int, den: int) -> None:
        self.num, self.den, self.all = num, den, []
        up = 0
        while self.differences(up + 1) == 0:
            up += 1
        self.add(1, max(up, 1))

    def differences(self, up: int) -> int:
        """Most shingles in which two linked sets of at most ``up`` shingles can differ."""
        return 2 * up * (self.den - self.num) // (self.den + self.num)

    def add(self, low: int, up: int) -> None:
        d = self.differences(up)
        slack = int((d + 1) * SLACK)
        self.all.append((low, up, d + 1 + slack, slack))

    def of(self, n: int):
        """Numbers of the rings that a set of ``n`` shingles lies in: its own, and by their windows."""
        while self.all[-1][0] * self.num <= n * self.den:
            up = self.all[-1][1]
            self.add(up + 1, max(up + 1, int(up / RATIO)))
        first = next(i for i, r in enumerate(self.all) if n <= r[1])
        i = first
        while i == first or self.all[i][0] * self.num <= n * self.den:
            yield i
            i += 1


def regions(h: np.ndarray, rings: Rings) -> np.ndarray:
    """Keys of the regions that a set lies in."""
    x = mixed(h)
    low, high = (x & np.uint64(0xFFFFFFFF)).astype(np.float64), (x >> np.uint64(32)).astype(np.float64)
    out = []
    for i in rings.of(len(h)):
        _, _, m, slack = rings.all[i]
        part = (x % np.uint64(m)).astype(np.int64)
        n = np.bincount(part, minlength=m)
        smaller = np.searchsorted(np.cumsum(np.bincount(n)), slack, "right") - 1  # sizes that may be left out
        keep = np.flatnonzero(n > smaller)
        content = np.bincount(part, low, m)[keep].astype(np.uint64) + (np.bincount(part, high, m)[keep].astype(np.uint64) << np.uint64(32))
        place = keep.astype(np.uint64) + np.uint64((i + 1) << 32)
        out.append(mixed(mixed(content + n[keep].astype(np.uint64)) + place * _MIX[0]))
    return np.concatenate(out).view(np.int64)


def described(k: int, rings: Rings):
    """(doc_id, n_shingles, digest, regions) of (doc_id, text)."""
    def run(batches):
        for b in batches:
            n, digest, keys = [], [], []
            for text in b.column(1).to_pylist():
                h = shingles(text, k)
                n.append(len(h))
                digest.append(xxhash.xxh3_128_digest(h.tobytes()) if len(h) else None)
                keys.append(regions(h, rings) if len(h) else np.empty(0, np.int64))
            ends = np.concatenate([[0], np.cumsum([len(x) for x in keys])]).astype(np.int32)
            flat = np.concatenate([*keys, np.empty(0, np.int64)])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.array(digest, pa.binary()), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))],
                ["doc_id", "n_shingles", "digest", "regions"])
    return run


DESCRIBED = "doc_id long, n_shingles long, digest binary, regions array<long>"


def sketch(h: np.ndarray) -> np.ndarray:
    """A set's sketch, as bytes."""
    bits = max(SKETCH.bit_length() - 1, len(h).bit_length() - 2)
    return np.minimum(np.bincount((h >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits), 255).astype(np.uint8)


def folded(sketches: list[np.ndarray], buckets: int) -> np.ndarray:
    """Sketches of at least ``buckets`` buckets as rows of that many, in int16."""
    return np.array([x if len(x) == buckets else np.minimum(x.reshape(buckets, -1).sum(1), 255) for x in sketches], np.int16).reshape(-1, buckets)


def of_texts(ids: DataFrame, texts: DataFrame, k: int, schema: str, columns) -> DataFrame:
    """``schema`` of the documents ``ids`` (and of few others), made anew from their texts, which
    are not shuffled for it; ``columns`` gives all but the doc_id of a list of sets."""
    marks = Marks(ids, "doc_id")
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches):
        for b in batches:
            b = b.filter(pa.array(marks.have(b.column(2).to_numpy())))
            yield pa.RecordBatch.from_arrays([b.column(0), *columns([shingles(t, k) for t in b.column(1).to_pylist()])], names)
    placed = texts.where("doc_id is not null").select("doc_id", "text", Marks.place("doc_id").alias("place"))
    return placed.mapInArrow(run, schema)


def sketches_of(ids: DataFrame, texts: DataFrame, k: int) -> DataFrame:
    """(doc_id, n, sketch) of ``ids`` and few others, stored."""
    return stored(of_texts(ids, texts, k, "doc_id long, n long, sketch binary", lambda sets: [
        pa.array(map(len, sets), pa.int64()), pa.array([sketch(h).tobytes() for h in sets], pa.binary())]), "sketches")


def sets_of(ids: DataFrame, texts: DataFrame, k: int) -> DataFrame:
    """(doc_id, items) of ``ids`` and few others."""
    return of_texts(ids, texts, k, "doc_id long, items binary", lambda sets: [pa.array([h.tobytes() for h in sets], pa.binary())])


def uncopied(rows: DataFrame, copies: DataFrame) -> tuple[DataFrame, Marks]:
    """(doc_id, regions, stays, place) of ``rows``, and the bitmap of the ``copies`` (doc_id,
    digest): what it does not rule out is no copy, nor is what ``stays``. Only rows that it
    rules out are shuffled; copies among them are nowhere."""
    row = F.xxhash64("doc_id", "digest")
    marks = Marks(copies.select(row.alias("row")), "row")

    def run(batches):
        for b in batches:
            yield b.filter(pa.array(marks.have(b.column(3).to_numpy()))).select(["doc_id", "digest", "regions"])
    placed = rows.select("doc_id", "digest", "regions", Marks.place(row).alias("place"))
    schema = "doc_id long, digest binary, regions array<long>"
    others = stored(placed.mapInArrow(run, schema).join(copies, ["doc_id", "digest"], "left_anti"), "others")
    return placed.select("doc_id", "regions", F.lit(False).alias("stays"), "place").unionByName(
        others.select("doc_id", "regions", F.lit(True).alias("stays"), F.lit(0).cast("long").alias("place"))), marks


def staying(batches, marks: Marks):
    """(doc_id, regions) of what ``uncopied`` gives, without what the bitmap rules out."""
    for b in batches:
        gone = marks.have(b.column(3).to_numpy()) & ~b.column(2).to_numpy(zero_copy_only=False)
        yield b.filter(pa.array(~gone)).select(["doc_id", "regions"])


def colliding(rows: DataFrame, copied: Marks, keys: DataFrame) -> DataFrame:
    """(doc_id, key) of the regions of ``uncopied`` rows that are among ``keys`` (and few others).

    Copies leave in the same Python worker: one more in each task would hold its memory on."""
    low = (1 << Marks.BITS) - 1  # keys are hashes: their low bits are places
    marks = Marks(keys, "key", F.col("key").bitwiseAND(F.lit(low)))

    def run(batches):
        for b in staying(batches, copied):
            key = b.column(1).flatten().to_numpy()
            mine = marks.have(key & low)
            owner = np.repeat(b.column(0).to_numpy(), b.column(1).value_lengths().to_numpy())
            yield pa.RecordBatch.from_arrays([pa.array(owner[mine], pa.int64()), pa.array(key[mine], pa.int64())], ["doc_id", "key"])
    return rows.mapInArrow(run, "doc_id long, key long")


def shared(batches):
    """(a, b, distance, n_a, n_b, common) of (a, b, items_a, items_b)."""
    for batch in batches:
        common, na, nb = [], [], []
        for x, y in zip(batch.column(2), batch.column(3), strict=True):
            x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
            small, large = (x, y) if len(x) <= len(y) else (y, x)
            at_ = np.minimum(np.searchsorted(large, small), len(large) - 1)
            common.append(int(np.count_nonzero(large[at_] == small)))
            na.append(len(x))
            nb.append(len(y))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(na, pa.int64()), pa.array(nb, pa.int64()),
                                          pa.array(common, pa.int64())], ["a", "b", "n_a", "n_b", "common"])


def apart(batches):
    """(a, b, n_a, n_b, least) of (a, b, n_a, n_b, sketch_a, sketch_b); least: of shingles in which they differ."""
    for b in batches:
        x, y = ([np.frombuffer(v.as_buffer(), np.uint8) for v in b.column(c)] for c in (4, 5))
        buckets = np.array([min(len(i), len(j)) for i, j in zip(x, y, strict=True)], np.int64)
        least = np.zeros(len(x), np.int64)
        for n in np.unique(buckets):
            mine = np.flatnonzero(buckets == n)
            least[mine] = abs(folded([x[i] for i in mine], n) - folded([y[i] for i in mine], n)).sum(1, dtype=np.int64)
        yield pa.RecordBatch.from_arrays([*b.columns[:4], pa.array(least)], ["a", "b", "n_a", "n_b", "least"])


def compared(pairs: DataFrame, sketches: DataFrame, texts: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """``pairs`` (a, b) with their sizes, overlap, whether they link, and bounds of their
    distance, stored: (a, b, n_a, n_b, common, linked, low, high).

    Pairs whose sketches show that they cannot link are not compared (common is null, the
    bounds lie apart); the sets of the others are made anew from ``texts``.
    """
    x, y = (sketches.select(F.col("doc_id").alias(c), F.col("n").alias(f"n_{c}"), F.col("sketch").alias(f"s_{c}")) for c in "ab")
    sketched = pairs.join(x, "a").join(y, "b").select("a", "b", "n_a", "n_b", "s_a", "s_b").mapInArrow(
        apart, "a long, b long, n_a long, n_b long, least long")
    total = F.col("n_a") + F.col("n_b")
    can = F.col("least") * (den + num) <= total * (den - num)
    sketched = stored(sketched.withColumn("open", can), "sketched")
    open_ = sketched.where("open").select("a", "b").distinct()
    near = sets_of(open_.select(F.col("a").alias("doc_id")).union(open_.select("b")), texts, k)
    x, y = (near.select(F.col("doc_id").alias(c), F.col("items").alias(f"i_{c}")) for c in "ab")
    both = open_.join(x, "a").join(y, "b").select("a", "b", "i_a", "i_b")
    exact = both.mapInArrow(shared, "a long, b long, n_a long, n_b long, common long")
    known = exact.select("*", (1 - F.col("common") / (total - F.col("common"))).alias("low"))
    known = known.select("a", "b", "n_a", "n_b", "common", (F.col("common") * den >= (total - F.col("common")) * num).alias("linked"), "low", F.col("low").alias("high"))
    far = 1 - (total - F.col("least")) / (total + F.col("least"))
    rest = sketched.where("not open").select("a", "b", "n_a", "n_b", F.lit(None).cast("long").alias("common"), F.lit(False).alias("linked"),
                                             far.alias("low"), F.lit(1.0).alias("high"))
    return stored(known.unionByName(rest), "pairs")


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of the nodes of ``edges`` (a, b): label is the least node that is reached.

    Labels go over the edges and then to their own labels' labels, until none changes;
    each round is stored, and the driver sees one count.
    """
    both = stored(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "edges")
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label")), "labels")
    while True:
        heard = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("label").alias("heard"))
        near = labels.join(heard, labels["node"] == heard["a"]).select(
            "node", F.col("label").alias("old"), F.least("label", "heard").alias("label"))
        far = labels.select(F.col("node").alias("via"), F.col("label").alias("next"))
        jumped = stored(near.join(far, near["label"] == far["via"]).select(
            "node", "old", F.least("label", "next").alias("label")), "labels")
        labels = jumped.select("node", "label")
        if jumped.where("label <> old").isEmpty():
            return labels


def meeting(num: int, den: int, columns: int = 2048):
    """Edges (a, b) that connect what links within two blocks; ``own`` says a block meets itself."""
    def run(pdf):
        import pandas as pd

        ids, label, side = (pdf[c].to_numpy() for c in ("doc_id", "label", "side"))
        sets = [np.frombuffer(x, np.uint64) for x in pdf["items"]]
        size = np.array([len(x) for x in sets])
        flat, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), size)
        _, item, times = np.unique(flat, return_inverse=True, return_counts=True)
        keep = times[item] > 1
        number = np.cumsum(times > 1) - 1
        item, owner = number[item[keep]], owner[keep]
        order = np.argsort(item, kind="stable")
        item, owner = item[order], owner[order]
        left = np.flatnonzero(side == 0)
        right = np.flatnonzero(side == 1) if (side == 1).any() else left
        common = np.zeros((len(left), len(right)), np.float32)
        for start in range(0, int(item[-1]) + 1 if len(item) else 0, columns):
            i, j = np.searchsorted(item, [start, start + columns])
            have = np.zeros((len(sets), columns), np.float32)
            have[owner[i:j], item[i:j] - start] = 1
            common += have[left] @ have[right].T
        either = size[left][:, None] + size[right][None] - common
        linked = (common * den >= either * num) & (label[left][:, None] != label[right][None])
        # Least index that each set reaches over links, in turns.
        least = np.arange(len(sets))
        while linked.any():
            old = least.copy()
            far = np.where(linked, least[right][None], len(sets))
            least[left] = np.minimum(least[left], far.min(1))
            near = np.where(linked, least[left][:, None], len(sets))
            least[right] = np.minimum(least[right], near.min(0))
            if (old == least).all():
                break
        moved = np.flatnonzero(least != np.arange(len(sets)))
        return pd.DataFrame({"a": ids[moved], "b": ids[least[moved]]})
    return run


def sighted(num: int, den: int, cells: int = 1 << 22):
    """(meeting, two, doc_id) of two blocks' sets that by their sketches may link with another component's."""
    def run(key, pdf):
        import pandas as pd

        ids, label, side, size = (pdf[c].to_numpy() for c in ("doc_id", "label", "side", "n"))
        sketches = [np.frombuffer(x, np.uint8) for x in pdf["sketch"]]
        all_ = folded(sketches, min(map(len, sketches)))
        left = np.flatnonzero(side == 0)
        right = np.flatnonzero(side == 1) if (side == 1).any() else left
        seen = np.zeros(len(ids), bool)
        rows = max(1, cells // (len(right) * all_.shape[1]))
        for start in range(0, len(left), rows):
            some = left[start:start + rows]
            total = size[some][:, None] + size[right][None]
            least = abs(all_[some][:, None] - all_[right][None]).sum(2, dtype=np.int64)
            may = (least * (den + num) <= total * (den - num)) & (label[some][:, None] != label[right][None])
            seen[some] |= may.any(1)
            seen[right] |= may.any(0)
        return pd.DataFrame({"meeting": key[0], "two": key[1], "doc_id": np.unique(ids[seen])})
    return run


def large_regions(open_: DataFrame, sketches: DataFrame, texts: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """Edges (a, b) among the sets of large regions ``open_`` (doc_id, pivot, size, low, high,
    linked, label): cells, windows and blocks."""
    spread = stored(open_.select("doc_id", "pivot", "size", "low", "high", "linked", "label").distinct(), "large")
    blocks = F.greatest(F.ceil(F.count("*") / BLOCK_SETS), F.ceil(F.sum("size") / BLOCK_ITEMS)).alias("blocks")
    many = spread.groupBy("pivot").agg(blocks).select("pivot", (F.col("blocks") > 1).alias("many"))
    # Sets that link lie in one band of sizes, or in two that touch. A pivot's one block is one cell.
    band = F.floor(F.log("size") / (max(-np.log(num / den), 0.01) * 1.0001))
    cell = F.struct(*(F.when(F.col("many"), v).otherwise(F.lit(0)).alias(c) for c, v in (
        ("band", band), ("low", F.floor(F.col("low") / CELL - 1e-9)), ("high", F.floor(F.col("high") / CELL + 1e-9)), ("ball", F.col("linked").cast("int")))))
    cells = stored(spread.join(many, "pivot").select("pivot", cell.alias("cell"), "doc_id", "label", "size").distinct(), "cells")
    dealt = cells.join(cells.groupBy("pivot", "cell").agg(blocks), ["pivot", "cell"]).select(
        "pivot", F.struct("cell", F.pmod(F.xxhash64("doc_id"), F.col("blocks")).alias("block")).alias("own"), "doc_id", "label")
    dealt = stored(dealt.distinct(), "blocks")
    each = dealt.select("pivot", "own").distinct()
    x, y = (each.select("pivot", F.col("own").alias(s)) for s in "xy")
    gap = F.greatest(F.col("x.cell.low") - F.col("y.cell.high"), F.col("y.cell.low") - F.col("x.cell.high")) - 1
    meet = x.join(y, "pivot").where(
        (F.col("x") <= F.col("y")) & (F.abs(F.col("x.cell.band") - F.col("y.cell.band")) <= 1)
        & (gap * F.lit(CELL) < 1 - num / den + 1e-9) & ((F.col("x.cell.ball") == 0) | (F.col("y.cell.ball") == 0)))
    two = F.col("x") != F.col("y")
    meet = meet.select("pivot", F.xxhash64("pivot", "x", "y").alias("meeting"), two.alias("two"), F.explode(F.when(
        two, F.array(F.struct(F.lit(0).alias("side"), F.col("x").alias("own")), F.struct(F.lit(1).alias("side"), F.col("y").alias("own")))).otherwise(
        F.array(F.struct(F.lit(0).alias("side"), F.col("x").alias("own"))))).alias("at")).select("pivot", "meeting", "two", "at.side", "at.own")
    dealt = stored(dealt.join(meet, ["pivot", "own"]).select("meeting", "two", "side", "doc_id", "label"), "dealt")
    group = ["meeting", "two"]
    seen = stored(dealt.join(sketches, "doc_id").groupBy(group).applyInPandas(sighted(num, den), "meeting long, two boolean, doc_id long"), "seen")
    active = dealt.join(seen, [*group, "doc_id"])
    edges = active.join(sets_of(seen, texts, k), "doc_id").groupBy(group).applyInPandas(meeting(num, den), "a long, b long")
    return stored(edges, "met")


def joined(docs: DataFrame, k: int = SHINGLE, num: int = NUM, den: int = DEN, most: int = MOST) -> tuple[DataFrame, DataFrame]:
    """Described rows of ``docs`` and (node, label) of all documents that link with others."""
    texts = pick(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    rows = stored(texts.mapInArrow(described(k, Rings(num, den)), DESCRIBED), "described")
    nodes = rows.where("doc_id is not null and n_shingles > 0")
    # Equal sets: the lowest doc_id stands for all.
    equal = nodes.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.max("doc_id").alias("last")).where("rep < last")
    copies = stored(nodes.select("doc_id", "digest").join(equal, "digest").where("doc_id <> rep").select("doc_id", "digest", "rep").distinct(), "copies")
    links = copies.select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    # A doc_id's other texts, of which no lower doc_id has a copy, are searched.
    nodes, copied = uncopied(nodes, copies)
    # A pivot for each region; regions of one set are done. Documents go to pivots only
    # for regions that a bitmap of the shared ones does not rule out.
    searched = nodes.mapInArrow(lambda batches: staying(batches, copied), "doc_id long, regions array<long>")
    pivots = stored(searched.select("doc_id", F.explode("regions").alias("key")).groupBy("key").agg(
        F.min("doc_id").alias("pivot"), F.count("*").alias("n")).where("n > 1"), "pivots")
    members = stored(colliding(nodes, copied, pivots).join(pivots, "key").where("doc_id <> pivot"), "members")
    sketches = sketches_of(members.select("doc_id").union(pivots.select("pivot")), texts, k)
    checked = compared(members.select(F.col("doc_id").alias("a"), F.col("pivot").alias("b")).distinct(), sketches, texts, k, num, den)
    links = links.unionByName(checked.where("linked").select("a", "b"))
    found = components(links)
    # What is left of a region: its sets but the pivot, if they are of several components.
    distance = checked.select(F.col("a").alias("doc_id"), F.col("b").alias("pivot"), F.col("n_a").alias("size"), "low", "high", "linked")
    open_ = members.where("n > 2").join(distance, ["doc_id", "pivot"]).join(found.withColumnRenamed("node", "doc_id"), "doc_id", "left")
    open_ = stored(open_.withColumn("label", F.coalesce("label", "doc_id")), "open")
    several = open_.groupBy("key").agg(F.min("label").alias("first"), F.max("label").alias("last"), F.count("*").alias("left")).where("first < last")
    open_ = stored(open_.join(several.select("key", "left"), "key"), "several")
    if not (large := open_.where(F.col("left") > most)).isEmpty():
        links = links.unionByName(large_regions(large, sketches, texts, k, num, den))
        found = components(links)
    small = open_.where(F.col("left") <= most).drop("label").join(found.withColumnRenamed("node", "doc_id"), "doc_id", "left")
    small = small.withColumn("label", F.coalesce("label", "doc_id"))
    x, y = (small.select("key", *(F.col(c).alias(f"{c}_{s}") for c in ("doc_id", "label", "low", "high", "size"))) for s in "ab")
    near = F.greatest(F.col("low_a") - F.col("high_b"), F.col("low_b") - F.col("high_a")) <= 1 - num / den + 1e-9
    sized = F.least("size_a", "size_b") * den >= F.greatest("size_a", "size_b") * num
    pairs = x.join(y, "key").where((F.col("doc_id_a") < F.col("doc_id_b")) & (F.col("label_a") != F.col("label_b")) & near & sized)
    pairs = stored(pairs.select(F.col("doc_id_a").alias("a"), F.col("doc_id_b").alias("b")).distinct(), "rest")
    if not pairs.isEmpty():
        links = links.unionByName(compared(pairs, sketches, texts, k, num, den).where("linked").select("a", "b"))
        found = components(links)
    return rows, found


def classes(docs: DataFrame, k: int = SHINGLE, num: int = NUM, den: int = DEN) -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_shingles, component_id.

    Two documents link when den * |A n B| >= num * |A u B|; a component is what links
    reach, named by its lowest doc_id. A null, empty or word-less text has no shingles and
    links with nothing. Rows that repeat a doc_id are one document, which links through
    any of its texts; a row without doc_id links with nothing and has a null component.
    An empty table gives no rows; other columns are not read.
    """
    rows, found = joined(docs, k, num, den)
    named = rows.select("doc_id", "n_shingles").join(found.withColumnRenamed("node", "doc_id"), "doc_id", "left")
    return named.select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.coalesce("label", "doc_id")).otherwise(F.col("doc_id")).alias("component_id"))


def one_of_each(docs: DataFrame, k: int = SHINGLE, num: int = NUM, den: int = DEN) -> DataFrame:
    """One row of each component of ``docs`` with all its columns: its lowest doc_id.

    Rows that repeat a doc_id are one document, of which one row stays; rows without
    doc_id are linked with nothing and stay.
    """
    rows, found = joined(docs, k, num, den)
    gone = found.where("label < node").select(F.col("node").alias("doc_id"))
    again = stored(rows.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").select("doc_id"), "again")
    flat, names = marked(docs)
    own = at(names, "doc_id").cast("long") == F.col("doc_id")
    kept = flat.join(gone, own, "left_anti")
    if not again.isEmpty():
        nth = F.row_number().over(Window.partitionBy(at(names, "doc_id")).orderBy(F.hash(*flat.columns), *flat.columns))
        once = kept.join(again, own, "left_semi").withColumn("nth", nth).where("nth = 1").drop("nth")
        kept = kept.join(again, own, "left_anti").unionByName(once)
    return unmarked(kept, names)
