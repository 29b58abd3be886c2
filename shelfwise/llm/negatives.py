"""Hard-negative mining with anchor-clustered shared lists.

Anchors are clustered by angle. For a cluster with centroid direction u whose members lie
within an angle T of u, no member m has an inner product above |m| * |c| * cos(max(0, a - T))
with a candidate c at an angle a from u. So the candidates of a cluster are sorted by
|c| * cos(max(0, a - T)) once, and each member walks that shared list, in stretches of
growing length and by one matrix product for all members still walking, until the bound
of the next entry is below what its result already holds: the rest of the list is then
certified to hold nothing better.

Candidates are dealt into blocks of bounded size by a hash of their row, and every block
holds a list for each cluster; members go to every block, sorted by cluster, and stream past
it. The best of each block are merged. Neither a label nor a cluster nor repeated rows make
a block larger than others, and no block holds more than its share of candidates.

Two walks are needed: the first finds each anchor's positives, whose scores are the windows
of the second, which finds the best candidates of other labels in each window.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.llm.common import pick, stored
from shelfwise.llm.vectors import best, common_width, finite_rows

#: Vector entries are floor(SCALE * entry).
SCALE = 256
POSITIVES, NEGATIVES = 5, 3
#: A negative's score lies between these shares, in percent, of the positive's.
LOW, HIGH = 50, 95
#: Entries of the candidates of one block (128 MB in single precision).
BLOCK_ENTRIES = 1 << 25
#: Clusters are fitted on at most so many anchors; any clusters give the same result.
SAMPLE_ANCHORS = 20_000
MOST_CLUSTERS, ROUNDS = 512, 6
#: Room for rounding in the angles and cosines of the bounds, as a share of both lengths.
SLACK = 1e-6
#: A missing id, last in its order.
NO_ID = (1 << 63) - 1

VECTORS = "id long, label long, anchor boolean, norm double, entries binary"
ANCHORS = "row long, id long, label long, cluster int, angle double, norm double, entries binary"


def grid_vectors(width: int, scale: int):
    """Rows of finite vectors on the integer grid, in 2 bytes an entry where they fit, else 4."""
    def run(batches):
        for b in batches:
            at, rows = finite_rows(b.column(3), width)
            grid = np.floor(scale * rows)
            if len(grid) and np.abs(grid).max() >= 1 << 31:
                raise OverflowError("entries beyond the grid: take a smaller scale")
            short = np.abs(grid).max(axis=1) < 1 << 15
            entries = [g.astype("<i2" if s else "<i4").tobytes() for g, s in zip(grid, short.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*(b.column(i).take(pa.array(at)) for i in range(3)), pa.array(np.sqrt((grid ** 2).sum(axis=1))),
                 pa.array(entries, pa.binary())], ["id", "label", "anchor", "norm", "entries"])
    return run


def matrix(column: pa.Array, width: int, kind: type) -> np.ndarray:
    """The entries of a batch's vectors."""
    raw = column.to_pylist()
    out = np.empty((len(raw), width), kind)
    long = np.array([len(x) > 2 * width for x in raw], bool)
    for of, kind_ in ((~long, "<i2"), (long, "<i4")):
        out[of] = np.frombuffer(b"".join([raw[i] for i in np.flatnonzero(of)]), kind_).reshape(-1, width)
    return out


def directions(rows: np.ndarray) -> np.ndarray:
    norms = np.sqrt((rows ** 2).sum(axis=1, keepdims=True))
    return rows / np.where(norms > 0, norms, 1)


def centroids(sample: np.ndarray, clusters: int) -> np.ndarray:
    """Directions of the clusters of ``sample``'s rows (spherical k-means)."""
    rows = directions(sample)
    found = rows[np.linspace(0, len(rows) - 1, clusters).astype(int)]
    for _ in range(ROUNDS):
        of = (rows @ found.T).argmax(axis=1)
        total = np.zeros_like(found)
        np.add.at(total, of, rows)
        found = np.where((total != 0).any(axis=1, keepdims=True), directions(total), found)
    return found


def angles(cosines: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(cosines, -1, 1))


def clustered(width: int, middles: np.ndarray):
    """Adds each anchor's cluster and its angle to that cluster's centroid."""
    def run(batches):
        for b in batches:
            cosines = directions(matrix(b.column(4), width, np.float64)) @ middles.T
            of = cosines.argmax(axis=1)
            angle = angles(cosines[np.arange(len(of)), of])
            yield pa.RecordBatch.from_arrays(
                [*(b.column(i) for i in range(3)), pa.array(of.astype(np.int32)), pa.array(angle), b.column(3), b.column(4)],
                ["row", "id", "label", "cluster", "angle", "norm", "entries"])
    return run


class Block:
    """Candidates of one block and the shared lists of one cluster at a time."""

    def __init__(self, width: int, middles: np.ndarray, spread: np.ndarray, exact: type) -> None:
        self.width, self.middles, self.spread, self.exact = width, middles, spread, exact
        self.parts: list[tuple] = []
        self.cluster = None

    def add(self, b: pa.RecordBatch) -> None:
        col = {n: b.column(i) for i, n in enumerate(b.schema.names)}
        self.parts.append((*(col[n].to_numpy() for n in ("row", "id", "label", "norm")),
                           matrix(col["entries"], self.width, self.exact)))

    def close(self) -> None:
        self.row, self.id, self.label, self.norm, self.rows = (np.concatenate(x) for x in zip(*self.parts, strict=True))
        self.parts = []

    def shared_list(self, cluster: int, label: int, same: bool) -> tuple[np.ndarray, np.ndarray]:
        """Candidates of the label, or of all others, and their bounds, the greatest bound first."""
        if self.cluster != cluster:
            cosine = self.rows @ self.middles[cluster].astype(self.exact) / np.where(self.norm > 0, self.norm, 1)
            away = np.maximum(angles(cosine.astype(np.float64)) - self.spread[cluster], 0)
            bound = self.norm * (np.cos(away) + SLACK)
            self.order = np.argsort(-bound, kind="stable")
            self.bound, self.cluster = bound[self.order], cluster
        of = (self.label[self.order] == label) == same
        return self.order[of], self.bound[of]


def walk(block: Block, members: dict, same: bool, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The first ``most`` candidates within each window of each member of one cluster and label:
    (place in the flat member x window table, candidate, score).

    ``low`` and ``high`` (member x window) bound the scores; ``low`` rises to the score of
    the last candidate held once there are enough of them.
    """
    low, high, row = members["low"].copy(), members["high"], members["row"]
    vectors = members["rows"].astype(block.exact)
    windows = low.shape[1]
    places, bounds = block.shared_list(members["cluster"], members["label"], same)
    held = [np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)]
    start, step = 0, 16 * most
    while start < len(places):
        # In single precision, entries are small enough for exact products; the bound is in double.
        going = np.flatnonzero(members["norm"] * bounds[start] >= low.min(axis=1))
        if not len(going):
            break
        part = places[start:start + step]
        score = (vectors[going] @ block.rows[part].T).astype(np.float64)
        new = []
        for w in range(windows):
            i, c = np.nonzero((score >= low[going, w, None]) & (score <= high[going, w, None]))
            other = row[going[i]] != block.row[part[c]]
            i, c = i[other], c[other]
            new.append((going[i] * windows + w, part[c], score[i, c]))
        held = [np.concatenate([h, *n]) for h, n in zip(held, zip(*new, strict=True), strict=True)]
        keep = best(held[0], held[2], block.id[held[1]], block.row[held[1]], most)
        held = [h[keep] for h in held]
        owners, first, count = np.unique(held[0], return_index=True, return_counts=True)
        full = count >= most
        low.ravel()[owners[full]] = held[2][first[full] + most - 1]
        start, step = start + step, min(2 * step, 4096)
    return held[0], held[1], held[2]


def walks(width: int, middles: np.ndarray, spread: np.ndarray, exact: type, same: bool, most: int, windows: int):
    """Streams rows sorted by block: its candidates first, then members by cluster and label."""
    def run(batches):
        block, current = None, None
        for b in batches:
            col = {n: b.column(i) for i, n in enumerate(b.schema.names)}
            key = np.stack([col[n].to_numpy() for n in ("block", "cluster", "of_label")])
            edges = [0, *(np.flatnonzero((np.diff(key, axis=1) != 0).any(axis=0)) + 1).tolist(), b.num_rows]
            for i, j in zip(edges, edges[1:], strict=False):
                if i == j:
                    continue
                run_of, (number, cluster, label) = b.slice(i, j - i), (int(x) for x in key[:, i])
                if number != current:
                    block, current = Block(width, middles, spread, exact), number
                if cluster < 0:
                    block.add(run_of)
                    continue
                if block.parts:
                    block.close()
                elif not hasattr(block, "row"):
                    continue  # no candidates were dealt to this block
                part = {n: run_of.column(k) for k, n in enumerate(b.schema.names)}
                pair = {n: part[n].to_numpy() for n in ("row", "id", "norm")}
                limits = [np.array(part[n].flatten().to_numpy(), float).reshape(-1, windows) for n in ("low", "high")]
                at, c, score = walk(block, pair | dict(zip(("low", "high"), limits, strict=True))
                                    | {"rows": matrix(part["entries"], width, np.float64), "cluster": cluster, "label": label},
                                    same, most)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(pair["row"][at // windows]), pa.array((at % windows).astype(np.int32)),
                     pa.array(block.row[c]), pa.array(block.id[c]), pa.array(score.astype(np.int64))],
                    ["member", "window", "row", "id", "score"])
    return run


def merged(members: DataFrame, candidates: DataFrame, blocks: int, run, most: int) -> DataFrame:
    """The best of all blocks: (member, window, row, id, score, rank from 1)."""
    none = F.array().cast("array<double>")
    left = candidates.select(
        F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int").alias("block"), F.lit(-1).alias("cluster"), F.lit(-1).cast("long").alias("of_label"),
        "row", "id", "label", "norm", none.alias("low"), none.alias("high"), "entries")
    right = members.select(
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), "cluster", F.col("label").alias("of_label"),
        "row", "id", "label", "norm", "low", "high", "entries")
    dealt = left.unionByName(right).repartitionById(blocks, F.col("block")).sortWithinPartitions("block", "cluster", "of_label", "row")
    found = dealt.mapInArrow(run, "member long, window int, row long, id long, score long")
    order = Window.partitionBy("member", "window").orderBy(F.desc("score"), "id", "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def mine(df: DataFrame, anchor: Column, id: str = "vec_id", label: str = "label", vector: str = "embedding",
         positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH, scale: int = SCALE,
         blocks: int | None = None, clusters: int | None = None) -> DataFrame:
    """Hard negatives of each anchor and positive: ``RESULT``'s columns.

    A score is the inner product of two vectors' ``floor(scale * entry)``. A row where
    ``anchor`` (over the columns ``id`` and ``label``, so named) is true has as positives its
    first ``positives`` other rows of its label, by falling score, then by id; each of these
    pairs has the first ``negatives`` rows of other labels whose score is at least ``low`` and
    at most ``high`` percent of the positive's. Fewer, or none, where there are fewer.

    Rows with a null label, a null vector, a null or non-finite entry, or a vector that has
    not the most frequent length take no part. A row without an id takes part and comes last
    among equal scores. Repeated rows are rows of their own: each is an anchor, a positive or
    a negative for itself, in any order among themselves. Other columns are not read. An
    empty table gives no rows.

    ``blocks`` candidates blocks and ``clusters`` anchor clusters change the cost, not the
    result. Members go to every block; by default there are no more blocks than keep their
    rows below those of the table, unless memory needs more.
    """
    spark = df.sparkSession
    df = pick(df, id, label, vector).toDF("id", "label", "vector")
    width = common_width(df, "vector")
    rows = df.where("label IS NOT NULL AND vector IS NOT NULL").select(
        F.coalesce(F.col("id").cast("long"), F.lit(NO_ID)).alias("id"), F.col("label").cast("long").alias("label"),
        F.coalesce(anchor, F.lit(False)).alias("anchor"), "vector")
    rows = stored(rows.mapInArrow(grid_vectors(width, scale), VECTORS).withColumn("row", F.monotonically_increasing_id()), "vectors")
    size = rows.agg(F.count("*").alias("n"), F.count_if("anchor").alias("anchors"), F.max("norm").alias("norm")).first()
    if not size["anchors"]:
        return spark.createDataFrame([], RESULT)
    if size["norm"] ** 2 >= 1 << 53:
        raise OverflowError("inner products beyond 2 ** 53: take a smaller scale")
    exact = np.float32 if size["norm"] ** 2 < 1 << 24 else np.float64  # all partial sums are exact in it

    anchors = rows.where("anchor")
    sample = anchors.orderBy(F.xxhash64("row"), "row").limit(SAMPLE_ANCHORS).select("entries").toArrow()
    sample = matrix(sample.column(0).combine_chunks(), width, np.float64)
    middles = centroids(sample, clusters or min(MOST_CLUSTERS, int(np.ceil(np.sqrt(size["anchors"])))))
    anchors = stored(anchors.select("row", "id", "label", "norm", "entries").mapInArrow(clustered(width, middles), ANCHORS), "anchors")
    spread = np.zeros(len(middles))
    for r in anchors.groupBy("cluster").agg(F.max("angle").alias("angle")).collect():
        spread[r["cluster"]] = r["angle"]

    if blocks is None:
        blocks = max(-(-size["n"] * width // BLOCK_ENTRIES), min(spark.sparkContext.defaultParallelism, -(-size["n"] // size["anchors"])))
    every = anchors.withColumn("low", F.array(F.lit(-np.inf))).withColumn("high", F.array(F.lit(np.inf)))
    found = merged(every, rows, blocks, walks(width, middles, spread, exact, True, positives, 1), positives)
    # A missing window holds no score; percentages are of whole numbers and round inwards.
    held = found.groupBy("member").agg(F.map_from_entries(F.collect_list(F.struct("rank", F.struct("id", "score")))).alias("positives"))
    scores = [F.try_element_at("positives", F.lit(i + 1))["score"] for i in range(positives)]
    lows, highs = [F.ceil(s * low / 100) for s in scores], [F.floor(s * high / 100) for s in scores]
    windows = anchors.join(held.hint("merge"), anchors["row"] == held["member"]).drop("member").select(
        "*", F.array(*(F.when(a <= b, a.cast("double")).otherwise(F.lit(np.inf)) for a, b in zip(lows, highs, strict=True))).alias("low"),
        F.array(*(F.coalesce(b.cast("double"), F.lit(-np.inf)) for b in highs)).alias("high"))
    windows = stored(windows, "windows")
    chosen = merged(windows, rows, blocks, walks(width, middles, spread, exact, False, negatives, positives), negatives)
    pairs = windows.select(F.col("row").alias("member"), F.col("id").alias("anchor"), F.explode("positives").alias("place", "positive"))
    named = chosen.join(pairs.withColumn("window", F.col("place") - 1).hint("merge"), ["member", "window"])

    def known(column: str) -> Column:
        return F.nullif(F.col(column), F.lit(NO_ID))

    return named.select(known("anchor").alias("anchor_id"), known("positive.id").alias("positive_id"), F.col("rank").cast("int").alias("rank"),
                        known("id").alias("negative_id"), F.col("positive.score").alias("positive_score"), F.col("score").alias("negative_score"))
