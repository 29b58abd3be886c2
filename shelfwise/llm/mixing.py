"""Mixing sources to target weights by balanced sampling with the cube method.

A source's target is its share of all sizes by weight, at most ``most`` times its own
size; the excess is shared anew by weight. Each of its documents is taken a whole number
of times, and once more with a fractional probability that is the same for the source.

The cube method draws those extra copies. Documents have directions in which their
probabilities can move while the balance of documents and of sizes stays unchanged (the null
space of the two constraints); a move goes on until one probability is 0 or 1, and its sense
is drawn so that expectations stay. The direction taken moves the largest document that is
still a fraction against all smaller ones, so large documents settle while there are many
small ones to make up for them, and what is left, at most two documents of a group, is small. Groups are buckets of a source's documents, so that a hot source is
many groups; what they leave meets in larger groups, until each source is one group.
There landing gives up the balance of documents, moves two documents along the balance of
sizes, and draws the last one. A source of one group lands in it at once; where its few
documents cannot keep the balance, a large one among them, the nearest exchanges bring its
sizes back (expectations stay but for these).
"""

from __future__ import annotations

import random

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.llm.common import WORD, at, in_order, marked, pick, stored, unmarked

MOST = 3
#: Documents of a group of the first level, and groups that meet in the next one.
GROUP_ROWS, FAN_IN = 4096, 1024
SEED = 20240229
EPSILON = 1e-9


def word_count(text):
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = MOST) -> DataFrame:
    """(source, source_size, n, target) of ``sizes`` (source, size).

    Sources stand in code point order, null last, and take the weights in turn. The level
    L of min(most * size, L * weight) that shares everything is the largest of the levels
    that follow from capping the k sources with the smallest size for their weight.
    """
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    placed = in_order(sources, [F.col("source").asc_nulls_last()], {"place": F.lit(1).cast("long")}, "sources")
    turn = F.array(*(F.lit(w) for w in weights))
    placed = placed.withColumn("weight", F.element_at(turn, (F.col("place") % len(weights) + 1).cast("int")).cast("long"))
    placed = placed.withColumn("cap", F.col("source_size") * most)
    placed = stored(placed, "targets")
    total = placed.agg(F.sum("source_size").cast("double").alias("t"), F.sum("weight").cast("double").alias("w"))
    steps = in_order(placed, [F.col("cap") / F.col("weight"), F.col("place")], {"caps": F.col("cap"), "spent": F.col("weight")}, "levels")
    level = steps.crossJoin(F.broadcast(total)).agg(F.max((F.col("t") - F.col("caps")) / (F.col("w") - F.col("spent"))).alias("level"))
    return placed.crossJoin(F.broadcast(level)).select(  # one row
        "source", "source_size", "n", "place",
        F.least(F.col("cap").cast("double"), F.col("level") * F.col("weight")).alias("target"))


def direction(size: np.ndarray) -> np.ndarray | None:
    """A vector of the null space of the rows (sizes, ones): the first document, which is the
    largest, moves by 1 and the others make up for it together, each by a line in its size.
    So a large document settles while the many small ones hardly move. None for two
    documents of different sizes, or fewer."""
    n = len(size) - 1
    if n < 1:
        return None
    rest = size[1:]
    total, squares = rest.sum(), (rest * rest).sum()
    spread = n * squares - total * total
    if spread > 1e-9 * n * max(squares, 1.0):
        slope = (total - n * size[0]) / spread
        return np.concatenate([[1.0], -(1.0 + slope * total) / n + slope * rest])
    if size[0] == rest[0]:
        return np.concatenate([[1.0], np.full(n, -1.0 / n)])
    if n > 1:  # the others are of one size: they settle among themselves
        return np.concatenate([[0.0, 1.0], np.full(n - 1, -1.0 / (n - 1))])
    return None


def move(p: list[float], u: list[float], draw: float) -> None:
    """Move ``p`` along ``u`` or against it until one is 0 or 1; expectations stay."""
    ahead = min(((1 - x) / y if y > 0 else x / -y) for x, y in zip(p, u, strict=True) if y)
    back = min((x / y if y > 0 else (1 - x) / -y) for x, y in zip(p, u, strict=True) if y)
    step = ahead if draw * (ahead + back) < back else -back
    for i, y in enumerate(u):
        x = p[i] + step * y
        p[i] = 0.0 if x < EPSILON else 1.0 if x > 1 - EPSILON else x


def flight(p: list[float], size: list[int], draw) -> None:
    """Move all probabilities until no direction is left: at most two stay fractions. The
    largest document that is one goes first."""
    now, sizes = np.array(p, float), np.array(size, float)
    held = np.argsort(-sizes, kind="stable")
    held = held[(now[held] > 0) & (now[held] < 1)]
    while (u := direction(sizes[held])) is not None:
        x = now[held]
        with np.errstate(divide="ignore"):
            ahead = np.where(u > 0, (1 - x) / u, np.where(u < 0, x / -u, np.inf)).min()
            back = np.where(u > 0, x / u, np.where(u < 0, (1 - x) / -u, np.inf)).min()
        x = x + (ahead if draw() * (ahead + back) < back else -back) * u
        x[x < EPSILON], x[x > 1 - EPSILON] = 0.0, 1.0
        now[held] = x
        held = held[(x > 0) & (x < 1)]
    p[:] = now.tolist()


def land(p: list[float], size: list[int], draw) -> None:
    """Settle what flight has left: two along the sizes alone, then the last one by its probability."""
    held = [i for i, x in enumerate(p) if 0 < x < 1]
    while len(held) > 1:
        i, j = held[:2]
        a, b = size[i], size[j]
        scale = max(a, b)
        now = [p[i], p[j]]
        move(now, [b / scale, -a / scale] if scale else [1.0, -1.0], draw())
        p[i], p[j] = now
        held = [i for i in held if 0 < p[i] < 1]
    for i in held:
        p[i] = float(draw() < p[i])


def repair(p: list[float], was: list[float], size: list[int], near: float) -> None:
    """Where a few documents could not keep the balance (one too large for the rest to make up
    for), exchange a taken and an untaken one, or flip one, as brings the sizes nearest to
    what they were to be, until they miss by no more than ``near``."""
    now, sizes = np.array(p), np.array(size, float)
    free = (np.array(was) > 0) & (np.array(was) < 1)
    miss = float((np.array(was) - now) @ sizes)
    while abs(miss) > near:
        on, off = (np.flatnonzero(free & (now == x)) for x in (1.0, 0.0))
        off = off[np.argsort(sizes[off], kind="stable")]
        best = (abs(miss), -1, -1)
        for i in [-1, *on.tolist()]:  # what is put in should be as large as miss and what goes
            want = miss + (sizes[i] if i >= 0 else 0.0)
            at = int(np.searchsorted(sizes[off], want))
            for j in [-1, *off[max(at - 1, 0):at + 1].tolist()]:
                gain = (sizes[j] if j >= 0 else 0.0) - (sizes[i] if i >= 0 else 0.0)
                best = min(best, (abs(miss - gain), i, j))
        left, i, j = best
        if left > 0.9 * abs(miss):
            break
        for k, x in ((i, 0.0), (j, 1.0)):
            if k >= 0:
                miss += (now[k] - x) * sizes[k]
                now[k] = x
    p[:] = now.tolist()


def settle(last: bool, level: int, seed: int, group_rows: int):
    def run(key, pdf):
        pdf = pdf.sort_values(["size", "order", "row"], ascending=[False, True, True]).reset_index(drop=True)
        draw = random.Random(f"{seed}/{level}/{key[0]}/{key[1]}").random
        was, size = pdf["p"].tolist(), pdf["size"].tolist()
        p = list(was)
        flight(p, size, draw)
        whole = level == 0 and len(pdf) and int(pdf["n"].iloc[0]) <= group_rows  # a source that is one group
        if last or whole:
            land(p, size, draw)
        if whole:
            repair(p, was, size, max(0.005 * sum(x * s for x, s in zip(was, size, strict=True)), float(np.median(size)) / 2))
        return pdf.assign(p=p)
    return run


def extras(rows: DataFrame, seed: int, group_rows: int = GROUP_ROWS, fan_in: int = FAN_IN) -> DataFrame:
    """Settle p of ``rows`` (row, place, n, size, order, p) to 0 or 1: (row, p)."""
    rows = rows.withColumn("bucket", F.pmod("order", F.ceil(F.col("n") / group_rows)))
    groups = rows.agg(F.max(F.ceil(F.col("n") / group_rows))).first()[0] or 1
    out, level = [], 0
    open_ = rows.where((F.col("p") > 0) & (F.col("p") < 1))
    while True:
        last = groups == 1
        done = stored(open_.groupBy("place", "bucket").applyInPandas(settle(last, level, seed, group_rows), open_.schema), "flight")
        out.append(done.where(F.col("p").isin(0.0, 1.0)))
        if last:
            break
        groups, level = -(-groups // fan_in), level + 1
        open_ = done.where(~F.col("p").isin(0.0, 1.0)).withColumn("bucket", F.floor(F.col("bucket") / fan_in))
    settled = out[0]
    for x in out[1:]:
        settled = settled.unionByName(x)
    return settled.select("row", "p")


def copies(rows: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = MOST, seed: int = SEED) -> DataFrame:
    """``rows`` (stored; row, doc_id, source, size, order) with source_size, target and copies."""
    targets = stored(source_targets(rows.select("source", "size"), weights, most), "shares")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    t = targets.withColumnRenamed("source", "t_source").withColumn("rate", F.least(rate, F.lit(float(most))))
    rated = stored(rows.join(t, rows["source"].eqNullSafe(t["t_source"])).select(
        "row", "doc_id", "size", "order", "source_size", "target", "place", "n",
        F.floor(F.col("rate") + EPSILON).alias("whole"),
        F.greatest(F.col("rate") - F.floor(F.col("rate") + EPSILON), F.lit(0.0)).alias("p")), "rated")
    drawn = extras(rated.select("row", "place", "n", "size", "order", "p"), seed)
    return rated.drop("p").join(drawn, "row", "left").select(
        "row", "doc_id", "size", "source_size", "target",
        (F.col("whole") + F.coalesce("p", F.lit(0.0))).cast("long").alias("copies"))


def measured(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """Stored rows (row, doc_id, source, size, key, order); order is a hash that shuffles documents."""
    cols = pick(docs, "doc_id", "source", "text")
    return stored(cols.select(
        F.col("doc_id").cast("long"), "source", word_count(F.col("text")).alias("size"),
        F.xxhash64("text").alias("key"), F.xxhash64(F.lit(seed), "doc_id", "text").alias("order")).withColumn(
        "row", F.monotonically_increasing_id()), "sizes")


def mix(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = MOST, seed: int = SEED) -> DataFrame:
    """One row for each row of ``docs``: doc_id, size, source_size, target, taken, copies.

    ``taken`` counts the words the mix takes, copies included. A null or empty text has
    size 0; a null source is a source of its own, the last one; a source without words has
    target 0 and gives no document. Null and repeated doc_ids are rows like others; an
    empty table gives no rows; other columns are not read. Reruns agree: draws depend on
    the seed, the source's place and the rows alone.
    """
    return copies(measured(docs, seed), weights, most, seed).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies")


def mixed(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = MOST, seed: int = SEED) -> DataFrame:
    """The rows of ``docs`` that the mix takes, each as often as it is taken, with all columns.

    Rows that agree in doc_id, source and text share their copies as evenly as they go.
    """
    rows = measured(docs, seed)
    drawn = copies(rows, weights, most, seed).select("row", "copies")
    like = ["doc_id", "key", "source"]
    shares = stored(rows.join(drawn, "row").groupBy(*like).agg(
        F.sum("copies").alias("total"), F.count("*").alias("rows")).where("total > 0"), "copies")
    flat, names = marked(docs)
    own = {"doc_id": at(names, "doc_id").cast("long"), "key": F.xxhash64(at(names, "text")), "source": at(names, "source")}
    same = [own[k].eqNullSafe(F.col(k)) for k in like]
    out = flat.join(shares.where("rows = 1"), same).withColumn("times", F.col("total"))
    if not (several := shares.where("rows > 1")).isEmpty():
        nth = F.row_number().over(Window.partitionBy(*like).orderBy(F.hash(*flat.columns)))
        out = out.unionByName(flat.join(several, same).withColumn(
            "times", F.floor(F.col("total") / F.col("rows")) + (nth <= F.col("total") % F.col("rows")).cast("long")))
    return unmarked(out.withColumn("copy", F.explode(F.expr("if(times > 0, sequence(1L, times), array())"))), names)
