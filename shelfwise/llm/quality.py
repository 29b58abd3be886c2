"""Quality rules: word statistics and an n-gram language model's perplexity bands.

The model is a modified Kneser-Ney model of order 3 over whole code points (all ASCII
white space is one), one for each lang, however many there are, and grows with the corpus. Python tasks count
the n-grams of chunks of a partition; Spark sums them, builds each order's probabilities
with aggregations and joins, stores them, and sends each chunk the probabilities of the
n-grams that it holds, where its texts are scored. No model is collected or broadcast.

All rows are counted, so each n-gram of a text is in the model. A chunk is known by its
partition and number, so rows that come out of a shuffle are stored first; should others
come in other partitions when they are read again, scoring raises an error.

A language's bands lie around the median of its documents' log perplexity, a fixed
multiple of the median absolute deviation to either side, taken from a histogram of all
documents that pass the word rules.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from shelfwise.llm.common import marked, prepare, stored, unmarked

#: Any order works; by the labels of sf0.1 a fourth one tells junk from clean texts worse (REPLY_r02.md).
ORDER = 3
#: Characters of a chunk, from which on a new one begins.
CHUNK = 1 << 25
NULL = "\x00null"
#: Bands: median +- WIDTH * median absolute deviation of log perplexity, at least FLOOR wide.
WIDTH, FLOOR = 8.0, 0.05
BINS = 1000  # histogram bins for each unit of log perplexity
MIN_WORDS, MOST_REPEATED = 50, 50
SYMBOLS = "#*$%&|<>"
STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

_TIMES = np.multiply.accumulate(np.full(ORDER, 0x9E3779B97F4A7C15, np.uint64))

def points(text: str) -> np.ndarray:
    """Code points of a text between ORDER - 1 start spaces and one end space; ASCII white space is a space."""
    p = np.frombuffer((" " * (ORDER - 1) + text + " ").encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where((p >= 9) & (p <= 13), np.uint32(32), p)


def hashed(p: np.ndarray) -> np.ndarray:
    """64-bit hashes of the n-grams of code points ``p``."""
    n = len(p) - ORDER + 1
    h = np.zeros(n, np.uint64)
    for i in range(ORDER):
        h += p[i:i + n] * _TIMES[i]
    h ^= h >> np.uint64(31)
    h *= _TIMES[0]
    return h ^ (h >> np.uint64(29))


def distinct(h: np.ndarray, n: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct hashes, a place of each in ``h``, and their counts."""
    order = np.argsort(h)
    s = h[order]
    first = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]]))
    return s[first], order[first], np.diff(first, append=len(h)) if n is None else np.add.reduceat(n[order], first)


class Chunks:
    """Numbers of the chunks that a task's rows, in their order, lie in."""

    def __init__(self) -> None:
        self.number, self.held = TaskContext.get().partitionId() << 32, 0

    def next(self, text: str | None) -> int:
        if self.held >= CHUNK:
            self.number, self.held = self.number + 1, 0
        self.held += len(text or "")
        return self.number


def counted(chunk: int, held: dict[str, list]):
    """Batches (lang, gram, n, chunk) of a chunk's distinct n-grams."""
    for lang, parts in held.items():
        h, grams_, n = (np.concatenate(x) for x in zip(*parts, strict=True))
        _, at, n = distinct(h, n)
        for i in range(0, len(at), 100_000):
            some = grams_[at[i:i + 100_000]].tobytes().decode("utf-32-le", "surrogatepass")
            k = len(some) // ORDER
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * k, pa.string()), pa.array([some[j:j + ORDER] for j in range(0, len(some), ORDER)], pa.string()),
                 pa.array(n[i:i + 100_000], pa.int64()), pa.array([chunk] * k, pa.int64())], ["lang", "gram", "n", "chunk"])


def count_grams(batches):
    """N-gram counts of each chunk of a task: (lang, gram, n, chunk) of (lang, text)."""
    chunks, held, current = Chunks(), {}, None
    for b in batches:
        texts: dict[str, list[np.ndarray]] = {}

        def put():
            for lang, parts in texts.items():
                p = np.concatenate(parts)
                h = np.concatenate([hashed(x) for x in parts])
                starts = np.concatenate([np.arange(len(x) - ORDER + 1) + e for x, e in zip(
                    parts, np.cumsum([0, *map(len, parts[:-1])]), strict=True)])
                h, at, n = distinct(h)
                held.setdefault(lang, []).append((h, p[starts[at][:, None] + np.arange(ORDER)].astype("<u4"), n))
            texts.clear()

        for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            if (chunk := chunks.next(text)) != current:
                put()
                if current is not None:
                    yield from counted(current, held)
                held, current = {}, chunk
            if text:
                texts.setdefault(lang, []).append(points(text))
        put()
    if current is not None:
        yield from counted(current, held)


def chunked(batches):
    """The rows that come, with their chunks."""
    chunks = Chunks()
    for b in batches:
        text = b.schema.names.index("__text")
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(map(chunks.next, b.column(text).to_pylist()), pa.int64())],
                                         [*b.schema.names, "__chunk"])


def discounted(level: DataFrame) -> DataFrame:
    """(lang, d1, d2, d3): modified Kneser-Ney discounts for counts 1, 2 and 3 or more."""
    seen = level.groupBy("lang").agg(*(F.count_if(F.col("n") == k).alias(f"n{k}") for k in range(1, 5)))
    y = F.col("n1") / (F.col("n1") + 2 * F.col("n2"))
    whole = F.least("n1", "n2", "n3", "n4") > 0  # else too few n-grams to estimate them
    return stored(seen.select("lang", *(
        F.when(whole, F.least(F.lit(float(k)), F.greatest(F.lit(0.1), k - (k + 1) * y * F.col(f"n{k + 1}") / F.col(f"n{k}")))).otherwise(few).alias(f"d{k}")
        for k, few in ((1, 0.5), (2, 0.75), (3, 0.9)))), "discounts")


def probabilities(counts: DataFrame) -> DataFrame:
    """(lang, gram, p) of interpolated n-grams from their counts (lang, gram, n)."""
    levels = [counts.select("lang", "gram", "n")]
    for k in range(ORDER - 1, 0, -1):  # a lower order counts the distinct characters before
        levels.append(stored(levels[-1].groupBy("lang", F.substring("gram", 2, k).alias("gram")).agg(F.count("*").alias("n")), f"order{k}"))
    lower = levels[-1].groupBy("lang").agg((1 / F.count("*")).alias("lower")).withColumn("rest", F.lit(""))
    for k, level in enumerate(reversed(levels), 1):
        rows = level.join(discounted(level), "lang").select(
            "lang", "gram", "n", F.when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d3")).alias("d"),
            F.substring("gram", 1, k - 1).alias("context"), F.substring("gram", 2, k - 1).alias("rest"))
        contexts = rows.groupBy("lang", "context").agg(F.sum("n").alias("total"), F.sum("d").alias("left"))
        both = rows.join(contexts, ["lang", "context"]).join(lower, ["lang", "rest"])
        p = stored(both.select("lang", "gram", ((F.col("n") - F.col("d") + F.col("left") * F.col("lower")) / F.col("total")).alias("p")), f"model{k}")
        lower = p.select("lang", F.col("gram").alias("rest"), F.col("p").alias("lower"))
    return p


class Model:
    """Log probabilities of the n-grams of a chunk in one language."""

    def __init__(self, grams_: list[str], log: np.ndarray) -> None:
        h = hashed(np.frombuffer("".join(grams_).encode("utf-32-le", "surrogatepass"), np.uint32))[::ORDER]
        order = np.argsort(h)
        self.h, self.log = h[order], log[order]
        bits = len(h).bit_length() + 2
        self.shift = np.uint64(64 - bits)
        self.slots = np.zeros(1 << bits, np.int32)  # most hashes have a slot of their own
        self.slots[self.h >> self.shift] = np.arange(len(h), dtype=np.int32)

    def log_perplexity(self, text: str) -> float:
        """Mean negative log probability of a text's characters."""
        h = hashed(points(text))
        at = self.slots[h >> self.shift]
        if (miss := np.flatnonzero(self.h[at] != h)).size:
            at[miss] = np.minimum(np.searchsorted(self.h, h[miss]), len(self.h) - 1)
            if (self.h[at[miss]] != h[miss]).any():
                raise RuntimeError("the rows came in other partitions when they were read again")
        return float(-self.log[at].mean())


def scored(schema: StructType, text: int, lang: int):
    """Statistics and log perplexity of a chunk's rows, in place of their last three columns, from its n-grams' ``log``."""
    def run(rows: pa.Table, model: pa.Table) -> pa.Table:
        held: dict[str, Model] = {}
        for name in model["lang"].unique().to_pylist():
            own = model.filter(pa.compute.equal(model["lang"], name))
            held[name] = Model(own["gram"].to_pylist(), own["log"].to_numpy())
        out = []
        for b in rows.select([text, lang]).to_batches(max_chunksize=512):
            for t, name in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if t and name not in held:
                    raise RuntimeError("the rows came in other partitions when they were read again")
                out.append((*base(t), held[name].log_perplexity(t) if t else None))
        cols = list(zip(*out, strict=True)) or [[]] * 6
        kept = [rows.column(c) for c in range(len(schema) - 6)]
        return pa.Table.from_arrays([*kept, *(pa.array(c, pa.int64()) for c in cols[:5]), pa.array(cols[5], pa.float64())], names=schema.names)
    return run


def base(text: str | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a whole text."""
    if not text:
        return 0, 0, 0, 0, 0
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()  # bytes split at ASCII white space only
    n = len(words)
    chars = len(text) - sum(map(text.count, " \t\n\r\x0b\x0c"))
    symbols = sum(map(text.count, SYMBOLS))
    lines: set[bytes] = set()
    dup = 0
    for line in raw.split(b"\n"):
        if line in lines:
            dup += bool(line.split())
        lines.add(line)
    repeated = 0
    if n > 3:
        number: dict[bytes, int] = {}
        ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, n)
        k = len(number)
        if k < 1 << 20:
            windows = (ids[:-2] * k + ids[1:-1]) * k + ids[2:]
        else:  # three numbers do not fit 63 bits: number the pairs first
            pairs = np.unique(ids[:-1] * k + ids[1:], return_inverse=True)[1]
            windows = pairs[:-1] * k + ids[2:]
        _, place, times = np.unique(windows, return_inverse=True, return_counts=True)
        start = np.flatnonzero(times[place] > 1)
        inside = np.zeros(n, bool)
        for i in range(3):
            inside[start + i] = True
        repeated = int(inside.sum())
    return n, chars, symbols, dup, repeated


def bands(histogram: DataFrame, width: float, floor: float) -> DataFrame:
    """(lang, low, high): least and greatest log perplexity of each language, from its (lang, bin, n)."""
    def run(pdf):
        import pandas as pd

        pdf = pdf.sort_values("bin")
        at, n = pdf["bin"].to_numpy(), pdf["n"].to_numpy()

        def middle(values: np.ndarray) -> float:
            order = np.argsort(values, kind="stable")
            return values[order][np.searchsorted(np.cumsum(n[order]), n.sum() / 2)]

        mid = middle(at)
        wide = max(width * middle(abs(at - mid)), floor * BINS)
        return pd.DataFrame({"lang": pdf["lang"].iloc[:1], "low": float(mid - wide) / BINS, "high": float(mid + wide) / BINS})
    return histogram.groupBy("lang").applyInPandas(run, "lang string, low double, high double")


def failed():
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


def steady(df: DataFrame) -> DataFrame:
    """``df``, or a stored copy of it where a shuffle may deal its rows otherwise each time."""
    return stored(df, "steady") if "Exchange" in df._jdf.queryExecution().executedPlan().toString() else df


def judge(docs: DataFrame, width: float, floor: float, *names: str):
    """Every row's columns ``names`` (positional ones of ``marked``), model and statistics, stored, and the bands (lang, low, high)."""
    prepare(docs.sparkSession)
    flat, all_ = marked(docs)
    at_lang, at_text = (F.col(f"c{all_.index(n)}") for n in ("lang", "text"))
    flat = steady(flat.select(*names, F.coalesce(at_lang, F.lit(NULL)).alias("lang"), at_text.alias("__text")))
    counts = stored(flat.select("lang", "__text").mapInArrow(count_grams, "lang string, gram string, n long, chunk long").groupBy("lang", "gram").agg(
        F.sum("n").alias("n"), F.collect_list("chunk").alias("chunks")), "counts")
    model = probabilities(counts).join(counts.select("lang", "gram", "chunks"), ["lang", "gram"]).select(
        F.explode("chunks").alias("__chunk"), "lang", "gram", F.log("p").alias("log"))
    tagged = flat.mapInArrow(chunked, StructType([*flat.schema.fields, StructField("__chunk", LongType())]))
    schema = StructType([*flat.schema.fields[:-1], *(StructField(c, LongType()) for c in STATS), StructField("log_perplexity", DoubleType())])
    run = scored(schema, len(names) + 1, len(names))
    stats = stored(tagged.groupBy("__chunk").cogroup(model.groupBy("__chunk")).applyInArrow(run, schema).withColumn("base_failed", failed()), "quality")
    histogram = stats.where(~F.col("base_failed")).groupBy(
        "lang", F.round(F.col("log_perplexity") * BINS).cast("int").alias("bin")).agg(F.count("*").alias("n"))
    return stats, stored(bands(histogram, width, floor), "bands")


def kept(stats: DataFrame, limits: DataFrame) -> DataFrame:
    within = F.col("log_perplexity").between(F.col("low"), F.col("high"))
    return stats.join(limits, "lang", "left").withColumn(
        "kept", ~F.col("base_failed") & F.coalesce(within, F.lit(False)))


def passed(docs: DataFrame, width: float = WIDTH, floor: float = FLOOR) -> DataFrame:
    """The rows of ``docs`` that ``quality`` keeps, with all columns."""
    flat, names = marked(docs)
    stats, limits = judge(docs, width, floor, *flat.columns)
    return unmarked(kept(stats, limits).where("kept"), names)


def quality(docs: DataFrame, width: float = WIDTH, floor: float = FLOOR) -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, kept, log_perplexity.

    A null or empty text has no words, fails the word rules and is not kept. A null lang is
    a language of its own. A document is kept if it passes the word rules and its
    perplexity lies within its language's bands (both ends count as within). Null and
    repeated doc_ids are judged each, an empty table gives no rows, other columns are not
    read. The models count all rows, repeated ones too.
    """
    doc_id = f"c{docs.columns.index('doc_id')}"
    stats, limits = judge(docs, width, floor, doc_id)
    return kept(stats, limits).select(F.col(doc_id).cast("long").alias("doc_id"), *STATS, "base_failed", "kept", "log_perplexity")


#: A Kneser-Ney model of order 3 over 128 character classes in numpy, which only a test uses.
CLASSES = 128

_SPACE = set(b" \t\n\r\x0b\x0c")
_DIRECT = np.array([0 if c in _SPACE else c - 32 if 33 <= c <= 126 else 95 for c in range(128)], np.uint8)


def classes(text: str) -> np.ndarray:
    """The class of each code point."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    hashed = (points * np.uint32(2654435761) >> np.uint32(27)) + np.uint32(96)
    return np.where(points < 128, _DIRECT[np.minimum(points, 127)], hashed).astype(np.int32)


def grams(text: str) -> np.ndarray:
    """Codes of the trigrams of a text between one start and one end space."""
    c = np.concatenate([[0, 0], classes(text), [0]]).astype(np.int32)
    return (c[:-2] * CLASSES + c[1:-1]) * CLASSES + c[2:]


def discounts(n: np.ndarray) -> np.ndarray:
    """Modified Kneser-Ney discounts for counts 0, 1, 2 and 3 or more."""
    have = np.array([np.count_nonzero(n == k) for k in range(1, 5)], float)
    if not have.all():  # too few n-grams to estimate them
        return np.array([0, 0.5, 0.75, 0.9])
    y = have[0] / (have[0] + 2 * have[1])
    return np.array([0, *(min(k, max(0.1, k - (k + 1) * y * have[k] / have[k - 1])) for k in (1, 2, 3))])


def smoothed(code: np.ndarray, n: np.ndarray, lower: np.ndarray):
    """Interpolated probabilities of n-grams with counts ``n``, and their contexts' weights.

    ``lower`` has the probability of each n-gram's ending under the next lower order.
    """
    d = discounts(n)[np.minimum(n, 3)]
    context, place = np.unique(code // CLASSES, return_inverse=True)
    total = np.bincount(place, n)
    weight = np.bincount(place, d) / total
    return (n - d) / total[place] + weight[place] * lower, context, weight


def kneser_ney(code: np.ndarray, n: np.ndarray) -> dict[str, np.ndarray]:
    """Sorted arrays of one language's model from its trigram counts."""
    order = np.argsort(code)
    code, n = code[order].astype(np.int64), n[order]
    pair, pair_n = np.unique(code % CLASSES ** 2, return_counts=True)
    one, one_n = np.unique(pair % CLASSES, return_counts=True)
    p1 = np.full(CLASSES, 1 / CLASSES)
    p, _, w = smoothed(one, one_n, p1[one])
    p1 = p1 * w[0]
    p1[one] = p
    p2, context2, w2 = smoothed(pair, pair_n, p1[pair % CLASSES])
    at = np.searchsorted(pair, code % CLASSES ** 2)
    p3, context3, w3 = smoothed(code, n, p2[at])
    log = lambda x: np.log(x).astype(np.float32)
    return {"code3": code.astype(np.int32), "p3": log(p3), "context3": context3.astype(np.int32), "w3": log(w3),
            "code2": pair.astype(np.int32), "p2": log(p2), "context2": context2.astype(np.int32), "w2": log(w2),
            "p1": log(p1)}


def found(sorted_: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(sorted_, wanted), max(len(sorted_) - 1, 0))
    return at, sorted_[at] == wanted
