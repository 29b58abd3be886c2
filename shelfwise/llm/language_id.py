"""Language identification with a convolutional network over bytes.

Filters of several widths run over the bytes of a fixed-length window, each keeps its
maximum over the window, and a softmax over the maxima gives the language. Training is
plain numpy on a bounded sample of labelled texts: SAMPLE_DOCS documents, chosen by a hash
and dealt evenly over all languages, and EACH of a language at least (all, if it has fewer). A byte's embedding times a filter's tap is one row
of a table, so a trained filter is applied by adding table rows. A text is cut into
windows from its start to its end and its windows' probabilities are averaged by length.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from shelfwise.llm.common import marked, pick, unmarked

WINDOW = 256
WIDTHS, FILTERS, EMBEDDING = (2, 3, 4), 16, 12
#: Bounds of what is fitted: labelled documents in all, and of each language at least.
SAMPLE_DOCS, EACH = 2000, 8
STEPS, BATCH, RATE = 500, 64, 0.004
NONE = "und"
#: `known` rejects a text whose score is above chance by less than this share of what is left to
#: certainty (0.35 among four languages).
LEAST = 2 / 15


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def windows(raw: bytes) -> np.ndarray:
    """A text's windows; the last one is filled with zero bytes."""
    n = -(-len(raw) // WINDOW)
    return np.frombuffer(raw.ljust(n * WINDOW, b"\0"), np.uint8).reshape(n, WINDOW)


def start(n_classes: int, rng: np.random.Generator) -> dict[str, np.ndarray]:
    p = {"E": rng.normal(0, 0.5, (256, EMBEDDING)), "O": rng.normal(0, 0.1, (len(WIDTHS) * FILTERS, n_classes)), "o": np.zeros(n_classes)}
    for w in WIDTHS:
        p[f"F{w}"] = rng.normal(0, (w * EMBEDDING) ** -0.5, (w, EMBEDDING, FILTERS))
        p[f"b{w}"] = np.zeros(FILTERS)
    return {k: v.astype(np.float32) for k, v in p.items()}


def gradients(p: dict[str, np.ndarray], x: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
    """Gradients of the mean cross-entropy over a batch of windows ``x`` with labels ``y``."""
    n = len(x)
    e = p["E"][x]
    maxima, places = [], []
    for w in WIDTHS:
        z = sum(e[:, j:WINDOW - w + 1 + j] @ p[f"F{w}"][j] for j in range(w)) + p[f"b{w}"]
        at = z.argmax(1)
        places.append(at)
        maxima.append(np.take_along_axis(z, at[:, None], 1)[:, 0])
    pooled = np.concatenate(maxima, 1)
    hidden = np.maximum(pooled, 0)
    logits = hidden @ p["O"] + p["o"]
    prob = np.exp(logits - logits.max(1, keepdims=True))
    prob /= prob.sum(1, keepdims=True)
    prob[np.arange(n), y] -= 1
    prob /= n
    g = {"O": hidden.T @ prob, "o": prob.sum(0), "E": np.zeros_like(p["E"])}
    back = (prob @ p["O"].T) * (pooled > 0)
    rows = np.arange(n)[:, None]
    for k, w in enumerate(WIDTHS):
        b = back[:, k * FILTERS:(k + 1) * FILTERS]
        g[f"b{w}"], g[f"F{w}"] = b.sum(0), np.zeros_like(p[f"F{w}"])
        for j in range(w):
            byte = x[rows, places[k] + j]  # the byte under tap j where the filter had its maximum
            g[f"F{w}"][j] = np.einsum("nfe,nf->ef", p["E"][byte], b)
            np.add.at(g["E"], byte, b[:, :, None] * p[f"F{w}"][j].T[None])
    return g


def train(x: np.ndarray, y: np.ndarray, n_classes: int, steps: int = STEPS, seed: int = 7) -> dict[str, np.ndarray]:
    """The network's parameters after ``steps`` steps of Adam on batches of even classes."""
    rng = np.random.default_rng(seed)
    p = start(n_classes, rng)
    m, v = ({k: np.zeros_like(a) for k, a in p.items()} for _ in range(2))
    of = [np.flatnonzero(y == c) for c in range(n_classes)]
    for t in range(1, steps + 1):
        pick_ = np.array([rng.choice(of[c]) for c in rng.integers(0, n_classes, BATCH)])
        g = gradients(p, x[pick_], y[pick_])
        for k in p:
            m[k] = 0.9 * m[k] + 0.1 * g[k]
            v[k] = 0.999 * v[k] + 0.001 * g[k] ** 2
            p[k] = (p[k] - RATE * (m[k] / (1 - 0.9 ** t)) / (np.sqrt(v[k] / (1 - 0.999 ** t)) + 1e-8)).astype(np.float32)
    return p


def tables(p: dict[str, np.ndarray]) -> dict:
    """For each width and tap, a table from a byte to the filters' values."""
    return {"taps": {w: [np.ascontiguousarray(p["E"] @ p[f"F{w}"][j]) for j in range(w)] for w in WIDTHS},
            "bias": {w: p[f"b{w}"] for w in WIDTHS}, "O": p["O"], "o": p["o"]}


def probabilities(t: dict, x: np.ndarray, at_once: int = 32) -> np.ndarray:
    """Softmax outputs of windows ``x``; a few windows at a time, so that the values stay in cache."""
    out = []
    for i in range(0, len(x), at_once):
        part, maxima = x[i:i + at_once], []
        for w, taps in t["taps"].items():
            n = WINDOW - w + 1
            z = taps[0].take(part[:, :n], axis=0)
            for j in range(1, w):
                z += taps[j].take(part[:, j:j + n], axis=0)
            maxima.append(z.max(1) + t["bias"][w])
        logits = np.maximum(np.concatenate(maxima, 1), 0) @ t["O"] + t["o"]
        e = np.exp(logits - logits.max(1, keepdims=True))
        out.append(e / e.sum(1, keepdims=True))
    return np.concatenate(out)


def fit(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> tuple[list[str], dict | None]:
    """Languages and network, from rows with a lang that are not held out."""
    labelled = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    counts = {r["lang"]: r["count"] for r in labelled.groupBy("lang").count().collect()}
    if not counts:
        return [], None
    each = max(EACH, -(-sample_docs // len(counts)))
    # About twice as many as are wanted, chosen by a hash of each row, then the first of each
    # language by that hash; repeated rows are one.
    share = F.create_map(*(F.lit(x) for lang, n in sorted(counts.items()) for x in (lang, min(1 << 20, 1 + (2 * each << 20) // n))))
    some = labelled.select("lang", "text", F.xxhash64("doc_id", "text").alias("key")).where(
        F.pmod("key", F.lit(1 << 20)) < share[F.col("lang")]).dropDuplicates(["lang", "key"])
    first = Window.partitionBy("lang").orderBy("key")
    some = some.withColumn("nth", F.row_number().over(first)).where(F.col("nth") <= each)

    def run(batches):
        for b in batches:
            key, lang, raw = [], [], []
            for d, text, name in zip(*(c.to_pylist() for c in b.columns), strict=True):
                x = windows(text.encode("utf-8", "surrogatepass"))
                for k in {0, len(x) // 2} if len(x) else ():  # the first and the middle one
                    key.append(d)
                    lang.append(name)
                    raw.append(x[k].tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(key, pa.int64()), pa.array(lang), pa.array(raw, pa.binary())], ["key", "lang", "raw"])

    rows = some.select("key", "text", "lang").mapInArrow(run, "key long, lang string, raw binary").collect()
    rows = sorted({(r["key"], r["lang"], bytes(r["raw"])) for r in rows})
    langs = sorted({lang for _, lang, _ in rows})
    if not langs:
        return [], None
    x = np.array([np.frombuffer(raw, np.uint8) for _, _, raw in rows])
    y = np.array([langs.index(lang) for _, lang, _ in rows])
    return langs, tables(train(x, y, len(langs)))


def predicted(langs: list[str], net, text: int):
    """Add lang_pred and score to whatever columns come."""
    def run(batches):
        for b in batches:
            texts = b.column(text).to_pylist()
            raws = [t.encode("utf-8", "surrogatepass") if t and any(map(str.isalpha, t)) and langs else b"" for t in texts]
            lang, score = [], []
            for raw in raws:
                if not raw:
                    lang.append(NONE)
                    score.append(0.0)
                    continue
                total = np.zeros(len(langs))
                for i in range(0, len(raw), WINDOW * 4096):
                    part = raw[i:i + WINDOW * 4096]
                    x = windows(part)
                    weight = np.full(len(x), WINDOW)
                    weight[-1] = len(part) - WINDOW * (len(x) - 1)
                    total += weight @ probabilities(net.value, x)
                best = int(total.argmax())
                lang.append(langs[best])
                score.append(min(1.0, float(total[best]) / len(raw)))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(lang, pa.string()), pa.array(score, pa.float64())],
                                             [*b.schema.names, "lang_pred", "score"])
    return run


def applied(rows: DataFrame, text: int, learnt: DataFrame) -> tuple[DataFrame, int]:
    """``rows`` with lang_pred and score of their column number ``text``, and how many languages
    were learnt from ``learnt``."""
    langs, net = fit(learnt)
    shared = rows.sparkSession.sparkContext.broadcast(net)
    schema = StructType([*rows.schema.fields, StructField("lang_pred", StringType()), StructField("score", DoubleType())])
    return rows.mapInArrow(predicted(langs, shared, text), schema), len(langs)


def columns(docs: DataFrame) -> DataFrame:
    return pick(docs, "doc_id", "text", "lang").withColumn("doc_id", F.col("doc_id").cast("long"))


def identify(docs: DataFrame) -> DataFrame:
    """One row for each row of ``docs``: doc_id, held_out, lang_pred, score.

    Every lang value of the rows to learn from is learnt, however many there are. A text that
    is null or without letters is ``und`` with score 0; so is every text where there is no
    labelled row to learn from. A null doc_id is not held out and not learnt from. Repeated
    rows are predicted each and learnt once; an empty table gives no rows; other columns are
    not read. Predictions read the text only, all of it. Reruns agree.
    """
    rows = columns(docs)
    out, _ = applied(rows.select("doc_id", "text"), 1, rows)
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def known(docs: DataFrame, least: float = LEAST) -> DataFrame:
    """The rows of ``docs`` whose text has a language with a sure enough score: above chance by
    ``least`` of the way to 1. Where one language is all that was learnt nothing tells texts
    apart, and every text with letters stays.

    Null and empty texts and those without letters go; repeated rows stay or go together;
    an empty table stays empty; all columns are kept, whatever their names."""
    flat, names = marked(docs)
    out, n = applied(flat, names.index("text"), columns(docs))
    chance = 1 / max(n, 1)
    return unmarked(out.where((F.col("lang_pred") != NONE) & (F.col("score") >= chance + least * (1 - chance))), names)
