"""Lexical retrieval packing: windows filled with the BM25 neighbours of a seed document.

1. Texts are encoded once; the token ids are the terms.
2. Spark counts in how many documents each id occurs. The vocabulary bounds that table,
   whatever the corpus holds, so every task gets it.
3. Shards: a document's leading term is its term of greatest BM25 weight. The tokens of
   each leading term are summed (one row for each id of the vocabulary at most) and laid on
   one line, which is cut into parts of equal length; a document's place is that of its
   leading term plus a hash of its row within the term's stretch. So documents of one
   leading term lie side by side, and a term that leads a third of all documents covers a
   third of all parts. A part streams through its task in shards of bounded size.
4. Each shard gets an inverted index. A window starts with a seed; the index ranks the
   unused documents of the shard by BM25 against all terms of the seed, and they follow in
   that order, whole, until one does not fit: it is cut, its head fills the window and its
   rest is the seed of the next. A window that the shard cannot fill goes on in the next
   one. So all windows are full but the last of a part, which is cut into sequences whose
   lengths are powers of two.
"""

from __future__ import annotations

import functools
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import partitions, pick, stored
from shelfwise.llm.split_tokens import SplitEncoder
from shelfwise.llm.tokens import gathered

MAX_LEN, END = 4096, 2
#: BM25's usual parameters.
K1, B = 1.2, 0.75
#: Tokens of one shard, and the most tokens of one part (one task).
SHARD_TOKENS, PART_TOKENS = 1 << 18, 1 << 26

CODED = "doc_id long, ids binary"
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> SplitEncoder:
    return SplitEncoder(path)


def coded(path: str, end: int):
    """Each text's ids with the end id."""
    def run(batches):
        enc = encoder(path)
        for t in gathered(batches):
            yield pa.RecordBatch.from_arrays(
                [t.column(0).combine_chunks(), enc.encode(t.column(1).combine_chunks(), end)], ["doc_id", "ids"])
    return run


@dataclass(frozen=True)
class Texts:
    """Coded texts, one after the other: all ids (each text's end id too) and the bounds."""

    ids: np.ndarray
    bounds: np.ndarray

    @staticmethod
    def of_column(column: pa.Array, kind: np.dtype) -> Texts:
        """The texts of a binary column without nulls, not copied."""
        bounds = np.frombuffer(column.buffers()[1], np.int32, len(column) + 1, 4 * column.offset)
        ids = np.frombuffer(column.buffers()[2] or b"", kind, (bounds[-1] - bounds[0]) // kind.itemsize, bounds[0])
        return Texts(ids, (bounds.astype(np.int64) - bounds[0]) // kind.itemsize)

    @staticmethod
    def of_parts(parts: list[bytes], kind: np.dtype) -> Texts:
        lengths = np.array([len(p) // kind.itemsize for p in parts], np.int64)
        return Texts(np.frombuffer(b"".join(parts), kind), np.concatenate([[0], np.cumsum(lengths)]))

    @property
    def lengths(self) -> np.ndarray:
        return np.diff(self.bounds)


def postings(texts: Texts, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, term, times) of the documents' ids without their end id, in that order."""
    terms = np.ones(len(texts.ids), bool)
    terms[texts.bounds[1:] - 1] = False
    count = len(texts.lengths)
    start = np.arange(count, dtype=np.uint32 if count * size < 1 << 32 else np.int64) * size
    keys = (np.repeat(start, texts.lengths) + texts.ids)[terms]
    keys.sort()
    first = np.flatnonzero(np.diff(keys, prepend=keys[:1] + 1)) if len(keys) else np.empty(0, np.int64)
    times = np.diff(first, append=len(keys))
    doc, term = np.divmod(keys[first], size)
    return doc.astype(np.int64), term.astype(np.int64), times


class Weights:
    """BM25 weights from counts over all documents."""

    def __init__(self, documents: int, tokens: int, found_in: np.ndarray) -> None:
        self.rarity = np.log1p((documents - found_in + 0.5) / (found_in + 0.5))
        self.mean = max(tokens / max(documents, 1), 1)

    def of(self, term: np.ndarray, times: np.ndarray, length: np.ndarray) -> np.ndarray:
        return self.rarity[term] * times * (K1 + 1) / (times + K1 * (1 - B + B * length / self.mean))


def leading(texts: Texts, weights: Weights) -> np.ndarray:
    """Each document's term of greatest weight (the lowest of equals); one past all terms without any."""
    size = len(weights.rarity)
    doc, term, times = postings(texts, size)
    out = np.full(len(texts.lengths), size)
    if len(doc):
        weight = weights.of(term, times, texts.lengths[doc])
        first = np.flatnonzero(np.diff(doc, prepend=-1))
        most = np.maximum.reduceat(weight, first)
        at = np.flatnonzero(weight == np.repeat(most, np.diff(first, append=len(doc))))
        owner, where = np.unique(doc[at], return_index=True)
        out[owner] = term[at[where]]
    return out


def totals(of, kind: np.dtype, size: int):
    """Adds up ``of(texts)`` (place, value) in each task and returns what is not zero."""
    def run(batches):
        held = np.zeros(size, np.int64)
        for b in batches:
            place, value = of(Texts.of_column(b.column(0), kind))
            held += np.bincount(place, value, size).astype(np.int64)
        at = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(held[at])], ["place", "value"])
    return run


def summed(df: DataFrame, of, kind: np.dtype, size: int) -> np.ndarray:
    rows = df.select("ids").mapInArrow(totals(of, kind, size), "place long, value long").groupBy("place").agg(F.sum("value").alias("value"))
    out = np.zeros(size, np.int64)
    for r in rows.collect():  # no more rows than the vocabulary has ids
        out[r["place"]] = r["value"]
    return out


def scattered(row: np.ndarray) -> np.ndarray:
    """A number in [0, 1) from each row's number, evenly spread (multiply and shift)."""
    x = row.astype(np.uint64) + np.uint64(1)
    for factor in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(factor)
    return (x >> np.uint64(11)) / float(1 << 53)


def dealt(kind: np.dtype, weights: Weights, line: np.ndarray, parts_: int):
    """Adds each document's part and its place within it."""
    ahead = np.cumsum(line) - line
    def run(batches):
        for b in batches:
            col = {n: b.column(i) for i, n in enumerate(b.schema.names)}
            term = leading(Texts.of_column(col["ids"], kind), weights)
            place = (ahead[term] + scattered(col["row"].to_numpy()) * line[term]) / max(line.sum(), 1)
            part = np.minimum((place * parts_).astype(np.int32), parts_ - 1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(part), pa.array(place), col["row"], col["doc_id"], col["ids"]], ["part", "place", "row", "doc_id", "ids"])
    return run


class Index:
    """The inverted index of a shard."""

    def __init__(self, parts: list[bytes], kind: np.dtype, weights: Weights) -> None:
        texts = Texts.of_parts(parts, kind)
        doc, term, times = postings(texts, len(weights.rarity))
        weight = weights.of(term, times, texts.lengths[doc])
        self.documents = len(parts)
        self.bounds = np.searchsorted(doc, np.arange(len(parts) + 1))
        self.by_document = term
        order = np.argsort(term, kind="stable")
        self.doc, self.weight = doc[order], weight[order]
        self.terms, self.first = np.unique(term[order], return_index=True)
        self.count = np.diff(self.first, append=len(order))

    def terms_of(self, document: int) -> np.ndarray:
        return self.by_document[self.bounds[document]:self.bounds[document + 1]]

    def scores(self, terms: np.ndarray) -> np.ndarray:
        """BM25 of all documents of the shard against ``terms``."""
        at = np.searchsorted(self.terms[:-1], terms)
        at = at[self.terms[at] == terms] if len(self.terms) else at[:0]
        count = self.count[at]
        places = np.arange(count.sum()) + np.repeat(self.first[at] - (np.cumsum(count) - count), count)
        return np.bincount(self.doc[places], self.weight[places], self.documents)


class Windows:
    """Fills windows shard by shard; ``done`` holds the pieces of closed ones."""

    def __init__(self, max_len: int, kind: np.dtype, weights: Weights) -> None:
        self.max_len, self.kind, self.weights = max_len, kind, weights
        self.done: list[tuple] = []
        self.open: list[tuple] = []  # doc_id, ids, start, length
        self.room, self.closed = max_len, 0
        self.seed: np.ndarray | None = None  # terms of the open window's seed

    def close(self, pieces: list[tuple]) -> None:
        offset = 0
        for doc_id, ids, start, length in pieces:
            cut = ids[self.kind.itemsize * start:self.kind.itemsize * (start + length)]
            crc = zlib.crc32(np.frombuffer(cut, self.kind).astype("<u4").tobytes())
            self.done.append((doc_id, start, length, crc, len(ids) // self.kind.itemsize, self.closed, offset, cut))
            offset += length
        self.closed += 1

    def place(self, doc_id: int | None, ids: bytes, terms: np.ndarray) -> None:
        """Place a document; where it opens the last window, it is that window's seed."""
        start, n = 0, len(ids) // self.kind.itemsize
        while start < n:
            if self.room == self.max_len:
                self.seed = terms
            length = min(self.room, n - start)
            self.open.append((doc_id, ids, start, length))
            start, self.room = start + length, self.room - length
            if not self.room:
                self.close(self.open)
                self.open, self.room, self.seed = [], self.max_len, None

    def shard(self, doc_ids: list, parts: list[bytes]) -> None:
        index = Index(parts, self.kind, self.weights)
        unused = np.ones(len(parts), bool)
        left, at = len(parts), 0

        def use(d: int) -> None:
            nonlocal left
            unused[d], left = False, left - 1
            self.place(doc_ids[d], parts[d], index.terms_of(d))

        while left:
            if self.seed is None:
                at += int(unused[at:].argmax())
                use(at)
                continue
            seed, window = self.seed, self.closed
            ranked = np.argsort(np.where(unused, -index.scores(seed), np.inf), kind="stable")
            for d in ranked[:left].tolist():
                use(d)
                if self.closed != window:
                    break

    def end(self) -> None:
        """Cut the last window into sequences of powers of two."""
        left = self.max_len - self.room
        pieces = self.open[::-1]
        while left:
            size = 1 << (left.bit_length() - 1)
            left, sequence = left - size, []
            while size:
                doc_id, ids, start, length = pieces.pop()
                take = min(size, length)
                sequence.append((doc_id, ids, start, take))
                if take < length:
                    pieces.append((doc_id, ids, start + take, length - take))
                size -= take
            self.close(sequence)
        self.open, self.room = [], self.max_len

    def batch(self, part: int, with_ids: bool) -> pa.RecordBatch:
        cols = list(zip(*self.done, strict=True)) or [[]] * 8
        self.done = []
        arrays = [pa.array(c, pa.int64()) for c in cols[:7]]
        arrays[5] = pa.array((part << 40) + np.array(cols[5], np.int64))
        names = [c.split()[0] for c in PIECES.split(", ")]
        return pa.RecordBatch.from_arrays(arrays + [pa.array(cols[7], pa.binary())] * with_ids, names + ["ids"] * with_ids)


def filled(kind: np.dtype, weights: Weights, max_len: int, shard_tokens: int, with_ids: bool):
    """Streams one part, in order, shard by shard."""
    def run(batches):
        windows, part, doc_ids, parts, held = Windows(max_len, kind, weights), 0, [], [], 0
        for b in batches:
            part = b.column(0)[0].as_py() if b.num_rows else part
            for doc_id, ids in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                doc_ids.append(doc_id)
                parts.append(ids)
                held += len(ids) // kind.itemsize
                if held >= shard_tokens:
                    windows.shard(doc_ids, parts)
                    doc_ids, parts, held = [], [], 0
                    yield windows.batch(part, with_ids)
        if parts:
            windows.shard(doc_ids, parts)
        windows.end()
        yield windows.batch(part, with_ids)
    return run


def pack(docs: DataFrame, path: str, max_len: int = MAX_LEN, end: int = END, shard_tokens: int = SHARD_TOKENS,
         with_ids: bool = True) -> DataFrame:
    """One row for each piece of each row of ``docs``: doc_id, start, length, ids_crc32,
    doc_tokens, sequence_id, offset, and the piece's ``ids`` (little-endian unsigned, 2 bytes
    each, or 4 where the vocabulary needs them).

    A text's ids end with ``end``; a null or empty text is that id alone, without terms.
    Sequences hold ``max_len`` ids, a power of two, but the last of each part, which hold
    smaller powers of two: none needs padding. Very long texts fill windows of their own up
    to a rest. Repeated rows and null or repeated doc_ids are packed like others; ties of a
    ranking go by place in the shard, and reruns agree. An empty table gives no rows; other
    columns are not read. The tokenizer must drop white space and end words with ``</w>``.
    """
    if max_len & (max_len - 1):
        raise ValueError("max_len must be a power of two")
    enc = encoder(path)
    kind, size = enc.kind, enc.size
    table = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), "text").mapInArrow(coded(path, end), CODED)
    table = stored(table.withColumn("row", F.monotonically_increasing_id()), "coded")
    n = table.agg(F.count("*").alias("documents"), F.coalesce(F.sum(F.octet_length("ids")), F.lit(0)).alias("bytes")).first()
    tokens = n["bytes"] // kind.itemsize

    def found(texts):
        term = postings(texts, size)[1]
        return term, np.ones(len(term), np.int64)

    weights = Weights(n["documents"], tokens, summed(table, found, kind, size))
    line = summed(table, lambda texts: (leading(texts, weights), texts.lengths), kind, size + 1)
    count = max(1, -(-tokens // PART_TOKENS), min(partitions(docs.sparkSession), -(-tokens // (2 * shard_tokens))))
    parted = (table.mapInArrow(dealt(kind, weights, line, count), f"part int, place double, row long, {CODED}")
              .repartitionById(count, F.col("part")).sortWithinPartitions("part", "place", "row").select("part", "doc_id", "ids"))
    return parted.mapInArrow(filled(kind, weights, max_len, shard_tokens, with_ids), PIECES + ", ids binary" * with_ids)
