"""Lexical retrieval packing: ids against the library, windows against a plain version."""

from __future__ import annotations

import math
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import pytest

from shelfwise.llm import lexical_packing as packing
from shelfwise.llm.split_tokens import NOT_SPACE, SplitEncoder
from shelfwise.llm.tokens import gathered

PATH = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, part string, place string, row string, ids string, n string"
TOPICS = ["river boat sail water fish harbour", "engine wheel motor road driver fuel", "bread oven flour butter baker salt"]


def some_texts(n=120, seed=4):
    rng = random.Random(seed)
    return [" ".join(rng.choices(TOPICS[i % 3].split() + ["the", "of", "and"], k=rng.randint(3, 90))) for i in range(n)]


ODD = [None, "", " \n\t ", "Don't stop, it's 3.5% — OK... (really)", "é è. ñ, ß  日本。語 🎉 İstanbul ΑΣ Å", "x <|endoftext|> y",
       "a\x1cb \x1f c", "word" * 40, "w1,x2. a.b.c ,, .. ½ ²", "A B　C D\u0085E", " lead", "trail ", "ﬁne été.",
       " ".join(f"w{i % 977}x{i % 13}" for i in range(3000)), "same text here", "same text here", "'s 'S ’s don''t"]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


def ids_of(library, texts):
    return [[*e.ids, packing.END] for e in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_the_encoder_gives_the_librarys_ids(library):
    rng = random.Random(2)
    signs = "abcZ é İ ß.,' \n\t  日½9_-<|>́\x1d\x00Σς"
    texts = ODD + ["".join(rng.choices(signs, k=rng.randint(0, 60))) for _ in range(3000)]
    want = [e.ids for e in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    for most in (800_000, 200):
        encoder = SplitEncoder(PATH, most=most, longest=8)
        for _ in range(2):  # the second time from memory
            got = [x for i in range(0, len(texts), 100) for x in encoder.encode(pa.array(texts[i:i + 100], pa.string())).to_pylist()]
            assert [np.frombuffer(x, encoder.kind).tolist() for x in got] == want


def test_the_end_id_follows_each_text(library):
    encoder = SplitEncoder(PATH)
    for texts in (ODD, some_texts(5), [None], ["", ""]):
        got = encoder.encode(pa.array(["skipped", *texts], pa.string())[1:], end=2).to_pylist()
        assert [np.frombuffer(x, encoder.kind).tolist() for x in got] == ids_of(library, texts)
    assert len(encoder.encode(pa.array([], pa.string()), end=2)) == 0


def test_arrow_and_the_tokenizer_agree_on_white_space(library):
    """Whatever Arrow splits at, the tokenizer drops, but for the characters sent to it whole."""
    other = library.encode("a b", add_special_tokens=False).ids
    signs = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    split = pc.list_value_length(pc.utf8_split_whitespace(pa.array([f"a{c}b" for c in signs]))).to_numpy()
    assert sum(split > 1) > 20
    for c, n in zip(signs, split, strict=True):
        if n > 1:
            assert (library.encode(f"a{c}b", add_special_tokens=False).ids == other) == (c not in NOT_SPACE)


def test_batches_are_gathered_by_bytes():
    batches = [pa.RecordBatch.from_pydict({"id": list(range(len(x))), "text": pa.array(x, pa.string())}) for x in (
        ["ab", None, "", "abcd", "a"], [], ["b", "c", "d", "efghi"], ["j"])]
    got = [t.column(1).to_pylist() for t in gathered(iter(batches), 3)]
    assert got == [["ab", None, ""], ["abcd"], ["a", "b", "c"], ["d"], ["efghi"], ["j"]]
    assert [t.num_rows for t in gathered(iter(batches), 1000)] == [10]
    assert list(gathered(iter([]), 3)) == []


def check_pieces(got, docs, library, max_len):
    """Each id in one piece, sequences without gaps, none that needs padding."""
    want = Counter()
    for (doc_id, *_), ids in zip(docs, ids_of(library, [t for _, t in docs]), strict=True):
        want[doc_id] += len(ids)
    assert Counter({k: sum(r["length"] for r in got if r["doc_id"] == k) for k in want}) == want
    by_id = {d: ids for (d, _), ids in zip(docs, ids_of(library, [t for _, t in docs]), strict=True)}
    single = {d for d, n in Counter(d for d, _ in docs).items() if n == 1}
    for d in single:
        at = 0
        for r in sorted((r for r in got if r["doc_id"] == d), key=lambda r: r["start"]):
            ids = by_id[d][r["start"]:r["start"] + r["length"]]
            assert (r["start"], r["doc_tokens"]) == (at, len(by_id[d]))
            assert r["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
            if "ids" in r:
                assert np.frombuffer(bytes(r["ids"]), "<u2").tolist() == ids
            at += r["length"]
        assert at == len(by_id[d])
    sequences = {}
    for r in got:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at and length > 0
            at += length
        assert at <= max_len and at & (at - 1) == 0
    return [sum(n for _, n in p) for p in sequences.values()]


@pytest.mark.parametrize(("max_len", "shard_tokens"), [(4096, 1 << 19), (64, 500), (32, 1)])
def test_every_id_is_in_one_piece_of_a_full_sequence(spark, library, max_len, shard_tokens):
    docs = list(enumerate(ODD + some_texts())) + [(3, ODD[3])] * 2 + [(None, "no id"), (None, None)]
    df = spark.createDataFrame([(*d, "p", "q", "r", "i", "n") for d in docs], SCHEMA).repartition(3)
    got = [r.asDict() for r in packing.pack(df, PATH, max_len=max_len, shard_tokens=shard_tokens).collect()]
    lengths = check_pieces(got, docs, library, max_len)
    parts = len({r["sequence_id"] >> 40 for r in got})
    assert sum(n < max_len for n in lengths) <= parts * max_len.bit_length()
    again = packing.pack(df, PATH, max_len=max_len, shard_tokens=shard_tokens, with_ids=False).collect()
    assert sorted(map(tuple, again), key=str) == sorted((tuple(r.values())[:7] for r in got), key=str)


def test_an_empty_table_and_a_wrong_length(spark):
    assert packing.pack(spark.createDataFrame([], SCHEMA), PATH).collect() == []
    with pytest.raises(ValueError, match="power of two"):
        packing.pack(spark.createDataFrame([], SCHEMA), PATH, max_len=100)


def bm25(query, document, documents):
    """The formula, over lists of ids without the end id; lengths count the end id."""
    n, mean = len(documents), sum(len(d) + 1 for d in documents) / len(documents)
    score = 0.0
    for t in set(query):
        tf, df = document.count(t), sum(t in d for d in documents)
        if tf:
            score += math.log(1 + (n - df + 0.5) / (df + 0.5)) * tf * (packing.K1 + 1) / (
                tf + packing.K1 * (1 - packing.B + packing.B * (len(document) + 1) / mean))
    return score


@pytest.fixture(scope="module")
def shard(library):
    ids = ids_of(library, some_texts(60))
    kind = np.dtype("<u2")
    parts = [np.array(x, kind).tobytes() for x in ids]
    terms = [x[:-1] for x in ids]
    found = np.bincount(np.concatenate([np.unique(t) for t in terms]), minlength=49408)
    return parts, terms, kind, packing.Weights(len(ids), sum(map(len, ids)), found)


def test_texts_of_a_column_and_of_parts_agree(shard):
    parts, _, kind, _ = shard
    parts = [np.array([2], kind).tobytes(), *parts]
    for a, b in ((0, len(parts)), (3, 9), (0, 1), (5, 5)):
        column, other = packing.Texts.of_column(pa.array(parts, pa.binary()).slice(a, b - a), kind), packing.Texts.of_parts(parts[a:b], kind)
        assert column.ids.tolist() == other.ids.tolist() and column.bounds.tolist() == other.bounds.tolist()


def test_the_index_scores_by_bm25(shard):
    parts, terms, kind, weights = shard
    index = packing.Index(parts, kind, weights)
    for d in (0, 7, 30):
        assert sorted(set(terms[d])) == index.terms_of(d).tolist()
        assert index.scores(index.terms_of(d)) == pytest.approx([bm25(terms[d], t, terms) for t in terms])
    assert index.scores(np.array([3, 49407])).tolist() == [bm25([3, 49407], t, terms) for t in terms]
    assert packing.Index(parts[:1], kind, weights).scores(np.array([], int)).tolist() == [0]


def test_the_leading_term_weighs_most(shard):
    parts, terms, kind, weights = shard
    got = packing.leading(packing.Texts.of_parts([*parts, np.array([2], kind).tobytes()], kind), weights)
    for t, lead in zip(terms, got, strict=False):
        own = {x: weights.of(np.array([x]), np.array([t.count(x)]), np.array([len(t) + 1]))[0] for x in t}
        assert lead == min(x for x in own if own[x] == max(own.values()))
    assert got[-1] == len(weights.rarity)


def plain_fill(parts, terms, order, max_len):
    """The documents of each window, by the definition."""
    unused, windows, window, room, seed = list(order), [], [], max_len, None
    ranked = []
    while unused:
        if seed is None:
            d = unused[0]
        else:
            if not ranked:
                ranked = sorted(unused, key=lambda x: (-round(bm25(terms[seed], terms[x], terms), 9), x))
            d = ranked.pop(0)
        unused.remove(d)
        left = len(parts[d]) // 2
        while left:
            if room == max_len:
                seed, ranked = d, []
            take = min(left, room)
            window.append((d, take))
            left, room = left - take, room - take
            if not room:
                windows.append(window)
                window, room, seed, ranked = [], max_len, None, []
    return windows, window


@pytest.mark.parametrize("max_len", [32, 128, 512])
def test_windows_hold_the_seeds_neighbours(shard, max_len):
    parts, terms, kind, weights = shard
    windows = packing.Windows(max_len, kind, weights)
    windows.shard(list(range(len(parts))), parts)
    full, rest = plain_fill(parts, terms, range(len(parts)), max_len)
    got = {}
    for doc_id, _, length, _, _, sequence, _, _ in windows.done:
        got.setdefault(sequence, []).append((doc_id, length))
    assert list(got.values()) == full
    assert [(d, n) for d, _, _, n in windows.open] == rest


def test_a_window_goes_on_in_the_next_shard(shard):
    parts, _, kind, weights = shard
    windows = packing.Windows(1 << 12, kind, weights)
    for i in range(0, 60, 5):
        windows.shard(list(range(i, i + 5)), parts[i:i + 5])
    windows.end()
    lengths = Counter()
    for _, _, length, _, _, sequence, _, _ in windows.done:
        lengths[sequence] += length
    total = sum(len(p) // 2 for p in parts)
    assert sorted(lengths.values(), reverse=True) == [4096] * (total // 4096) + [
        1 << b for b in range(12, -1, -1) if total % 4096 >> b & 1]


def test_a_term_that_leads_most_documents_covers_most_parts(shard):
    """The line of tokens spreads a hot leading term over the parts."""
    _, _, kind, weights = shard
    rng = np.random.default_rng(1)
    line = np.zeros(49409, np.int64)
    line[[5, 900, 40_000]] = [100, 9000, 900]
    place = (np.cumsum(line) - line)[900] + packing.scattered(rng.integers(0, 1 << 40, 20_000)) * 9000
    share = np.bincount((place / 10_000 * 10).astype(int), minlength=10) / 20_000
    assert share[0] == pytest.approx(0.11, abs=0.02) and share[1:9] == pytest.approx(np.full(8, 0.111), abs=0.02)


def test_related_documents_meet(spark):
    """Topics are dealt at random; windows hold one topic mostly."""
    docs = [(i, t) for i, t in enumerate(some_texts(300))]
    df = spark.createDataFrame([(*d, "p", "q", "r", "i", "n") for d in docs], SCHEMA).repartition(5)
    got = packing.pack(df, PATH, max_len=256, shard_tokens=1 << 19).collect()
    windows = {}
    for r in got:
        windows.setdefault(r["sequence_id"], Counter())[r["doc_id"] % 3] += r["length"]
    pure = sum(max(w.values()) for w in windows.values()) / sum(sum(w.values()) for w in windows.values())
    assert pure > 0.85


def test_gathering_gives_memory_back_at_its_end(monkeypatch):
    """What Arrow holds for the last texts goes back too: workers are kept between tasks, and an
    executor can have more of them than cores."""
    from shelfwise.llm import tokens

    given_back = []

    class Pool:
        def release_unused(self):
            given_back.append(True)

    monkeypatch.setattr(tokens.pa, "default_memory_pool", Pool)
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array(["a red house", None])], ["doc_id", "text"])
    (table,) = gathered([batch])
    assert table.num_rows == 2 and given_back == [True]
