"""Hamming search against all pairs: near and far codes, ties, empty sides, repeated rows and
clashing columns; no side of the probing join is broadcast."""

from __future__ import annotations

import numpy as np
import pytest

from shelfwise.llm import hamming_search

SCHEMA = "id long, code long, query long, part int, value long, query_code long, rank string, CODE string"


def table(spark, rows, parts=3):
    return spark.createDataFrame([(*r, 1, 2, 3, 4, "r", "c") for r in rows], SCHEMA).repartition(parts)


def all_pairs(items, queries, k):
    items = sorted({(i, c) for i, c in items if i is not None and c is not None})
    out = []
    for q, c in {(i, c) for i, c in queries if i is not None and c is not None}:
        near = sorted((bin((c ^ x) & (2 ** 64 - 1)).count("1"), i) for i, x in items)[:k]
        out += [(q, n, i, d) for n, (d, i) in enumerate(near, 1)]
    return sorted(out)


def some_codes(n=900, seed=2):
    """Random codes, near copies of a few of them, and one code that a third of the rows share."""
    rng = np.random.default_rng(seed)
    codes = rng.integers(-2 ** 63, 2 ** 63 - 1, n).tolist()
    for i in range(0, n, 5):
        codes[i] = codes[7] ^ (1 << int(rng.integers(63))) ^ (1 << int(rng.integers(63)))
    for i in range(1, n, 3):
        codes[i] = -1
    return codes


@pytest.mark.parametrize("k", [1, 4, 10])
def test_search_equals_all_pairs(spark, k):
    rows = list(enumerate(some_codes()))
    got = hamming_search.search(table(spark, rows), table(spark, [r for r in rows if r[0] % 20 == 0]), k)
    assert sorted(map(tuple, got.collect())) == all_pairs(rows, [r for r in rows if r[0] % 20 == 0], k)


def test_nulls_repeated_rows_and_few_items(spark):
    items = [(1, 5), (1, 5), (1, 6), (2, 5), (None, 5), (3, None), (4, -1)]
    queries = [(1, 5), (1, 5), (None, 5), (9, None), (9, -1), (9, 0)]
    got = hamming_search.search(table(spark, items), table(spark, queries), 10)
    want = all_pairs(items, queries, 10)
    assert sorted(map(tuple, got.collect())) == want and len(want) == 3 * 4


def test_empty_sides_give_no_rows(spark):
    some = [(1, 5)]
    for items, queries in (([], some), (some, []), ([], []), ([(None, None)], some), (some, [(1, None)])):
        got = hamming_search.search(table(spark, items), table(spark, queries))
        assert got.collect() == [] and got.columns == ["query_id", "rank", "neighbor_id", "distance"]


@pytest.mark.parametrize("blocks", [1, 3, 40])
def test_blocks_change_nothing(spark, blocks):
    rows = list(enumerate(some_codes(300)))
    got = hamming_search.search(table(spark, rows), table(spark, rows[::20]), 5, blocks=blocks)
    assert sorted(map(tuple, got.collect())) == all_pairs(rows, rows[::20], 5)


def unsigned(codes):
    return np.unique(np.array(codes, np.int64)).view(np.uint64)


@pytest.mark.parametrize("most_pairs", [1 << 21, 7])
def test_each_pair_is_met_once_and_every_pair_is(monkeypatch, most_pairs):
    monkeypatch.setattr(hamming_search, "MOST_PAIRS", most_pairs)
    codes = unsigned(some_codes(120))
    index = hamming_search.Index(codes, np.arange(len(codes)))
    met = []
    for radius in range(max(w for _, w in index.parts) + 1):
        for part, (_, width) in enumerate(index.parts):
            for q, c in index.met(codes[:9], part, radius) if radius <= width else ():
                new = index.first_met(codes[:9][q], codes[c], part, radius)
                met += zip(q[new].tolist(), c[new].tolist(), strict=True)
    assert sorted(met) == [(q, c) for q in range(9) for c in range(len(codes))]


def test_near_queries_verify_few_pairs():
    """Growth ends where the k-th distance is covered: most codes are never verified."""
    rng = np.random.default_rng(4)
    codes = np.unique(rng.integers(0, 2 ** 63, 20_000).astype(np.uint64))
    queries = np.concatenate([codes[:50]])
    near = np.concatenate([codes, *(queries ^ np.uint64(1 << b) for b in (3, 17, 40))])
    near = np.unique(near)
    index = hamming_search.Index(near, np.arange(len(near)))
    q, c, distance, verified = index.nearest(queries, 4)
    assert len(q) == 200 and sorted(distance.tolist()) == [0] * 50 + [1] * 150
    assert verified < 50 * len(near) / 100


def test_no_side_is_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")
    try:
        rows = list(enumerate(some_codes(60)))
        got = hamming_search.search(table(spark, rows), table(spark, rows[:5]), 3)
        assert "Broadcast" not in got._jdf.queryExecution().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
