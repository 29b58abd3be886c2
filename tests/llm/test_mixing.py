"""Balanced sampling: the flight's balances and expectations, and targets met by sources whose
sizes spread over three orders of magnitude."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest

from shelfwise.llm import mixing

SCHEMA = "doc_id long, text string, source string, size string, row string, p string, SOURCE string"


def spread_sizes(rng, n):
    return np.maximum(1, np.exp(rng.uniform(np.log(10), np.log(10_000), n))).astype(int).tolist()


@pytest.mark.parametrize("seed", range(6))
def test_flight_settles_large_documents_and_keeps_balances(seed):
    rng = np.random.default_rng(seed)
    size = spread_sizes(rng, 400)
    was = rng.uniform(0.05, 0.95, 400).tolist()
    p = list(was)
    mixing.flight(p, size, random.Random(seed).random)
    left = [s for s, x in zip(size, p, strict=True) if 0 < x < 1]
    assert len(left) <= 2 and all(s <= np.median(size) for s in left)
    assert sum(p) == pytest.approx(sum(was), abs=1e-5)
    assert sum(x * s for x, s in zip(p, size, strict=True)) == pytest.approx(sum(x * s for x, s in zip(was, size, strict=True)), rel=1e-7)


def test_flight_and_landing_keep_expectations():
    size = [5000, 900, 850, 400, 60, 55, 50, 45, 40, 30, 20, 10, 5, 5, 5]
    was = [0.3, 0.6, 0.2, 0.5, 0.7] + [0.4] * 10
    total = np.zeros(len(size))
    runs = 4000
    for seed in range(runs):
        p, draw = list(was), random.Random(seed).random
        mixing.flight(p, size, draw)
        mixing.land(p, size, draw)
        assert set(p) <= {0.0, 1.0}
        total += p
    assert total / runs == pytest.approx(np.array(was), abs=4 * (0.25 / runs) ** 0.5)


@pytest.mark.parametrize("size", [[7] * 9, [100, *[7] * 8], [3, 3], [5, 2], [4], [], [0, 0, 0, 9, 9]])
def test_equal_and_few_sizes(size):
    p = [0.35] * len(size)
    mixing.flight(p, size, random.Random(1).random)
    assert sum(p) == pytest.approx(0.35 * len(size))
    assert sum(x * s for x, s in zip(p, size, strict=True)) == pytest.approx(0.35 * sum(size))
    mixing.land(p, size, random.Random(2).random)
    assert set(p) <= {0.0, 1.0}


def test_repair_brings_sizes_back_and_leaves_near_ones_alone():
    size, was = [4000, 300, 200, 150, 100, 90, 80], [0.5] * 7
    want = 0.5 * sum(size)
    for start in ([0.0] * 7, [1.0] * 7, [0.0, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0]):
        p = list(start)
        mixing.repair(p, was, size, 100)
        reach = min(abs(want - sum(s for k, s in enumerate(size) if m >> k & 1)) for m in range(128))
        before = abs(want - sum(x * s for x, s in zip(start, size, strict=True)))
        after = abs(want - sum(x * s for x, s in zip(p, size, strict=True)))
        assert set(p) <= {0.0, 1.0} and reach <= after <= before and after <= 1600
    p = [1.0, 0.0, 0.0]
    mixing.repair(p, [1.0, 0.0, 0.3], [500, 400, 2], 1)  # what was certain stays
    assert p[:2] == [1.0, 0.0]


def test_sources_meet_their_targets(spark):
    rng = np.random.default_rng(8)
    rows = []
    for source, n in (("a", 6000), ("b", 50), ("c", 50), ("d", 300), ("e", 40), (None, 60)):
        rows += [(s, source) for s in spread_sizes(rng, n)]
    data = [(i, "w " * s, source, "1", "2", "3", "4") for i, (s, source) in enumerate(rows)]
    df = spark.createDataFrame(data, SCHEMA).repartition(4)
    got = mixing.mix(df).collect()
    source, taken, target = {i: r[1] for i, r in enumerate(rows)}, Counter(), {}
    for r in got:
        taken[source[r["doc_id"]]] += r["taken"]
        target[source[r["doc_id"]]] = r["target"]
    assert len(target) == 6
    for s, want in target.items():
        median = np.median([n for n, o in rows if o == s])
        assert abs(taken[s] - want) <= max(0.01 * want, median), s
    assert sorted(map(tuple, got)) == sorted(map(tuple, mixing.mix(df.repartition(7)).collect()))
