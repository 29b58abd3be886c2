"""Hard negatives and whitening against brute-force versions, with nulls, non-finite entries,
other lengths, ties, repeated rows, clashing columns and dependent dimensions."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfwise.llm import negatives, whitening

SCHEMA = "vec_id long, label int, embedding array<float>, id string, row string, n string, block string, entries string, VECTOR string"
EXTRA = ("a", "b", "c", "d", "e", "f")


def table(spark, rows, parts=3):
    return spark.createDataFrame([(*r, *EXTRA) for r in rows], SCHEMA).repartition(parts)


def vectors(n, width=5, seed=1):
    rng = np.random.default_rng(seed)
    return [(int(i), int(rng.integers(3)), [float(x) for x in rng.normal(size=width).astype(np.float32)]) for i in range(n)]


UNUSABLE = [(900, 1, None), (901, 1, [1.0, None, 0.0, 0.0, 0.0]), (902, 1, [float("nan")] * 5), (903, 1, [float("inf")] + [0.0] * 4),
            (904, 1, []), (905, 1, [1.0, 2.0])]


def mined(rows, positives=5, per=3):
    """Plain Python: rows are told apart by their place, repeated ones come in any order."""
    rows = [(i, n, label, np.floor(256 * np.array(v, float))) for n, (i, label, v) in enumerate(rows)
            if label is not None and v is not None and None not in v and len(v) == 5 and np.isfinite(v).all()]
    out = []
    for i, n, label, v in rows:
        if i is None or i % 50:
            continue
        scored = sorted(((-int(v @ w), j is None, j or 0, m, j, other) for j, m, other, w in rows if m != n))
        for s, _, _, _, p, _ in [x for x in scored if x[5] == label][:positives]:
            fit = [x for x in scored if x[5] != label and 50 * -s <= 100 * -x[0] <= 95 * -s][:per]
            out += [(i, p, k, x[4], -s, -x[0]) for k, x in enumerate(fit, 1)]
    return sorted(out, key=str)


HARD = vectors(400) + UNUSABLE + [
    (None, 1, [1.0, 1.0, 1.0, 1.0, 1.0]), (None, None, [1.0] * 5), (906, None, [1.0] * 5), (950, 0, [0.0] * 5), (1000, 7, [9.0] * 5),
    *[(907, 2, [0.5, 0.25, 0.5, 0.25, 0.5])] * 3, *[(50, 2, [0.5, 0.25, 0.5, 0.25, 0.5])] * 2, (908, 1, [300.0, -300.0, 1.0, 0.0, 0.0]),
    *[(2000 + i, i % 3, [1.0, 0.5, 0.25, 0.0, 0.0]) for i in range(60)]]


@pytest.mark.parametrize("how", [{}, {"blocks": 7, "clusters": 3}, {"blocks": 1, "clusters": 1}, {"blocks": 3, "clusters": 8}])
def test_negatives_equal_brute_force(spark, how):
    got = negatives.mine(table(spark, HARD), F.col("id") % 50 == 0, **how).collect()
    assert sorted(map(tuple, got), key=str) == mined(HARD)


def test_negatives_on_double_precision_and_other_counts(spark):
    rows = [(i, label, [1000 * x for x in v]) for i, label, v in vectors(150, seed=3)]
    got = negatives.mine(table(spark, rows), F.col("id") % 50 == 0, positives=2, negatives=4, blocks=2).collect()
    assert sorted(map(tuple, got), key=str) == mined(rows, 2, 4)


def test_few_or_no_rows_give_few_or_no_negatives(spark):
    def run(rows):
        return negatives.mine(table(spark, rows), F.col("id") % 50 == 0).collect()

    assert run([]) == []
    assert run(UNUSABLE) == []
    assert run([(1, 1, [1.0] * 5), (2, 2, [1.0] * 5)]) == []  # no anchor
    assert run([(50, 1, [1.0] * 5)]) == []
    assert run([(50, 1, [1.0] * 5), (2, 2, [0.6] * 5)]) == []  # no positive
    assert [tuple(r) for r in run([(50, 1, [1.0] * 5), (1, 1, [1.0] * 5), (2, 2, [0.6] * 5)])] == [
        (50, 1, 1, 2, 5 * 65536, 5 * 256 * 153)]


def test_the_walk_ends_before_the_list_does():
    """Certified termination: candidates far from all members are not scored."""
    rng = np.random.default_rng(0)
    near, far = rng.normal(size=(2000, 8)) + 40, rng.normal(size=(20_000, 8)) - 40
    block = negatives.Block(8, negatives.directions(np.ones((1, 8))), np.array([0.2]), np.float64)
    rows = np.floor(np.vstack([near, far]))
    block.row = block.id = np.arange(len(rows))
    block.label, block.norm, block.rows = np.zeros(len(rows), int), np.sqrt((rows ** 2).sum(axis=1)), rows

    class Counted(np.ndarray):
        seen = 0

        def __getitem__(self, at):
            if isinstance(at, np.ndarray):
                Counted.seen += len(at)
            return super().__getitem__(at)

    block.shared_list(0, 0, True)  # reads all rows once, to sort them
    block.rows = block.rows.view(Counted)
    members = {"low": np.full((4, 1), -np.inf), "high": np.full((4, 1), np.inf), "row": np.arange(4), "rows": rows[:4],
               "norm": block.norm[:4], "cluster": 0, "label": 0}
    _, found, score = negatives.walk(block, members, True, 5)
    want = [sorted((-int(rows[i] @ rows[j]), j) for j in range(len(rows)) if j != i)[:5] for i in range(4)]
    assert sorted(zip(-score, found, strict=True)) == sorted(x for w in want for x in w)
    assert Counted.seen < len(near)


def brute(rows, width, components=8):
    x = np.array([np.floor(1024 * np.array(v, float)) + 100_000 for _, v in rows], np.int64)
    n, sums = len(x), x.sum(axis=0)
    centred = (n * x - sums) / n
    e, axes = np.linalg.eigh(centred.T @ centred / n)
    e, axes = e[::-1], axes[:, ::-1]
    deviation = [sum(int(a) ** 2 for a in n * row - sums) for row in x]
    return n, deviation, centred @ axes / np.sqrt(np.maximum(e, 1e-300)), e / e.sum()


def check_whitened(spark, rows, width, count):
    usable = [(i, v) for i, _, v in rows if v is not None and None not in v and len(v) == width and np.isfinite(v).all()]
    n, deviation, z, explained = brute(usable, width)
    got = whitening.whiten(table(spark, rows)).collect()
    assert len(got) == count * len(usable)
    places = {i: k for k, (i, _) in enumerate(usable)}
    signs = {}
    for r in got:
        k, c = places[r["vec_id"]], r["component"] - 1
        assert (r["n"], r["deviation"]) == (n, deviation[k])
        assert r["explained"] == pytest.approx(explained[c], rel=1e-9)
        assert r["identity_error"] < 1e-9
        assert abs(r["whitened"]) == pytest.approx(abs(z[k, c]), abs=1e-7)
        if abs(z[k, c]) > 1e-3:
            signs.setdefault(c, set()).add(np.sign(r["whitened"] * z[k, c]))
    assert all(len(s) == 1 for s in signs.values())


def test_whitening_equals_the_covariance_eigenvectors(spark):
    scales = np.array([9.0, 7.0, 5.0, 3.0, 1.0])
    rows = [(i, label, list(map(float, v * scales))) for i, label, v in vectors(300)]
    check_whitened(spark, rows + UNUSABLE + [(None, 3, [0.5] * 5)], 5, 5)


def test_eight_components_of_more_and_nearly_dependent_dimensions(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(500, 12)) * np.linspace(400, 30, 12)
    base[:, 11] = base[:, 0] + rng.normal(size=500) * 0.01
    base = base.astype(np.float32)
    check_whitened(spark, [(i, 0, list(map(float, v))) for i, v in enumerate(base)], 12, 8)


@pytest.mark.parametrize("constant", [True, False])
def test_dimensions_without_variance_of_their_own(spark, constant):
    """A constant and a repeated dimension leave fewer components."""
    rows = [(i, label, [v[0], 4 * v[1], 9 * v[2], 9 * v[2], 0.25 if constant else v[0]]) for i, label, v in vectors(200)]
    check_whitened(spark, rows, 5, 3)


def test_whitening_without_variance_or_rows(spark):
    assert whitening.whiten(table(spark, [])).collect() == []
    assert whitening.whiten(table(spark, UNUSABLE[:5])).collect() == []
    assert whitening.whiten(table(spark, [(1, 0, [1.0] * 5)] * 4)).collect() == []
    got = whitening.whiten(table(spark, [(1, 0, [1.0, 2.0]), (1, 0, [3.0, 2.0]), (1, 0, [3.0, 2.0])]))
    assert sorted(abs(round(r["whitened"], 6)) for r in got.collect()) == [0.707107, 0.707107, 1.414214]


def test_a_model_of_other_rows_and_repeated_fits(spark):
    rows = table(spark, vectors(100))
    model = whitening.fit(rows)
    again = whitening.fit(rows.repartition(7))
    assert np.allclose(np.abs(model.axes), np.abs(again.axes), atol=1e-9)
    got = whitening.whiten(table(spark, vectors(40, seed=9)), model).collect()
    assert len(got) == 5 * 40 and got[0]["n"] == 100


def test_deviations_beyond_a_long_are_refused():
    with pytest.raises(OverflowError):
        whitening.squared(np.full((1, 4), 1 << 40))
    assert whitening.squared(np.array([[1 << 30, 3]])).tolist() == [(1 << 60) + 9]
