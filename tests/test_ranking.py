"""Exact positions (MA6, MA8, MA11, MA21): against a sort, with hot groups, ties and NULLs."""

from __future__ import annotations

import os
import random

import pytest
from conftest import plan_nodes, plan_text
from pyspark.sql import functions as F

from shelfwise.operators import ranking
from shelfwise.plans import pricing


def _order():
    return [F.col("score").desc_nulls_last(), F.col("id").asc_nulls_first()]


def _frame(spark, data, parts=5):
    return spark.createDataFrame(data, "day string, id int, score double").repartition(parts)


def _sorted_positions(data):
    """Plain Python: positions per day by falling score (NULLs last), then id (NULLs first)."""
    want = []
    for day in {d for d, _, _ in data}:
        rows = sorted((r for r in data if r[0] == day),
                      key=lambda r: (r[2] is None, -(r[2] or 0), r[1] is not None, r[1] or 0))
        want += [(*r, i) for i, r in enumerate(rows, 1)]
    return sorted(want, key=str)


def _random_rows(seed, n):
    """One day holds two thirds of all rows, some scores tie, some values are NULL."""
    rng = random.Random(seed)
    ids = iter(range(n))
    return [(rng.choice(["hot"] * 6 + ["a", "b", None]), next(ids), rng.choice([None, 0.0, 1.5, float(rng.randint(0, 40))]))
            for _ in range(n)]


@pytest.mark.parametrize("partitions", [1, 3, 16])
@pytest.mark.parametrize("n", [1, 7, 600])
def test_positions_equal_a_sort(spark, n, partitions):
    data = _random_rows(n, n)
    got = ranking.with_positions(_frame(spark, data), ["day"], _order(), partitions=partitions)
    assert got.columns == ["day", "id", "score", "position"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == _sorted_positions(data)


def test_positions_without_a_broadcast(spark, monkeypatch):
    monkeypatch.setattr(ranking, "MOST_BROADCAST", 0)
    data = _random_rows(9, 300)
    got = ranking.with_positions(_frame(spark, data), ["day"], _order(), partitions=6)
    assert "Broadcast" not in plan_text(got)
    assert sorted((tuple(r) for r in got.collect()), key=str) == _sorted_positions(data)


def test_an_empty_list_and_many_groups(spark):
    assert ranking.with_positions(_frame(spark, []), ["day"], _order()).collect() == []
    data = [(f"d{i % 97}", i, float(i % 5)) for i in range(400)]
    got = ranking.with_positions(_frame(spark, data), ["day"], _order(), partitions=8)
    assert sorted((tuple(r) for r in got.collect()), key=str) == _sorted_positions(data)


def test_equal_rows_take_neighbouring_positions(spark):
    got = ranking.with_positions(_frame(spark, [("a", 1, 2.0)] * 50 + [("a", 1, 1.0)]), ["day"], _order(), partitions=4)
    assert sorted(r["position"] for r in got.where("score = 2").collect()) == list(range(1, 51))
    assert got.where("score = 1").first()["position"] == 51


def test_no_task_sees_a_whole_group(spark):
    """One day holds all rows: they lie in several partitions, and no window runs over them."""
    df = spark.range(20_000).selectExpr("'hot' AS day", "CAST(id AS INT) AS id", "CAST(hash(id) AS DOUBLE) AS score")
    ranking.drop_written(spark)
    got = ranking.with_positions(df, ["day"], _order(), partitions=8)
    ranged = spark.read.parquet(ranking._FOLDERS[-2])
    sizes = [r["count"] for r in ranged.groupBy(F.shiftright("__row", ranking.ROW_BITS)).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 2 * 20_000 / 8
    assert plan_nodes(got, "Window") == 0 and plan_nodes(got, "Sort") == 0 and plan_nodes(got, "Exchange") == 0
    assert got.where("position = 20000").count() == 1
    assert got.select("position").distinct().count() == 20_000


def test_what_positions_leave_can_be_dropped(spark):
    ranking.drop_written(spark)
    ranking.with_positions(_frame(spark, _random_rows(1, 20)), ["day"], _order()).count()
    left = list(ranking._FOLDERS)
    assert len(left) == 2 and all(os.path.exists(p.removeprefix("file:")) for p in left)
    ranking.drop_written(spark)
    assert not any(os.path.exists(p.removeprefix("file:")) for p in left) and not ranking._FOLDERS


def test_a_top_k_keeps_the_first_of_each_group(spark):
    data = _random_rows(5, 200)
    got = ranking.first_or_all(_frame(spark, data), ["day"], _order(), 3)
    assert sorted((tuple(r) for r in got.collect()), key=str) == [r for r in _sorted_positions(data) if r[3] <= 3]


def test_a_ranked_list_is_the_whole_list_with_positions(spark):
    from test_marts import _inventory

    inv = _inventory(spark, [(50.0 + i, 100_000_000) for i in range(30)])
    ranked = pricing.focus_brands(inv, ranked=True)
    assert ranked.drop("position").exceptAll(pricing.focus_brands(inv)).count() == 0
    assert sorted(r["position"] for r in ranked.collect()) == [1, 2]
    top = pricing.focus_brands(inv, k=1).first()
    assert ranked.where("position = 1").first().asDict() == top.asDict()
