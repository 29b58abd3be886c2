"""Mutation checks: shortening a frame by one day, dropping the
case folding or the one-day shift must change a result the tests look at."""

from __future__ import annotations

import datetime as dt

import pytest
from conftest import D, inputs, product, stat
from pyspark.sql import functions as F

from shelfwise.operators import performance
from shelfwise.plans import inventory

SNAP = D(2024, 2, 10)


def _clicks(spark, stats, offer="Sku1"):
    i = inputs(spark, products=[product(day=SNAP, offer=offer)], stats=stats)
    r = inventory.inventory_view(i).first()
    return r["clicks_30days"], r["clicks_7days"]


def _stats():
    prev = SNAP - dt.timedelta(days=1)
    return [stat(prev, clicks=1),
            stat(prev - dt.timedelta(days=7), clicks=10),     # 7 days before D-1
            stat(prev - dt.timedelta(days=30), clicks=100)]   # 30 days before D-1


def test_unmutated(spark):
    assert _clicks(spark, _stats()) == (111, 11)


@pytest.mark.parametrize("name,value", [("LONG_WINDOW_DAYS", 29), ("SHORT_WINDOW_DAYS", 6)])
def test_shorter_frames_change_the_result(spark, monkeypatch, name, value):
    monkeypatch.setattr(performance, name, value)
    assert _clicks(spark, _stats()) != (111, 11)


def test_case_folding_matters(spark, monkeypatch):
    monkeypatch.setattr(F, "lower", lambda c: F.col(c) if isinstance(c, str) else c)
    assert _clicks(spark, _stats()) == (None, None)   # 'SKU1' no longer meets 'Sku1'


def test_one_day_shift_matters(spark, monkeypatch):
    monkeypatch.setattr(F, "date_add", lambda c, n: F.col(c) if isinstance(c, str) else c)
    assert _clicks(spark, _stats()) == (None, None)   # day D-1 no longer meets day D
