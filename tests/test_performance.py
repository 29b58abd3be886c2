"""Ad performance: dimensions, daily sums, rolling 30/7-day frames (N1, N2, N6, N12, N13)."""

from __future__ import annotations

import datetime as dt

import pytest
from conftest import D, frame, inputs, rows, stat

from shelfwise import schemas
from shelfwise.operators import dims, performance


def _daily(spark, stats, **kw):
    i = inputs(spark, stats=stats, **kw)
    return performance.daily_performance(i.shopping_product_stats, i.geo_targets, i.language_codes)


def test_dimensions_are_distinct(spark):
    i = inputs(spark)
    assert rows(dims.geo_countries(i.geo_targets), "parent_id", "country_code") == [
        (2276, "DE"), (2840, "US")]
    assert rows(dims.language_codes(i.language_codes), "criterion_id", "language_code") == [
        (1000, "en"), (1001, "de")]


def test_daily_sums_and_inner_joins(spark):
    day = D(2024, 1, 5)
    stats = [
        stat(day, clicks=1, cost_micros=1_500_000),
        stat(day, clicks=0, cost_micros=500_000, conversions=1.0, value=20.0),
        stat(day, item=None),                                   # FI1: no item id
        stat(day, country="noslash"),                           # no second segment -> NULL id
        stat(day, country="geoTargetConstants/9999"),           # no such parent id
        stat(day, language="languageConstants/4242"),           # no such language
    ]
    out = _daily(spark, stats)
    got = rows(out, "offer_id", "channel", "target_country", "language_code", "impressions",
               "clicks", "cost", "conversions", "conversions_value")
    # the duplicated geo and language rows must not double count
    assert got == [("SKU1", "online", "US", "en", 2, 1, 2.0, 1.0, 20.0)]


def test_malformed_resource_id_raises(spark):
    out = _daily(spark, [stat(D(2024, 1, 5), country="x/abc")])
    with pytest.raises(Exception):
        out.collect()


def test_country_matches_parent_id_only(spark):
    # location 1 (own id) is a child of 2840; an ad id of 1 must not match
    out = _daily(spark, [stat(D(2024, 1, 5), country="geoTargetConstants/1")])
    assert out.count() == 0


def _rolling(spark, stats):
    return performance.rolling_performance(_daily(spark, stats))


@pytest.mark.parametrize("days_back,in_30,in_7", [(7, True, True), (8, True, False),
                                                   (30, True, False), (31, False, False)])
def test_frame_edges(spark, days_back, in_30, in_7):
    today = D(2024, 2, 10)
    old = today - dt.timedelta(days=days_back)
    stats = [stat(today, clicks=1), stat(old, clicks=10)]
    out = {r["date"]: r for r in _rolling(spark, stats).collect()}
    assert out[today]["clicks_30days"] == (11 if in_30 else 1)
    assert out[today]["clicks_7days"] == (11 if in_7 else 1)
    assert out[today]["impressions_30days"] >= out[today]["impressions_7days"]


def test_same_day_rows_of_two_runs_are_peers(spark):
    day = D(2024, 1, 5)
    stats = [stat(day, clicks=1, latest=D(2024, 3, 1)), stat(day, clicks=2, latest=D(2024, 3, 2)),
             stat(day - dt.timedelta(days=1), clicks=4)]
    out = [r for r in _rolling(spark, stats).collect() if r["date"] == day]
    assert len(out) == 2
    assert {r["clicks_30days"] for r in out} == {7}


def test_channel_and_case_are_separate_window_keys(spark):
    day = D(2024, 1, 5)
    stats = [stat(day, channel="ONLINE", clicks=1), stat(day, channel="Local", clicks=2),
             stat(day, item="sku1", clicks=4)]
    got = rows(_rolling(spark, stats), "channel", "offer_id", "clicks_30days")
    assert got == [("local", "SKU1", 2), ("online", "SKU1", 1), ("online", "sku1", 4)]


def test_snapshot_join_keys(spark):
    day = D(2024, 1, 5)
    out = performance.performance_for_snapshot_join(_rolling(spark, [stat(day, item="SkU1")]))
    assert rows(out, "offer_key", "date", "targeted_country", "content_language") == [
        ("sku1", D(2024, 1, 6), "US", "en")]


def test_empty_stats(spark):
    empty = frame(spark, [], schemas.SHOPPING_PRODUCT_STATS)
    i = inputs(spark)
    assert performance.daily_performance(empty, i.geo_targets, i.language_codes).count() == 0
