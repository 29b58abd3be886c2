"""Inventory view: joins, filters and semantics N2-N4, N8-N10 (FIXTURES.md §4)."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from conftest import D, benchmark, destination, insight, inputs, product, rows, stat

from shelfwise.plans import inventory
from shelfwise.schemas import INVENTORY_VIEW_COLUMNS

SNAP = D(2024, 1, 10)
PREV = SNAP - dt.timedelta(days=1)


def _view(spark, **kw):
    return inventory.inventory_view(inputs(spark, **kw))


def test_schema_and_filters(spark):
    products = [product(pid="a"), product(pid="b", channel="local"),
                product(pid="c", destinations=[destination(name="Display", approved=["US"])]),
                {**product(pid="d"), "destinations": None}]
    out = _view(spark, products=products)
    assert out.columns == INVENTORY_VIEW_COLUMNS
    assert rows(out, "product_id") == [("a",)]


def test_prices_category_and_struct(spark):
    products = [product(pid="a", price=10.0, sale_price=None, path=None),
                product(pid="b", price=10.0, sale_price=8.5, path="Toys"),
                product(pid="c", path="Root > Toys > Cars")]
    out = _view(spark, products=products)
    got = rows(out, "product_id", "current_price", "final_category")
    assert got == [("a", Decimal("10.000000000"), None), ("b", Decimal("8.500000000"), "Toys"),
                   ("c", Decimal("10.000000000"), "Cars")]
    attrs = out.where("product_id = 'a'").first()["additional_product_attributes"]
    assert attrs["custom_labels"]["label_0"] == "L0" and attrs["color"] == "red"


def test_aggregator_falls_back_to_merchant(spark):
    out = _view(spark, products=[product(pid="a", merchant=5), product(pid="b", aggregator_id=9)])
    assert rows(out, "product_id", "aggregator_id") == [("a", 5), ("b", 9)]


def test_product_without_country_keeps_false_flag_and_price_insights(spark):
    p = product(pid="a", destinations=[destination(approved=[], disapproved=[])])
    out = _view(spark, products=[p], pi=[insight(SNAP, "a", 9_000_000)],
                pc=[benchmark(SNAP, "a", "US", 11_000_000)],
                stats=[stat(PREV, item="Sku1", clicks=3)])
    r = out.collect()
    assert len(r) == 1
    assert r[0]["targeted_country"] is None and r[0]["is_disapproved"] is False
    assert r[0]["suggested_price"] == 9.0          # no country in the key
    assert r[0]["benchmark_price"] is None          # needs the country
    assert r[0]["clicks_30days"] is None            # needs the country


def test_benchmark_by_country_and_suggestion_repeated(spark):
    p = product(pid="a", destinations=[destination(approved=["US", "DE"])])
    out = _view(spark, products=[p], pc=[benchmark(SNAP, "a", "US", 12_340_000)],
                pi=[insight(SNAP, "a", 9_500_000)])
    got = rows(out, "targeted_country", "benchmark_price", "suggested_price")
    assert got == [("DE", None, 9.5), ("US", 12.34, 9.5)]


def test_performance_of_exactly_the_previous_day(spark):
    two_back = SNAP - dt.timedelta(days=2)
    out = _view(spark, products=[product(pid="a")], stats=[stat(two_back, clicks=5)])
    assert out.first()["clicks_30days"] is None     # no row on D-1: NULL, not the 30-day sum
    out = _view(spark, products=[product(pid="a")],
                stats=[stat(two_back, clicks=5), stat(PREV, clicks=1)])
    r = out.first()
    assert (r["clicks_30days"], r["clicks_7days"], r["impressions_30days"]) == (6, 6, 2)


def test_offer_matches_case_insensitively_with_fan_out(spark):
    stats = [stat(PREV, item="SKU1", clicks=1), stat(PREV, item="sku1", clicks=2),
             stat(PREV, item="SKU1", channel="LOCAL", clicks=1)]
    out = _view(spark, products=[product(pid="a", offer="Sku1")], stats=stats)
    # online/SKU1 and local/SKU1 agree in all metrics and merge; sku1 differs
    assert sorted(r["clicks_30days"] for r in out.collect()) == [1, 2]


def test_language_must_match(spark):
    out = _view(spark, products=[product(pid="a", language="de")], stats=[stat(PREV, clicks=1)])
    assert out.first()["clicks_30days"] is None


def test_duplicate_rows_give_one_row(spark):
    out = _view(spark, products=[product(pid="a"), product(pid="a")],
                pc=[benchmark(SNAP, "a", "US", 1_000_000)] * 2)
    assert out.count() == 1


def test_repeated_product_key_pairs_every_status_row(spark):
    # two snapshot rows of one key: each row meets the status rows of both
    p1 = product(pid="a", offer="Sku1", destinations=[destination(approved=["US"])])
    p2 = product(pid="a", offer="Sku2", destinations=[destination(approved=["DE"])])
    out = _view(spark, products=[p1, p2], stats=[stat(PREV, item="SKU2", country="geoTargetConstants/2276", clicks=7)])
    got = rows(out, "offer_id", "targeted_country", "clicks_30days")
    assert got == [("Sku1", "DE", None), ("Sku1", "US", None), ("Sku2", "DE", 7), ("Sku2", "US", None)]


def test_null_offer_keeps_status_rows(spark):
    out = _view(spark, products=[product(pid="a", offer=None)], stats=[stat(PREV)])
    got = rows(out, "targeted_country", "is_disapproved", "clicks_30days")
    assert got == [("US", False, None)]


def test_no_duplicates_and_left_joins_lose_no_product(spark):
    products = [product(pid=f"p{i}", offer=f"Sku{i}",
                        destinations=[destination(approved=["US"], disapproved=["US"] if i % 2 else [])])
                for i in range(6)]
    out = _view(spark, products=products, stats=[stat(PREV, item=f"SKU{i}", clicks=i) for i in range(6)])
    assert out.count() == out.distinct().count()
    assert {r["product_id"] for r in out.collect()} == {f"p{i}" for i in range(6)}
