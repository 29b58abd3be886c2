"""Best-seller view: cluster joins (N11), full category, unmatched rows."""

from __future__ import annotations

import datetime as dt

from conftest import D, benchmark, destination, inputs, product, rows, stat

from shelfwise.plans import best_sellers
from shelfwise.schemas import BEST_SELLERS_VIEW_COLUMNS

WEEK = D(2024, 1, 8)


def cluster(entity, country="US", l3="", l4=None, **extra):
    row = {"partition_date": WEEK, "country_code": country, "report_category_id": 1,
           "entity_id": entity, "title": f"t{entity}", "brand": "B", "category_l1": "Toys",
           "category_l2": "Cars", "category_l3": l3, "category_l4": l4, "category_l5": None,
           "variant_gtins": "1 2", "product_inventory_status": "IN_STOCK",
           "brand_inventory_status": "IN_STOCK", "rank": 1, "previous_rank": 2,
           "relative_demand": "HIGH", "previous_relative_demand": "LOW",
           "relative_demand_change": "RISER"}
    row.update(extra)
    return row


def mapping(entity, pid, day=WEEK):
    return {"partition_date": day, "entity_id": entity, "product_id": pid}


def test_matches_and_unmatched_rows(spark):
    products = [product(day=WEEK, pid="p1", offer="Sku1", channel="local",
                        destinations=[destination(approved=["US"], disapproved=["US"])]),
                product(day=WEEK, pid="p2", offer="Sku2", destinations=[destination(approved=["DE"])])]
    i = inputs(spark, products=products,
               clusters=[cluster("e1"), cluster("e2"), cluster("e3")],
               mapping=[mapping("e1", "p1"), mapping("e2", "p2")],
               pc=[benchmark(WEEK, "p1", "US", 5_000_000)],
               stats=[stat(WEEK - dt.timedelta(days=1), item="sku1", clicks=4)])
    out = best_sellers.best_sellers_view(i)
    assert out.columns == BEST_SELLERS_VIEW_COLUMNS
    got = rows(out, "entity_id", "product_id", "is_disapproved", "benchmark_price", "clicks_30days",
               "full_category")
    assert got == [
        ("e1", "p1", True, 5.0, 4, "Toys > Cars"),   # local channel kept here
        ("e2", None, None, None, None, "Toys > Cars"),  # mapped product not sold in US
        ("e3", None, None, None, None, "Toys > Cars"),  # no mapping
    ]


def test_cluster_day_must_equal_mapping_and_product_day(spark):
    products = [product(day=WEEK + dt.timedelta(days=1), pid="p1")]
    i = inputs(spark, products=products, clusters=[cluster("e1")], mapping=[mapping("e1", "p1")])
    assert rows(best_sellers.best_sellers_view(i), "product_id") == [(None,)]


def test_full_category_skips_blanks(spark):
    cl = [cluster("e1", category_l1="", category_l2=None, l3="", l4=None),
          cluster("e2", l3="Small", l4="")]
    got = rows(best_sellers.best_sellers_view(inputs(spark, clusters=cl)), "entity_id", "full_category")
    assert got == [("e1", ""), ("e2", "Toys > Cars > Small")]


def test_empty_inputs_build(spark):
    assert best_sellers.best_sellers_view(inputs(spark)).count() == 0
