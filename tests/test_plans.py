"""Plan shape checks: one Window node, broadcast dimensions, pushed-down
partition filters, one shuffle of the wide product rows."""

from __future__ import annotations

import os

from conftest import D, frame, inputs, plan_nodes, plan_text, product, stat

from shelfwise import jobs, schemas
from shelfwise.operators import performance
from shelfwise.plans import inventory
from shelfwise.sources import readers


def test_rolling_sums_use_one_window(spark):
    i = inputs(spark, stats=[stat(D(2024, 1, 5))])
    daily = performance.daily_performance(i.shopping_product_stats, i.geo_targets, i.language_codes)
    rolled = performance.rolling_performance(daily)
    assert plan_nodes(rolled, "Window") == 1
    assert plan_nodes(daily, "BroadcastHashJoin") == 2
    text = plan_text(daily)
    assert "partial_sum" in text   # map-side combine before the shuffle


def test_partition_filter_reaches_the_scan(spark, tmp_dir):
    path = os.path.join(tmp_dir, "p")
    df = frame(spark, [product(day=D(2024, 1, d)) for d in (1, 2)], schemas.PRODUCTS)
    jobs.write_partitioned(df, path, partition_column="partition_date")
    scan = readers.read_table(spark, path, schemas.PRODUCTS, "2024-01-02", "2024-01-02")
    text = plan_text(scan.select("product_id"))
    assert "PartitionFilters: [isnotnull(partition_date" in text
    assert "ReadSchema: struct<product_id:string>" in text


def test_inventory_shuffles_wide_rows_once(spark):
    view = inventory.inventory_view(inputs(spark, products=[product()], stats=[stat(D(2024, 1, 9))]))
    text = plan_text(view)
    # the final DISTINCT reuses the product-key partitioning: no Exchange
    # between the last join and the aggregate on top
    tree = [ln for ln in text.split("\n\n")[0].splitlines() if "(" in ln]
    assert "AdaptiveSparkPlan" in tree[0]
    assert "HashAggregate" in tree[1] and "HashAggregate" in tree[2]
    assert "Exchange" not in tree[3]


def test_products_are_read_twice_not_three_times(spark, tmp_dir):
    path = os.path.join(tmp_dir, "products")
    jobs.write_partitioned(frame(spark, [product()], schemas.PRODUCTS), path, partition_column="partition_date")
    i = inputs(spark, stats=[stat(D(2024, 1, 9))])
    i.products = readers.read_table(spark, path, schemas.PRODUCTS)
    assert plan_text(inventory.inventory_view(i)).split("\n\n")[0].count("Scan parquet") == 2


def test_cluster_settings_scale_with_the_shuffle():
    from shelfwise.session import cluster_settings

    small = cluster_settings(1 << 30, cores=4000)
    large = cluster_settings(40 << 40, cores=4000)          # 40 TiB wide shuffle
    assert int(small["spark.sql.shuffle.partitions"]) == 8000
    assert int(large["spark.sql.shuffle.partitions"]) == 40 * 4096
    assert large["spark.sql.files.maxPartitionBytes"] == str(256 * 1024 * 1024)
