"""What the shuffles of the views and of the daily job carry: keys and counts of partitions,
clusters that are shuffled once, and views built some days at a time."""

from __future__ import annotations

import os
import re
from dataclasses import replace

import pytest
from conftest import D, benchmark, destination, frame, inputs, insight, plan_text, product, stat
from test_best_sellers import cluster, mapping
from test_bucketed import _above
from test_tables import _days, _tables

from shelfwise import jobs, schemas
from shelfwise.plans import best_sellers, inventory, popularity
from shelfwise.session import partitions_for
from shelfwise.sources import readers, tables

DAY, PREV = D(2024, 1, 8), D(2024, 1, 7)


def _inputs(spark):
    return inputs(
        spark, products=[product(day=d, pid=f"p{k}", offer=f"Sku{k}") for d in (PREV, DAY) for k in range(20)],
        stats=[stat(PREV, item=f"SKU{k}", clicks=k) for k in range(10)],
        pc=[benchmark(DAY, f"p{k}", "US", 9_000_000 + k) for k in range(0, 20, 3)],
        pi=[insight(DAY, f"p{k}", 8_000_000 + k) for k in range(0, 20, 4)],
        clusters=[cluster(f"e{k}", rank=k) for k in range(10)], mapping=[mapping(f"e{k}", f"p{k}") for k in range(0, 10, 2)])


def _text(df):
    return sorted(map(str, df.collect()))


def test_product_rows_are_dealt_by_product_not_by_day(spark):
    text = plan_text(inventory.inventory_view(_inputs(spark)))
    assert "hashpartitioning(product_id" in text
    assert "hashpartitioning(date" not in text


def test_partitions_go_by_rows_where_the_cores_are_too_few(spark):
    cores, shuffles = spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert partitions_for(spark, cores) is None
    assert partitions_for(spark, cores + 1) == max(cores + 1, shuffles)
    assert partitions_for(spark, 5000) == 5000
    few = _inputs(spark)
    many = replace(few, partitions=13)
    for view in (inventory.inventory_view, best_sellers.best_sellers_view):
        counts = set(re.findall(r"hashpartitioning\((?:product_id|entity_id|merchant_id, offer_key)[^)]*, (\d+)\)", plan_text(view(many)).replace("#", "")))
        assert counts == {"13"}
        assert _text(view(many)) == _text(view(few))


def test_clusters_are_shuffled_once_up_to_the_details(spark, tmp_dir):
    i = _inputs(spark)
    path = os.path.join(tmp_dir, "clusters")
    i.best_sellers_clusters.write.parquet(path)
    i.best_sellers_clusters = spark.read.schema(schemas.BEST_SELLERS_CLUSTERS).parquet(path)
    details = popularity.best_sellers_details(best_sellers.best_sellers_rows(i))
    paths = _above(details, r"ReadSchema: struct<.*relative_demand")
    assert len(paths) == 1 and paths[0].count("Exchange") == 1
    assert len(_text(details)) == 10


def test_every_mapped_product_of_a_cluster_counts(spark):
    """Rows before the DISTINCT, repeats included: named twice, one of two sold, no product, no entity."""
    i = inputs(spark, products=[product(day=DAY, pid="p1", merchant=1), product(day=DAY, pid="p1", merchant=2),
                                product(day=DAY, pid="p2", destinations=[destination(approved=["DE"])]),
                                product(day=DAY, pid=None)],
               clusters=[cluster(e) for e in ("e1", "e2", "e3", "e4", None)] + [cluster("e2", country="DE")],
               mapping=[mapping("e1", "p1"), mapping("e1", "p1"), mapping("e2", "p1"), mapping("e2", "p2"),
                        mapping("e3", None), mapping(None, "p1")])
    got = sorted((str(r["entity_id"]), r["country_code"], str(r["product_id"]), str(r["merchant_id"]))
                 for r in best_sellers.best_sellers_rows(i).collect())
    assert got == sorted(
        [("e1", "US", "p1", m) for m in "12"] * 2 + [("e2", "US", "p1", m) for m in "12"]
        + [("e2", "US", "None", "None"), ("e2", "DE", "None", "None"), ("e2", "DE", "p2", "1")]
        + [(e, "US", "None", "None") for e in ("e3", "e4", "None")])


def test_views_built_some_days_at_a_time_are_the_same(spark, tmp_dir):
    i = _inputs(spark)
    paths = readers.InputPaths(os.path.join(tmp_dir, "in"))
    undated = frame(spark, [product(day=None, pid="undated")], schemas.PRODUCTS)
    for name, df, column in [
            ("products", i.products.unionByName(undated), "partition_date"), ("price_competitiveness", i.price_competitiveness, "partition_date"),
            ("price_insights", i.price_insights, "partition_date"), ("shopping_product_stats", i.shopping_product_stats, "data_date"),
            ("best_sellers_product_cluster_weekly", i.best_sellers_clusters, "partition_date"),
            ("best_sellers_entity_product_mapping", i.best_sellers_mapping, "partition_date")]:
        df.coalesce(1).write.partitionBy(column).parquet(paths.path(name))
    for name, df in [("geo_targets", i.geo_targets), ("language_codes", i.language_codes)]:
        df.coalesce(1).write.parquet(paths.path(name))
    whole, small = (jobs.DailyConfig(inputs=paths, output_root=os.path.join(tmp_dir, name), **more)
                    for name, more in (("whole", {}), ("small", {"batch_bytes": 1})))
    assert [s for s, _ in jobs.batches(spark, whole, jobs.INVENTORY_TABLE)] == [None]
    assert [s for s, _ in jobs.batches(spark, small, jobs.INVENTORY_TABLE)] == [None, DAY]
    assert [s for s, _ in jobs.batches(spark, small, jobs.INVENTORY_TABLE, [DAY])] == [None]
    jobs.run_daily(spark, whole)
    jobs.run_daily(spark, small)
    assert "undated" in str(_tables(spark, whole)) and _tables(spark, small) == _tables(spark, whole)
    assert tables.manifest(spark, f"{small.output_root}/{jobs.INVENTORY_TABLE}").number == 1


def test_frames_written_one_after_the_other_are_switched_together(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    tables.replace_days([_days(spark, {1: 10, 2: 20}), _days(spark, {3: 30})], path, "date")
    assert tables.manifest(spark, path).number == 1 and tables.read(spark, path).count() == 9
    sizes = tables.day_bytes(spark, path, "date")
    assert sorted(sizes) == ["2024-01-01", "2024-01-02", "2024-01-03"] and min(sizes.values()) > 0
    bad = spark.sql("SELECT CAST(raise_error('no') AS INT) AS x, DATE'2024-01-02' AS date")
    with pytest.raises(Exception, match="no"):
        tables.replace_days([_days(spark, {1: 11}), bad], path, "date")
    assert sorted({r["x"] for r in tables.read(spark, path).collect()}) == [10, 20, 30]
    assert tables.day_bytes(spark, path, "date") == sizes
