"""Sources and sinks: readers, empty fallback, partitioned writes, snapshot
ingestion, refresh window, backfill, daily job and incremental rebuild."""

from __future__ import annotations

import datetime as dt
import os

import pytest

from conftest import SF_SMALL, D, benchmark, frame, inputs, product, rows, stat

from shelfwise import jobs, schemas
from shelfwise.plans import inventory
from shelfwise.sources import readers, tpch_retail


def test_read_or_empty_and_day_range(spark, tmp_dir):
    missing = readers.read_or_empty(spark, os.path.join(tmp_dir, "nope"), schemas.BEST_SELLERS_MAPPING)
    assert missing.count() == 0 and missing.schema == schemas.BEST_SELLERS_MAPPING
    path = os.path.join(tmp_dir, "mapping")
    df = frame(spark, [{"partition_date": D(2024, 1, d), "entity_id": "e", "product_id": "p"}
                       for d in (1, 2, 3)], schemas.BEST_SELLERS_MAPPING)
    jobs.write_partitioned(df, path, partition_column="partition_date")
    got = readers.read_table(spark, path, schemas.BEST_SELLERS_MAPPING, "2024-01-02", "2024-01-02")
    assert rows(got, "partition_date") == [(D(2024, 1, 2),)]


def test_csv_dimensions(spark, tmp_dir):
    lang = os.path.join(tmp_dir, "lang.csv")
    with open(lang, "w") as f:
        f.write("language_name,language_code,criterion_id\nEnglish,en,1000\nEnglish UK,en,1000\n"
                "German,de,1001\n")
    geo = os.path.join(tmp_dir, "geo.csv")
    with open(geo, "w") as f:
        f.write("Criteria ID,Name,Canonical Name,Parent ID,Country Code,Target Type,Status\n"
                "1,A,A,2840,US,City,Active\n2,B,B,2840,US,City,Active\n")
    assert readers.load_language_codes(spark, lang).count() == 3
    g = readers.load_geo_targets(spark, geo)
    assert rows(g.select("parent_id", "country_code").distinct(), "parent_id", "country_code") == [
        (2840, "US")]


def test_ingest_refresh_and_backfill(spark, tmp_dir):
    path = os.path.join(tmp_dir, "products")

    def export(start, end):
        days = [start + dt.timedelta(days=k) for k in range((end - start).days + 1)]
        return frame(spark, [product(day=d, pid=f"{d}") for d in days], schemas.PRODUCTS)

    jobs.backfill(export, path, "2024-01-11", days=5)          # Jan 6 .. Jan 10
    got = readers.read_table(spark, path, schemas.PRODUCTS)
    assert sorted({r["partition_date"] for r in got.collect()}) == [D(2024, 1, d) for d in range(6, 11)]
    day = frame(spark, [product(pid="new1"), product(pid="new2")], schemas.PRODUCTS).drop("partition_date")
    jobs.ingest_snapshot(day, path, "2024-01-10")
    got = readers.read_table(spark, path, schemas.PRODUCTS, "2024-01-10", "2024-01-10")
    assert rows(got, "product_id") == [("new1",), ("new2",)]
    jobs.refresh_window(export, path, "2024-01-11", window_days=1)   # Jan 10 and Jan 11
    got = readers.read_table(spark, path, schemas.PRODUCTS)
    assert got.count() == 6
    assert rows(got.where("partition_date = '2024-01-10'"), "product_id") == [("2024-01-10",)]


def test_daily_job_rerun_is_idempotent(spark, tmp_dir):
    root = os.path.join(tmp_dir, "in")
    i = inputs(spark, products=[product(pid="a")], stats=[stat(D(2024, 1, 9), clicks=2)])
    for name, df in [("products", i.products), ("price_competitiveness", i.price_competitiveness),
                     ("price_insights", i.price_insights)]:
        jobs.write_partitioned(df, os.path.join(root, name), partition_column="partition_date")
    jobs.write_partitioned(i.shopping_product_stats, os.path.join(root, "shopping_product_stats"),
                           partition_column="data_date")
    for name, df in [("geo_targets", i.geo_targets), ("language_codes", i.language_codes)]:
        df.write.mode("overwrite").parquet(os.path.join(root, name))
    cfg = jobs.DailyConfig(inputs=readers.InputPaths(root), output_root=os.path.join(tmp_dir, "out"))
    jobs.run_daily(spark, cfg)
    out = os.path.join(tmp_dir, "out", jobs.INVENTORY_TABLE)
    first = sorted(spark.read.parquet(out).collect())
    jobs.run_daily(spark, cfg)
    assert sorted(spark.read.parquet(out).collect()) == first
    assert [r["clicks_30days"] for r in first] == [2]
    # no best-seller input was delivered: the table is written, and empty
    assert os.path.exists(os.path.join(tmp_dir, "out", jobs.BEST_SELLERS_TABLE, "_SUCCESS"))
    jobs.write_partitioned(  # a non-empty best-seller table, so both views register
        spark.read.parquet(out).select("date", "product_id"),
        os.path.join(tmp_dir, "out", jobs.BEST_SELLERS_TABLE))
    jobs.register_views(spark, os.path.join(tmp_dir, "out"))
    sql = spark.sql("SELECT count(*) AS n, max(clicks_30days) AS c FROM InventoryView").first()
    assert (sql["n"], sql["c"]) == (1, 2)


def test_incremental_equals_full_on_overlap(spark):
    i = tpch_retail.derive_inputs(spark, SF_SMALL)
    full = inventory.inventory_view(i)
    end = i.products.agg({"partition_date": "max"}).first()[0]
    start = end - dt.timedelta(days=9)
    inc = jobs.incremental_inventory_view(i, start, end)
    expected = full.where(f"date >= '{start}'")
    assert inc.count() == expected.count()
    assert inc.exceptAll(expected).count() == 0 and expected.exceptAll(inc).count() == 0


def test_load_dimension_replaces(spark, tmp_dir):
    csv = os.path.join(tmp_dir, "lang.csv")
    with open(csv, "w") as f:
        f.write("language_name,language_code,criterion_id\nEnglish,en,1000\n")
    table = os.path.join(tmp_dir, "language_codes")
    jobs.load_dimension(spark, csv, table, "language_codes")
    jobs.load_dimension(spark, csv, table, "language_codes")
    assert spark.read.parquet(table).count() == 1


def test_cli_arguments():
    from shelfwise.cli import parse_args

    cfg = parse_args(["--input-root", "/in", "--output-root", "/out", "--merchant-id", "42",
                      "--ads-customer-id", "123-456-7890", "--start", "2024-05-01"])
    assert cfg.inputs.path("products") == "/in/Products_42"
    assert cfg.inputs.path("shopping_product_stats") == "/in/ads_ShoppingProductStats_1234567890"
    assert (cfg.start, cfg.end, cfg.output_root) == ("2024-05-01", None, "/out")


def test_read_inputs_with_account_table_names(spark, tmp_dir):
    paths = readers.InputPaths(tmp_dir, merchant_id="42", ads_customer_id="7")
    days = [D(2024, 1, d) for d in (1, 2, 3)]
    products = frame(spark, [product(day=d, pid=str(d)) for d in days], schemas.PRODUCTS)
    jobs.write_partitioned(products, paths.path("products"), partition_column="partition_date")
    ads = frame(spark, [stat(d) for d in days], schemas.SHOPPING_PRODUCT_STATS)
    jobs.write_partitioned(ads, paths.path("shopping_product_stats"), partition_column="data_date")
    for name, schema in [("price_competitiveness", schemas.PRICE_COMPETITIVENESS),
                         ("price_insights", schemas.PRICE_INSIGHTS),
                         ("geo_targets", schemas.GEO_TARGETS),
                         ("language_codes", schemas.LANGUAGE_CODES)]:
        frame(spark, [], schema).write.mode("overwrite").parquet(paths.path(name))
    i = readers.read_inputs(spark, paths, start="2024-01-03", end="2024-01-03",
                            ads_start="2024-01-02")
    assert paths.path("products").endswith("Products_42")
    assert rows(i.products, "partition_date") == [(D(2024, 1, 3),)]
    assert rows(i.shopping_product_stats, "data_date") == [(D(2024, 1, 2),), (D(2024, 1, 3),)]
    assert i.best_sellers_clusters.count() == 0        # never delivered: empty fallback


def test_a_day_that_became_empty_goes(spark, tmp_dir):
    path = os.path.join(tmp_dir, "products")

    def export(days):
        return lambda start, end: frame(spark, [product(day=D(2024, 1, d)) for d in days], schemas.PRODUCTS)

    jobs.refresh_window(export((1, 2, 3)), path, "2024-01-03", window_days=2)
    jobs.refresh_window(export((2,)), path, "2024-01-02T10:00:00", window_days=1)
    got = readers.read_table(spark, path, schemas.PRODUCTS)
    assert rows(got, "partition_date") == [(D(2024, 1, 2),), (D(2024, 1, 3),)]


def test_a_failing_run_keeps_the_old_table(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    old = spark.sql("SELECT 1 AS x, DATE'2024-01-01' AS date")
    jobs.write_partitioned(old, path)
    bad = spark.sql("SELECT raise_error('no') AS x, DATE'2024-01-01' AS date")
    with pytest.raises(Exception):
        jobs.write_partitioned(bad, path)
    assert rows(spark.read.parquet(path), "x") == [(1,)]


def test_a_day_is_written_to_few_files(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    many = spark.range(2000).repartition(16).selectExpr("id", "date_add(DATE'2024-01-01', CAST(id % 3 AS INT)) AS date")
    jobs.write_partitioned(many, path)
    for day in (1, 2, 3):
        files = [f for f in os.listdir(os.path.join(path, f"date=2024-01-0{day}")) if f.endswith(".parquet")]
        assert len(files) == 1


def test_a_wrong_schema_raises(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    frame(spark, [product()], schemas.PRODUCTS).withColumnRenamed("product_id", "pid").write.parquet(path)
    with pytest.raises(ValueError, match="product_id is missing"):
        readers.read_table(spark, path, schemas.PRODUCTS)


def test_marts_are_built_from_the_written_views(spark, tmp_dir):
    view = inventory.inventory_view(inputs(spark, products=[product()], stats=[stat(D(2024, 1, 9))],
                                           pc=[benchmark(D(2024, 1, 10), "online:1", "US", 9_000_000)]))
    jobs.write_partitioned(view, os.path.join(tmp_dir, jobs.INVENTORY_TABLE))
    jobs.build_marts(spark, tmp_dir)
    built = spark.read.parquet(os.path.join(tmp_dir, "marts", "price_benchmark_summary"))
    assert built.count() == 1
