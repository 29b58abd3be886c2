"""Tables whose days are replaced in one switch (SK1, SK2, SK5-SK7), the schema check over all
days (SC1-SC6), and rebuilding just the days that a change reaches (SK4, SK6)."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from conftest import D, benchmark, destination, frame, inputs, insight, product, rows, stat
from py4j.protocol import Py4JJavaError
from pyspark.sql import functions as F

from shelfwise import jobs, schemas
from shelfwise.sources import readers, tables


def _days(spark, values, rows_a_day=3):
    """Rows (x, date): the value of each day, several times."""
    data = [(v, D(2024, 1, d)) for d, v in values.items() for _ in range(rows_a_day)]
    return spark.createDataFrame(data, "x int, date date")


def _content(df):
    return {r["date"].day: (r["x"], r["n"]) for r in df.groupBy("date", "x").agg(F.count("*").alias("n")).collect()}


def test_a_write_that_stops_before_the_switch_leaves_the_old_table(spark, tmp_dir, monkeypatch):
    path = os.path.join(tmp_dir, "t")
    jobs.write_partitioned(_days(spark, {1: 10, 2: 20}), path)
    monkeypatch.setattr(tables, "_commit", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt))
    with pytest.raises(KeyboardInterrupt):
        jobs.write_partitioned(_days(spark, {1: 11, 2: 21, 3: 31}), path)
    assert _content(tables.read(spark, path)) == {1: (10, 3), 2: (20, 3)}
    monkeypatch.undo()
    tables.clean(spark, path)
    assert _content(spark.read.parquet(path)) == {1: (10, 3), 2: (20, 3)}
    jobs.write_partitioned(_days(spark, {2: 22}), path, replace_all=False)
    assert _content(tables.read(spark, path)) == {1: (10, 3), 2: (22, 3)}


@pytest.mark.parametrize("stop_at", [0, 1, 2])
def test_a_write_that_stops_between_two_days_leaves_the_new_table(spark, tmp_dir, monkeypatch, stop_at):
    """After the switch old files go day by day; readers see the new table at any point of it."""
    path = os.path.join(tmp_dir, "t")
    jobs.write_partitioned(_days(spark, {1: 10, 2: 20, 3: 30}), path)
    seen, listed = [], tables.Folder.data_files

    def stops(folder, name):
        if len(seen) == stop_at:
            raise OSError("lost")
        seen.append(name)
        return listed(folder, name)

    monkeypatch.setattr(tables.Folder, "data_files", stops)
    with pytest.raises(OSError, match="lost"):
        jobs.write_partitioned(_days(spark, {1: 11, 2: 21}), path)
    monkeypatch.undo()
    assert _content(tables.read(spark, path)) == {1: (11, 3), 2: (21, 3)}
    tables.clean(spark, path)
    assert _content(spark.read.parquet(path)) == {1: (11, 3), 2: (21, 3)}


def test_a_manifest_that_was_cut_off_counts_for_nothing(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    jobs.write_partitioned(_days(spark, {1: 10}), path)
    with open(os.path.join(path, "_manifests", "00000002.json"), "w") as f:
        f.write('{"number": 2, "colu')
    assert _content(tables.read(spark, path)) == {1: (10, 3)}
    jobs.write_partitioned(_days(spark, {1: 12}), path)
    assert _content(tables.read(spark, path)) == {1: (12, 3)}
    assert tables.manifest(spark, path).number == 3


def test_the_second_of_two_writers_fails(spark, tmp_dir, monkeypatch):
    path = os.path.join(tmp_dir, "t")
    jobs.write_partitioned(_days(spark, {1: 10}), path)
    monkeypatch.setattr(tables.Folder, "manifest_numbers", lambda folder: [])  # it does not see the other
    monkeypatch.setattr(tables, "manifest", lambda *a: tables.Manifest(0, "date"))
    with pytest.raises(RuntimeError, match="another writer"):
        jobs.write_partitioned(_days(spark, {1: 11}), path)
    monkeypatch.undo()
    assert _content(tables.read(spark, path)) == {1: (10, 3)}


def test_a_reader_of_a_superseded_manifest_reads_the_new_table(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    jobs.write_partitioned(_days(spark, {1: 10, 2: 20}), path)
    old = tables.manifest(spark, path)
    jobs.write_partitioned(_days(spark, {1: 11}), path, replace_all=False)
    assert _content(tables.read_days(spark, path, old)) == {1: (11, 3), 2: (20, 3)}


def test_missing_files_are_an_error(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    jobs.write_partitioned(_days(spark, {1: 10, 2: 20}), path)
    for name in os.listdir(os.path.join(path, "date=2024-01-02")):
        os.remove(os.path.join(path, "date=2024-01-02", name))
    with pytest.raises((RuntimeError, Py4JJavaError, Exception), match="missing|PATH_NOT_FOUND"):
        tables.read(spark, path)


def test_a_plain_folder_becomes_a_table(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    _days(spark, {1: 10, 2: 20}).write.partitionBy("date").parquet(path)
    assert tables.manifest(spark, path) is None and tables.has_days(spark, path)
    jobs.write_partitioned(_days(spark, {2: 21, 3: 31}), path, replace_all=False)
    assert _content(tables.read(spark, path)) == {1: (10, 3), 2: (21, 3), 3: (31, 3)}
    assert _content(spark.read.parquet(path)) == {1: (10, 3), 2: (21, 3), 3: (31, 3)}


def test_one_bound_is_enough_to_drop_days(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    jobs.write_partitioned(_days(spark, {1: 10, 2: 20, 3: 30}), path)
    jobs.write_partitioned(_days(spark, {2: 21}), path, replace_all=False, start=D(2024, 1, 2))
    assert _content(tables.read(spark, path)) == {1: (10, 3), 2: (21, 3)}
    jobs.write_partitioned(_days(spark, {}), path, replace_all=False, end=D(2024, 1, 1))
    assert _content(tables.read(spark, path)) == {2: (21, 3)}


def test_rows_without_a_day(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    df = spark.createDataFrame([(1, None), (2, D(2024, 1, 1))], "x int, date date")
    jobs.write_partitioned(df, path)
    assert rows(tables.read(spark, path), "x") == [(1,), (2,)]
    assert rows(readers.read_table(spark, path, df.schema, "2024-01-01", date_column="date"), "x") == [(2,)]


def _renamed(spark, day):
    return frame(spark, [product(day=day)], schemas.PRODUCTS).withColumnRenamed("product_id", "item")


@pytest.mark.parametrize("managed", [True, False])
@pytest.mark.parametrize("wrong", [1, 2, 3])
def test_a_column_renamed_on_one_day_raises(spark, tmp_dir, managed, wrong):
    path = os.path.join(tmp_dir, "products")
    for d in (1, 2, 3):
        day = D(2024, 1, d)
        df = _renamed(spark, day) if d == wrong else frame(spark, [product(day=day)], schemas.PRODUCTS)
        if managed:
            jobs.write_partitioned(df, path, replace_all=False, partition_column="partition_date")
        else:
            df.write.mode("append").partitionBy("partition_date").parquet(path)
    with pytest.raises(ValueError, match="product_id is missing"):
        readers.read_table(spark, path, schemas.PRODUCTS)
    others = [d for d in (1, 2, 3) if d != wrong]
    for d in others:  # days outside the range are not looked at
        got = readers.read_table(spark, path, schemas.PRODUCTS, D(2024, 1, d), D(2024, 1, d))
        assert rows(got, "partition_date") == [(D(2024, 1, d),)]


def test_a_mistyped_day_raises_also_beside_unmanaged_ones(spark, tmp_dir):
    path = os.path.join(tmp_dir, "mapping")
    good = frame(spark, [{"partition_date": D(2024, 1, 1), "entity_id": "e", "product_id": "p"}], schemas.BEST_SELLERS_MAPPING)
    bad = good.select(F.lit(D(2024, 1, 2)).alias("partition_date"), "entity_id", F.lit(5).alias("product_id"))
    bad.write.partitionBy("partition_date").parquet(path)
    jobs.write_partitioned(good, path, replace_all=False, partition_column="partition_date")
    with pytest.raises(ValueError, match="2024-01-02: product_id is int"):
        readers.read_table(spark, path, schemas.BEST_SELLERS_MAPPING)


# ------------------------------------------------------- what a change affects

FIRST, DAYS = D(2024, 1, 1), 40


def _day(k):
    return FIRST + dt.timedelta(days=k)


@pytest.fixture()
def config(spark, tmp_dir):
    """Forty snapshot days, ad statistics of most days before them, and clusters weekly."""
    root = os.path.join(tmp_dir, "in")
    snaps = [_day(k) for k in range(DAYS)]
    clusters = [{"partition_date": d, "country_code": "US", "report_category_id": 1, "entity_id": "e", "rank": k,
                 "relative_demand": "HIGH", "product_inventory_status": "IN_STOCK"} for k, d in enumerate(snaps) if k % 7 == 0]
    i = inputs(
        spark, products=[product(day=d, pid=f"p{k}", offer=f"Sku{k}") for d in snaps for k in (1, 2)],
        stats=[stat(_day(k - 1), item=f"SKU{n}", clicks=k + n) for k in range(DAYS) for n in (1, 2) if k % 5 or n == 1],
        pc=[benchmark(d, "p1", "US", 9_000_000) for d in snaps], pi=[insight(d, "p2", 8_000_000) for d in snaps],
        clusters=clusters, mapping=[{"partition_date": c["partition_date"], "entity_id": "e", "product_id": "p1"} for c in clusters])
    paths = readers.InputPaths(root)
    for name, df, column in [
            ("products", i.products, "partition_date"), ("price_competitiveness", i.price_competitiveness, "partition_date"),
            ("price_insights", i.price_insights, "partition_date"), ("shopping_product_stats", i.shopping_product_stats, "data_date"),
            ("best_sellers_product_cluster_weekly", i.best_sellers_clusters, "partition_date"),
            ("best_sellers_entity_product_mapping", i.best_sellers_mapping, "partition_date")]:
        jobs.write_partitioned(df, paths.path(name), partition_column=column)
    for name, df in [("geo_targets", i.geo_targets), ("language_codes", i.language_codes)]:
        df.write.parquet(paths.path(name))
    return jobs.DailyConfig(inputs=paths, output_root=os.path.join(tmp_dir, "out"))


def _tables(spark, cfg):
    return {t: sorted(map(str, tables.read(spark, f"{cfg.output_root}/{t}").collect())) for t in jobs.VIEWS}


def _full(spark, cfg, tmp_dir, name):
    """A full rebuild elsewhere."""
    other = jobs.DailyConfig(inputs=cfg.inputs, output_root=os.path.join(tmp_dir, name))
    jobs.run_daily(spark, other)
    return _tables(spark, other)


def test_a_change_reaches_just_its_days(spark, tmp_dir, config):
    first = jobs.run_changed(spark, config)
    assert len(first[jobs.INVENTORY_TABLE]) == DAYS and len(first[jobs.BEST_SELLERS_TABLE]) == 6
    assert _tables(spark, config) == _full(spark, config, tmp_dir, "full1")
    assert not any(jobs.run_changed(spark, config).values())

    # one ad day: the snapshots of the 31 days after it (the last two are beyond the table)
    late = frame(spark, [stat(_day(10), item="SKU1", clicks=500)], schemas.SHOPPING_PRODUCT_STATS)
    jobs.refresh_window(lambda a, b: late, config.inputs.path("shopping_product_stats"), _day(10), 0, "data_date")
    assert jobs.changed_days(spark, config)[jobs.INVENTORY_TABLE] == [_day(k) for k in range(11, DAYS)]
    before = tables.manifest(spark, f"{config.output_root}/{jobs.INVENTORY_TABLE}").days
    got = jobs.run_changed(spark, config)
    assert got[jobs.INVENTORY_TABLE] == [_day(k) for k in range(11, 40)]
    assert got[jobs.BEST_SELLERS_TABLE] == [_day(k) for k in (14, 21, 28, 35)]
    after = tables.manifest(spark, f"{config.output_root}/{jobs.INVENTORY_TABLE}").days
    assert {d for d in after if after[d] != before[d]} == {_day(k).isoformat() for k in range(11, 40)}
    assert _tables(spark, config) == _full(spark, config, tmp_dir, "full2")

    # one product day, a benchmark day and a day that is gone, not neighbours
    jobs.ingest_snapshot(frame(spark, [product(pid="p1", offer="Sku1", destinations=[destination(approved=["DE"])])],
                               schemas.PRODUCTS).drop("partition_date"), config.inputs.path("products"), _day(20))
    jobs.ingest_snapshot(frame(spark, [benchmark(_day(3), "p1", "US", 1_000_000)], schemas.PRICE_COMPETITIVENESS)
                         .drop("partition_date"), config.inputs.path("price_competitiveness"), _day(3))
    jobs.ingest_snapshot(frame(spark, [], schemas.PRODUCTS).drop("partition_date"), config.inputs.path("products"), _day(35))
    got = jobs.run_changed(spark, config)
    assert got[jobs.INVENTORY_TABLE] == [_day(k) for k in (3, 20, 35)]
    assert got[jobs.BEST_SELLERS_TABLE] == [_day(35)] and not got[jobs.PERFORMANCE_TABLE]
    assert _tables(spark, config) == _full(spark, config, tmp_dir, "full3")


def test_a_job_that_stopped_goes_on_with_what_is_left(spark, tmp_dir, config, monkeypatch):
    views = dict(jobs.VIEWS)
    monkeypatch.setitem(jobs.VIEWS, jobs.BEST_SELLERS_TABLE, lambda *a: (_ for _ in ()).throw(KeyboardInterrupt))
    with pytest.raises(KeyboardInterrupt):
        jobs.run_daily(spark, config)
    built = []
    for table, view in views.items():
        monkeypatch.setitem(jobs.VIEWS, table, lambda *a, t=table, v=view: (built.append(t), v(*a))[1])
    got = jobs.run_changed(spark, config)
    assert built == [jobs.BEST_SELLERS_TABLE] and not got[jobs.INVENTORY_TABLE] and not got[jobs.PERFORMANCE_TABLE]
    monkeypatch.undo()
    assert _tables(spark, config) == _full(spark, config, tmp_dir, "full")


def test_a_run_of_some_days_keeps_the_other_days_and_their_performance(spark, tmp_dir, config):
    jobs.run_daily(spark, config)
    before = {t: sorted(map(str, tables.read(spark, f"{config.output_root}/{t}").collect()))
              for t in (*jobs.VIEWS, jobs.PERFORMANCE_TABLE)}
    for start, end in [(_day(30), None), (None, _day(5)), (_day(12), _day(13))]:
        jobs.run_daily(spark, jobs.DailyConfig(config.inputs, config.output_root, start, end))
        assert before == {t: sorted(map(str, tables.read(spark, f"{config.output_root}/{t}").collect())) for t in before}
    assert not any(jobs.run_changed(spark, config).values())


def test_a_dimension_reaches_all_days_and_a_range_bounds_them(spark, config):
    jobs.run_changed(spark, config)
    geo = [{"criterion_id": 1, "name": "US", "parent_id": 2840, "country_code": "DE", "target_type": "Country"}]
    frame(spark, geo, schemas.GEO_TARGETS).write.mode("overwrite").parquet(config.inputs.path("geo_targets"))
    assert len(jobs.changed_days(spark, config)[jobs.INVENTORY_TABLE]) == DAYS
    some = jobs.DailyConfig(config.inputs, config.output_root, _day(5), _day(6))
    assert jobs.run_changed(spark, some)[jobs.INVENTORY_TABLE] == [_day(5), _day(6)]
    assert len(jobs.changed_days(spark, config)[jobs.INVENTORY_TABLE]) == DAYS - 2


def test_inputs_that_others_write_are_told_apart_by_their_files(spark, tmp_dir):
    root = os.path.join(tmp_dir, "in")
    paths = readers.InputPaths(root)
    i = inputs(spark, products=[product(day=_day(k), pid="a") for k in (1, 2)], stats=[stat(_day(0), clicks=2)])
    for name, df in [("products", i.products), ("price_competitiveness", i.price_competitiveness),
                     ("price_insights", i.price_insights)]:
        df.write.partitionBy("partition_date").parquet(paths.path(name))
    i.shopping_product_stats.write.partitionBy("data_date").parquet(paths.path("shopping_product_stats"))
    for name, df in [("geo_targets", i.geo_targets), ("language_codes", i.language_codes)]:
        df.write.parquet(paths.path(name))
    cfg = jobs.DailyConfig(inputs=paths, output_root=os.path.join(tmp_dir, "out"))
    assert jobs.run_changed(spark, cfg)[jobs.INVENTORY_TABLE] == [_day(1), _day(2)]
    frame(spark, [product(day=_day(2), pid="b")], schemas.PRODUCTS).write.mode("append").partitionBy(
        "partition_date").parquet(paths.path("products"))
    assert jobs.run_changed(spark, cfg)[jobs.INVENTORY_TABLE] == [_day(2)]
    got = tables.read(spark, f"{cfg.output_root}/{jobs.INVENTORY_TABLE}")
    assert rows(got, "date", "product_id") == [(_day(1), "a"), (_day(2), "a"), (_day(2), "b")]


def test_inputs_without_days_are_refused(spark, tmp_dir):
    path = os.path.join(tmp_dir, "in", "products")
    frame(spark, [product()], schemas.PRODUCTS).write.parquet(path)
    with pytest.raises(ValueError, match="has no days"):
        jobs.run_changed(spark, jobs.DailyConfig(readers.InputPaths(os.path.join(tmp_dir, "in")), tmp_dir))


def test_marts_take_the_newest_day_by_default(spark, tmp_dir, config):
    jobs.run_changed(spark, config)
    jobs.build_marts(spark, config.output_root)
    marts = os.path.join(config.output_root, "marts")
    assert sorted(os.listdir(marts)) == sorted({n for of in jobs.MARTS.values() for n in of})
    got = tables.read(spark, f"{marts}/price_benchmark")
    assert rows(got, "date") == [(_day(39),)]
    assert rows(tables.read(spark, f"{marts}/best_sellers_details"), "date") == [(_day(35),)]
    jobs.build_marts(spark, config.output_root, _day(10).isoformat())
    assert rows(tables.read(spark, f"{marts}/price_benchmark"), "date") == [(_day(10),), (_day(39),)]
    jobs.build_marts(spark, config.output_root, None)
    assert tables.read(spark, f"{marts}/price_benchmark").select("date").distinct().count() == DAYS


def test_a_write_leaves_no_shuffle_files(spark, tmp_dir):
    """A write's shuffle files go when it ends, not when the driver collects garbage."""
    import glob
    import time

    dirs = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()

    def files():
        return {f for d in dirs for f in glob.glob(f"{d.getPath()}/*/shuffle_*")}

    seen, setting = files(), spark.conf.get(tables.DROP_SHUFFLES, None)
    df = spark.range(1000).selectExpr("id", "date_add(date'2024-01-01', cast(id % 3 as int)) AS date").repartition(4, "id")
    tables.replace_days(df, f"{tmp_dir}/t", "date")
    until = time.time() + 10
    while (left := files() - seen) and time.time() < until:
        time.sleep(0.2)
    assert not left
    assert spark.conf.get(tables.DROP_SHUFFLES, None) == setting
    assert tables.read(spark, f"{tmp_dir}/t").count() == 1000
