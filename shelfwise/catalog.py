"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Each query derives the retail inputs from the benchmark tables in
``sf_dir`` (see :mod:`shelfwise.sources.tpch_retail`), runs the library code
on them and returns a comparison-friendly projection: structs flattened,
doubles rounded to six decimals (sums of doubles depend on order), integer
sums as bigint. The SQL twins live in :mod:`shelfwise.oracle`.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise import jobs, schemas
from shelfwise.operators import dims, performance, status
from shelfwise.plans import best_sellers, inventory, popularity, pricing
from shelfwise.session import ensure_checkpoint_dir
from shelfwise.sources import tables, tpch_retail
from shelfwise.sources.readers import InputPaths, read_or_empty, read_table, restrict_days

DIGITS = 6


def rounded(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Round every double and decimal column (decimals become doubles)."""
    cols = []
    for field in df.schema.fields:
        if isinstance(field.dataType, (T.DoubleType, T.FloatType, T.DecimalType)):
            cols.append(F.round(F.col(field.name).cast("double"), digits).alias(field.name))
        else:
            cols.append(F.col(field.name))
    return df.select(cols)


def _inputs(spark: SparkSession, sf_dir: str):
    return tpch_retail.derive_inputs(spark, sf_dir)


def q_dim_geo(spark, sf_dir):
    return dims.geo_countries(tpch_retail.geo_targets(spark, sf_dir))


def q_dim_language(spark, sf_dir):
    return dims.language_codes(tpch_retail.language_codes(spark, sf_dir))


def q_perf_daily(spark, sf_dir):
    i = _inputs(spark, sf_dir)
    return rounded(performance.daily_performance(i.shopping_product_stats, i.geo_targets,
                                                 i.language_codes))


def q_perf_rolling(spark, sf_dir):
    i = _inputs(spark, sf_dir)
    daily = performance.daily_performance(i.shopping_product_stats, i.geo_targets,
                                          i.language_codes)
    return rounded(performance.rolling_performance(daily).drop("offer_key"))


def q_product_country_status(spark, sf_dir):
    return status.product_country_status(tpch_retail.products(spark, sf_dir))


def flatten_inventory(view: DataFrame) -> DataFrame:
    attrs = "additional_product_attributes"
    cols = []
    for c in view.columns:
        if c != attrs:
            cols.append(F.col(c))
            continue
        cols += [F.col(f"{attrs}.image_link").alias("image_link"),
                 F.col(f"{attrs}.color").alias("color"),
                 *[F.col(f"{attrs}.custom_labels.label_{k}").alias(f"label_{k}") for k in range(5)],
                 F.col(f"{attrs}.condition").alias("condition"),
                 F.col(f"{attrs}.gender").alias("gender")]
    return view.select(cols)


def q_inventory_view(spark, sf_dir):
    return rounded(flatten_inventory(_inventory(spark, sf_dir)))


def q_best_sellers_view(spark, sf_dir):
    return rounded(_best_sellers(spark, sf_dir))


_ROLLING: dict = {}


def _rolling(inputs):
    """The rolling-performance plan of one inputs object, built once (a lazy
    plan: each query still executes it)."""
    key = id(inputs)
    if key not in _ROLLING:
        _ROLLING[key] = (inputs, inventory.rolling_for_join(inputs))
    return _ROLLING[key][1]


def _inventory(spark, sf_dir):
    i = _inputs(spark, sf_dir)
    return inventory.inventory_view(i, _rolling(i))


def _inventory_rows(spark, sf_dir):
    """For the marts, none of which depends on repeated rows."""
    i = _inputs(spark, sf_dir)
    return inventory.inventory_rows(i, _rolling(i))


def _best_sellers(spark, sf_dir):
    i = _inputs(spark, sf_dir)
    return best_sellers.best_sellers_view(i, _rolling(i))


def _best_sellers_rows(spark, sf_dir):
    i = _inputs(spark, sf_dir)
    return best_sellers.best_sellers_rows(i, _rolling(i))


def q_price_benchmark(spark, sf_dir):
    return rounded(pricing.price_benchmark(_inventory_rows(spark, sf_dir)))


def q_price_benchmark_summary(spark, sf_dir):
    return rounded(pricing.price_benchmark_summary(_inventory_rows(spark, sf_dir)))


def q_benchmark_breakdown(spark, sf_dir):
    return rounded(pricing.benchmark_breakdown(_inventory_rows(spark, sf_dir)))


def q_benchmark_drill(spark, sf_dir):
    return rounded(pricing.benchmark_drill(_inventory_rows(spark, sf_dir)))


def q_price_benchmark_disapproved(spark, sf_dir):
    return rounded(pricing.price_benchmark(_inventory_rows(spark, sf_dir), disapproved_only=True))


def q_price_suggestion_disapproved(spark, sf_dir):
    return rounded(pricing.price_suggestion(_inventory_rows(spark, sf_dir), disapproved_only=True,
                                            ranked=True))


def q_focus_brands(spark, sf_dir):
    return rounded(pricing.focus_brands(_inventory_rows(spark, sf_dir), ranked=True))


def q_reactivation_list(spark, sf_dir):
    return rounded(pricing.reactivation_list(_inventory_rows(spark, sf_dir), ranked=True))


def q_price_suggestion(spark, sf_dir):
    return rounded(pricing.price_suggestion(_inventory_rows(spark, sf_dir), ranked=True))


def q_best_sellers_overview(spark, sf_dir):
    return rounded(popularity.best_sellers_overview(_best_sellers_rows(spark, sf_dir)))


def q_best_sellers_details(spark, sf_dir):
    return rounded(popularity.best_sellers_details(_best_sellers_rows(spark, sf_dir)))


def q_restock_list(spark, sf_dir):
    return rounded(popularity.restock_list(_best_sellers_rows(spark, sf_dir), ranked=True))


def q_cluster_gtins(spark, sf_dir):
    return popularity.cluster_gtins(_best_sellers_rows(spark, sf_dir))


INCREMENTAL_DAYS = 7


def q_incremental_inventory(spark, sf_dir):
    """Incremental rebuild of the last seven snapshot days (reading only the
    ad days they need); equals the full view's rows of those days."""
    i = _inputs(spark, sf_dir)
    end = tpch_retail.last_snapshot_day(spark, sf_dir)
    start = end - dt.timedelta(days=INCREMENTAL_DAYS - 1)
    return rounded(flatten_inventory(jobs.incremental_inventory_view(i, start, end)))


# ------------------------------------------------- through the written tables

_WRITTEN: dict = {}

# Of the price tables, whose rows are narrow: a writer sorts them by day.
ROWS_PER_WRITER = 2_000_000


def _written(spark, sf_dir):
    """Where the daily job keeps its tables after a history of deliveries, once per session
    and folder: the derived inputs are delivered as day tables, first without one ad day and
    with the last product day of one merchant only; both views are built; what was missing is
    delivered (a window with timestamps for days, a snapshot); and the days that this reaches
    are built again. Everything is read and written by the library's own scans and sinks.
    """
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key not in _WRITTEN:
        _WRITTEN[key] = _deliver_and_build(spark, sf_dir)
    return _WRITTEN[key]


def _deliver_and_build(spark, sf_dir):
    i = _inputs(spark, sf_dir)
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/daily-{uuid.uuid4().hex}"
    paths = InputPaths(f"{root}/in", merchant_id="42", ads_customer_id="7")
    last = tpch_retail.last_snapshot_day(spark, sf_dir)
    ads, products = i.shopping_product_stats, i.products
    late = ads.where(F.col("data_date") < F.lit(last - dt.timedelta(days=8))).agg(F.max("data_date")).first()[0] or last
    span = (last - dt.timedelta(days=3650), last)

    def deliver(df, name, column="partition_date"):
        jobs.backfill(lambda start, end: restrict_days(df, start, end, column), paths.path(name),
                      last + dt.timedelta(days=1), days=(span[1] - span[0]).days + 1, partition_column=column)

    deliver(ads.where(F.col("data_date") != F.lit(late)), "shopping_product_stats", "data_date")
    deliver(products.where((F.col("partition_date") != F.lit(last)) | (F.col("merchant_id") == 0)), "products")
    deliver(i.best_sellers_clusters, "best_sellers_product_cluster_weekly")
    deliver(i.best_sellers_mapping, "best_sellers_entity_product_mapping")
    # As another program delivers them: each writer leaves a file a day, so there are not many of them.
    writers = max(spark.sparkContext.defaultParallelism, tpch_retail.snapshot_rows(spark, sf_dir) // ROWS_PER_WRITER)
    for name, df in (("price_competitiveness", i.price_competitiveness), ("price_insights", i.price_insights)):
        df.coalesce(writers).write.partitionBy("partition_date").parquet(paths.path(name))
    # The headers of the two published lists.
    geo = i.geo_targets.withColumnsRenamed({"criterion_id": "Criteria ID", "name": "Name", "parent_id": "Parent ID",
                                            "country_code": "Country Code", "target_type": "Target Type"})
    for name, df in (("geo_targets", geo), ("language_codes", i.language_codes)):
        df.write.option("header", True).csv(f"{root}/{name}.csv")
        jobs.load_dimension(spark, f"{root}/{name}.csv", paths.path(name), name)

    cfg = jobs.DailyConfig(inputs=paths, output_root=f"{root}/out")
    jobs.run_daily(spark, cfg)
    jobs.refresh_window(
        lambda start, end: restrict_days(ads, start, end, "data_date").withColumn(
            "data_date", F.col("data_date").cast("timestamp") + F.expr("INTERVAL 13 HOURS")),
        paths.path("shopping_product_stats"), late, window_days=0, partition_column="data_date")
    jobs.ingest_snapshot(products.where(F.col("partition_date") == F.lit(last)).drop("partition_date"),
                         paths.path("products"), last)
    jobs.run_changed(spark, cfg)
    return cfg


def q_written_inventory_view(spark, sf_dir):
    cfg = _written(spark, sf_dir)
    view = tables.read(spark, f"{cfg.output_root}/{jobs.INVENTORY_TABLE}")
    return rounded(flatten_inventory(view.select(*schemas.INVENTORY_VIEW_COLUMNS)))


def q_written_best_sellers_view(spark, sf_dir):
    cfg = _written(spark, sf_dir)
    return rounded(tables.read(spark, f"{cfg.output_root}/{jobs.BEST_SELLERS_TABLE}").select(*schemas.BEST_SELLERS_VIEW_COLUMNS))


def q_written_performance(spark, sf_dir):
    """The shared rolling performance as the job keeps it for the product join."""
    cfg = _written(spark, sf_dir)
    view = tables.read(spark, f"{cfg.output_root}/{jobs.PERFORMANCE_TABLE}")
    return rounded(view.select(*performance.SNAPSHOT_JOIN_KEYS, *schemas.ROLLING_METRICS)).distinct()


def q_written_dimensions(spark, sf_dir):
    """Both dimensions as loaded from their CSV files."""
    cfg = _written(spark, sf_dir)
    geo = read_table(spark, cfg.inputs.path("geo_targets"), schemas.GEO_TARGETS)
    lang = read_table(spark, cfg.inputs.path("language_codes"), schemas.LANGUAGE_CODES)
    return geo.select(F.lit("location").alias("kind"), F.col("parent_id").alias("id"), F.col("country_code").alias("code")).unionByName(
        lang.select(F.lit("language").alias("kind"), F.col("criterion_id").cast("bigint").alias("id"), F.col("language_code").alias("code")))


def q_undelivered_best_sellers(spark, sf_dir):
    """The overview while the entity mapping has not been delivered yet: an absent table reads
    as empty, and no cluster has a product."""
    i = _inputs(spark, sf_dir)
    nowhere = f"{ensure_checkpoint_dir(spark).rstrip('/')}/never-delivered"
    mapping = read_or_empty(spark, f"{nowhere}/mapping", schemas.BEST_SELLERS_MAPPING)
    view = best_sellers.best_sellers_rows(replace(i, best_sellers_mapping=mapping), _rolling(i))
    return rounded(popularity.best_sellers_overview(view))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "dim_geo": q_dim_geo,
    "dim_language": q_dim_language,
    "perf_daily": q_perf_daily,
    "perf_rolling": q_perf_rolling,
    "product_country_status": q_product_country_status,
    "inventory_view": q_inventory_view,
    "best_sellers_view": q_best_sellers_view,
    "price_benchmark": q_price_benchmark,
    "price_benchmark_disapproved": q_price_benchmark_disapproved,
    "price_benchmark_summary": q_price_benchmark_summary,
    "benchmark_breakdown": q_benchmark_breakdown,
    "benchmark_drill": q_benchmark_drill,
    "focus_brands": q_focus_brands,
    "reactivation_list": q_reactivation_list,
    "price_suggestion": q_price_suggestion,
    "price_suggestion_disapproved": q_price_suggestion_disapproved,
    "best_sellers_overview": q_best_sellers_overview,
    "best_sellers_details": q_best_sellers_details,
    "restock_list": q_restock_list,
    "cluster_gtins": q_cluster_gtins,
    "incremental_inventory": q_incremental_inventory,
    "written_inventory_view": q_written_inventory_view,
    "written_best_sellers_view": q_written_best_sellers_view,
    "written_performance": q_written_performance,
    "written_dimensions": q_written_dimensions,
    "undelivered_best_sellers": q_undelivered_best_sellers,
}
