"""Derive the eight retail inputs from the benchmark tables of the checks.

The checks ship TPC-H-like tables (``part``, ``nation``, ``region``) and an
``events`` stream, not merchant data. This module maps them onto the retail
data model row by row, so every derived table grows with its source:

* ``events``  -> one ad-statistics row per event;
* ``part``    -> the product catalogue, one snapshot row per product and day
                 (the days are the ad days shifted by one, generated per row
                 with ``explode(sequence(..))``, no join);
* ``part``    -> price benchmark and price suggestion rows per snapshot row,
                 best-seller clusters (two countries per product, weekly) and
                 the entity -> product mapping;
* ``nation``  -> location dimension, ``region`` -> language dimension.

The modulus rules below only choose *values* (which product is disapproved,
which has no benchmark, ...) so that every NULL, fan-out and edge case of the
pipelines occurs in the data. No rule removes rows to make a query cheaper.
The same derivation is written in DuckDB SQL in :mod:`shelfwise.oracle`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise import schemas
from shelfwise.session import ROWS_PER_TASK, partitions_for
from shelfwise.sources.readers import RetailInputs, read_table

# Fixed values of the derivation (they must agree with the oracle SQL).
BASE_DAY = "2024-01-01"          # day 0 of the events calendar
LATEST_DAY = "2024-03-01"        # transfer-run day of the ad statistics
LATEST_DAY_RERUN = "2024-03-02"  # a second run for one event in seven
CURRENCY = "USD"
BENCHMARK_FACTORS = [0.90, 0.985, 0.99, 1.00, 1.01, 1.015, 1.10]  # by p_partkey % 7
DEMAND_LABELS = ["VERY_LOW", "LOW", "MEDIUM", "HIGH", "VERY_HIGH"]
INVENTORY_LABELS = ["IN_STOCK", "OUT_OF_STOCK", "NOT_IN_INVENTORY"]


def _base() -> Column:
    return F.lit(BASE_DAY).cast("date")


def _spread(d: Column) -> Column:
    """Spread 30 consecutive days over 50: 6 days on, 5 days off, so gaps of
    7, 8, 30 and 31 days occur between ad days."""
    return d + F.lit(5) * F.floor(d / F.lit(6)).cast("int")


def _event_day(ts: str = "ts") -> Column:
    return F.datediff(F.to_date(F.col(ts)), _base())


def _case(index: Column, values: list) -> Column:
    expr = None
    for i, v in enumerate(values):
        expr = F.when(index == i, F.lit(v)) if expr is None else expr.when(index == i, F.lit(v))
    return expr


def _micros(amount: Column) -> Column:
    return F.round(amount * F.lit(1e6)).cast("bigint")


def _gtin(p: Column) -> Column:
    return F.lpad(p.cast("string"), 13, "0")


# Schemas of the benchmark tables read here (given, so no scan-time inference).
SOURCE_SCHEMAS = {
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
            "p_retailprice double",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
              "value double, props string",
}


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    schema = T.StructType.fromDDL(SOURCE_SCHEMAS[name])
    return read_table(spark, f"{sf_dir.rstrip('/')}/{name}.parquet", schema)


def shopping_product_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _read(spark, sf_dir, "events")
    p_id = F.col("event_id")
    user = F.col("user_id")
    d = _event_day()
    item = (F.when(p_id % 97 == 0, F.lit(None).cast("string"))
            .when((user % 4 == 0) & (p_id % 2 == 0), F.concat(F.lit("sku"), user.cast("string")))
            .otherwise(F.concat(F.lit("SKU"), user.cast("string"))))
    country = (F.when(p_id % 89 == 0, F.lit("bad"))
               .otherwise(F.concat(F.lit("geoTargetConstants/"), (F.lit(2000) + user % 25).cast("string"))))
    purchase = F.col("event_type") == "purchase"
    return ev.select(
        F.date_add(_base(), _spread(d)).alias("data_date"),
        F.when(p_id % 7 == 0, F.lit(LATEST_DAY_RERUN)).otherwise(F.lit(LATEST_DAY))
        .cast("date").alias("latest_date"),
        (user % 2).cast("bigint").alias("segments_product_merchant_id"),
        F.when(p_id % 10 == 0, F.lit("LOCAL")).otherwise(F.lit("ONLINE"))
        .alias("segments_product_channel"),
        item.alias("segments_product_item_id"),
        country.alias("segments_product_country"),
        F.concat(F.lit("languageConstants/"), (F.lit(1000) + user % 5).cast("string"))
        .alias("segments_product_language"),
        F.lit(1).cast("bigint").alias("metrics_impressions"),
        (F.col("event_type") == "click").cast("bigint").alias("metrics_clicks"),
        _micros(F.col("value")).alias("metrics_cost_micros"),
        purchase.cast("double").alias("metrics_conversions"),
        F.when(purchase, F.col("value")).otherwise(F.lit(0.0)).alias("metrics_conversions_value"),
    )


def geo_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One location per nation, plus a second child location for even keys
    (so (parent, country) pairs repeat and the DISTINCT matters)."""
    nation = _read(spark, sf_dir, "nation")
    key = F.col("n_nationkey").cast("bigint")
    first = nation.select(
        (F.lit(10000) + key).alias("criterion_id"), F.col("n_name").alias("name"),
        (F.lit(2000) + key).alias("parent_id"), F.col("n_name").alias("country_code"),
        F.lit("Country").alias("target_type"))
    second = nation.where(key % 2 == 0).select(
        (F.lit(20000) + key).alias("criterion_id"),
        F.concat(F.col("n_name"), F.lit(" capital")).alias("name"),
        (F.lit(2000) + key).alias("parent_id"), F.col("n_name").alias("country_code"),
        F.lit("City").alias("target_type"))
    return first.unionByName(second)


def language_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One language per region; region 0 appears twice under two names."""
    region = _read(spark, sf_dir, "region")
    first = region.select(
        F.col("r_name").alias("language_name"), F.lower("r_name").alias("language_code"),
        (F.lit(1000) + F.col("r_regionkey")).cast("int").alias("criterion_id"))
    second = region.where(F.col("r_regionkey") == 0).select(
        F.concat(F.col("r_name"), F.lit(" (alt)")).alias("language_name"),
        F.lower("r_name").alias("language_code"),
        (F.lit(1000) + F.col("r_regionkey")).cast("int").alias("criterion_id"))
    return first.unionByName(second)


def _last_ad_day(spark: SparkSession, sf_dir: str) -> Column:
    """Scalar subquery: index of the last events day (planned once, no join)."""
    return _read(spark, sf_dir, "events").select(F.max(_event_day())).scalar()


def _dimension(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """``nation`` / ``region``: TPC-H fixes them at 25 and 5 rows for every
    scale factor, a proven bound, so they are broadcast."""
    assert name in ("nation", "region")
    return F.broadcast(_read(spark, sf_dir, name))


def last_snapshot_day(spark: SparkSession, sf_dir: str):
    """The newest product snapshot day (the day after the last ad day), from
    one aggregate over the events' timestamps."""
    d = F.max(_event_day())
    return (_read(spark, sf_dir, "events")
            .select(F.date_add(_base(), _spread(d) + F.lit(1)).alias("day")).first()["day"])


def _nation_names(spark: SparkSession, sf_dir: str, alias: str) -> DataFrame:
    return _dimension(spark, sf_dir, "nation").select(
        F.col("n_nationkey").cast("bigint").alias(f"{alias}_key"), F.col("n_name").alias(alias))


def _catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part rows, spread for the expansion into snapshot days.

    The part table is small next to the snapshot it expands into (one row per
    day), and may sit in a single file; its rows are spread first, so that the
    expansion runs on all cores and a task makes no more rows than it can hold
    while it deals them out. The count is explicit (adaptive coalescing would
    merge the small input back): the cluster's parallelism, the input's own split
    count or what the snapshot's rows need, whichever is largest.
    """
    part = _read(spark, sf_dir, "part")
    partitions = max(spark.sparkContext.defaultParallelism, part.rdd.getNumPartitions(),
                     -(-_tasks(spark, sf_dir) // 2))
    return part.repartition(partitions, "p_partkey")


_ROWS: dict = {}


def snapshot_rows(spark: SparkSession, sf_dir: str) -> int:
    """How many rows the catalogue has over all snapshot days, from the part table's row count
    and the last ad day; counted once per session and folder. Only used for sizes."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key not in _ROWS:
        last = _read(spark, sf_dir, "events").select(F.max(_event_day()).alias("d")).first()["d"]
        _ROWS[key] = _read(spark, sf_dir, "part").count() * (1 + (last or 0))
    return _ROWS[key]


def _tasks(spark: SparkSession, sf_dir: str) -> int:
    return -(-snapshot_rows(spark, sf_dir) // ROWS_PER_TASK)


def _on_days(rows: DataFrame, spark: SparkSession, sf_dir: str, step: int = 1) -> DataFrame:
    """``rows``, each repeated for the snapshot days (every ``step``-th), with the day's number
    ``d`` and its ``partition_date``. Values that do not depend on the day are best made in
    ``rows``, once for all days."""
    days = F.explode(F.sequence(F.lit(0), _last_ad_day(spark, sf_dir), F.lit(step)))
    return rows.select("*", days.alias("d")).withColumn(
        "partition_date", F.date_add(_base(), _spread(F.col("d")) + F.lit(1)))


def _catalog_days(spark: SparkSession, sf_dir: str, step: int = 1) -> DataFrame:
    return _on_days(_catalog(spark, sf_dir), spark, sf_dir, step)


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = F.col("p_partkey")
    region = _dimension(spark, sf_dir, "region").select(
        F.col("r_regionkey").cast("bigint").alias("lang_key"),
        F.lower("r_name").alias("content_language"))
    base = (_catalog(spark, sf_dir)
            .withColumn("n1_key", p % 25).withColumn("n2_key", (p + 1) % 25)
            .withColumn("lang_key", (p + F.when(p % 7 == 0, 1).otherwise(0)) % 5)
            .join(_nation_names(spark, sf_dir, "n1"), "n1_key")
            .join(_nation_names(spark, sf_dir, "n2"), "n2_key")
            .join(region, "lang_key"))
    empty = F.array().cast("array<string>")
    main_destination = F.struct(
        F.when(p % 19 == 0, F.lit("Display")).otherwise(F.lit("Shopping")).alias("name"),
        F.when(p % 23 == 0, empty).otherwise(F.array("n1")).alias("approved_countries"),
        F.when(p % 3 == 0, F.array("n2")).alias("pending_countries"),
        F.when(p % 5 == 0, F.array("n1")).otherwise(empty).alias("disapproved_countries"),
    )
    second_destination = F.struct(
        F.lit("Shopping").alias("name"), empty.alias("approved_countries"),
        F.lit(None).cast("array<string>").alias("pending_countries"),
        F.array("n1").alias("disapproved_countries"),
    )
    destinations = (F.when((p % 17 == 0) & (p % 2 == 0), F.lit(None))
                    .when(p % 17 == 0, F.array().cast(T.ArrayType(schemas.DESTINATION)))
                    .when(p % 29 == 0, F.array(main_destination, second_destination))
                    .otherwise(F.array(main_destination)))
    price = F.col("p_retailprice")
    ps = p.cast("string")
    rows = base.select(
        F.when(p % 11 == 0, F.lit(7)).cast("bigint").alias("aggregator_id"),
        (p % 2).cast("bigint").alias("merchant_id"),
        F.concat(F.lit("online:"), ps).alias("product_id"),
        F.concat(F.lit("Sku"), ps).alias("offer_id"),
        "content_language",
        F.when(p % 13 == 0, F.lit("local")).otherwise(F.lit("online")).alias("channel"),
        F.col("p_name").alias("title"),
        F.concat(F.lit("https://shop.example/p/"), ps).alias("link"),
        F.when(p % 9 == 0, F.lit("out of stock")).otherwise(F.lit("in stock")).alias("availability"),
        F.col("p_brand").alias("brand"),
        F.lower("p_brand").alias("google_brand_id"),
        _gtin(p).alias("gtin"),
        F.struct(price.cast("decimal(38,9)").alias("value")).alias("price"),
        F.when(p % 3 == 0, F.struct(F.round(price * F.lit(0.9), 2).cast("decimal(38,9)")
                                    .alias("value"))).alias("sale_price"),
        F.col("p_type").alias("google_product_category"),
        F.when(p % 31 == 0, F.lit(None).cast("string"))
        .when(p % 37 == 0, F.col("p_type"))
        .otherwise(F.concat_ws(" > ", F.lit("Root"), F.col("p_type"), F.col("p_brand")))
        .alias("google_product_category_path"),
        F.col("p_type").alias("product_type"),
        F.concat(F.lit("https://img.example/"), ps, F.lit(".jpg")).alias("image_link"),
        F.split_part(F.col("p_name"), F.lit(" "), F.lit(1)).alias("color"),
        F.lit("new").alias("condition"),
        _case(p % 3, ["female", "male", "unisex"]).alias("gender"),
        F.struct(F.col("p_type").alias("label_0"), F.col("p_brand").alias("label_1"),
                 F.concat(F.lit("size_"), F.col("p_size").cast("string")).alias("label_2"),
                 F.lit(None).cast("string").alias("label_3"),
                 F.lit(None).cast("string").alias("label_4")).alias("custom_labels"),
        destinations.alias("destinations"),
    )
    return _on_days(rows, spark, sf_dir).select("partition_date", *rows.columns)


def price_competitiveness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark per product and day, reported for the product's first country;
    for one product in four it is reported for the neighbour country instead
    (which matches only when that country is targeted too)."""
    p = F.col("p_partkey")
    base = (_catalog(spark, sf_dir)
            .withColumn("n1_key", p % 25).withColumn("n2_key", (p + 1) % 25)
            .join(_nation_names(spark, sf_dir, "n1"), "n1_key")
            .join(_nation_names(spark, sf_dir, "n2"), "n2_key"))
    price = F.col("p_retailprice")
    factor = _case(p % 7, BENCHMARK_FACTORS)
    rows = base.select(
        F.when(p % 11 == 0, F.lit(7)).cast("bigint").alias("aggregator_id"),
        (p % 2).cast("bigint").alias("merchant_id"),
        F.concat(F.lit("online:"), p.cast("string")).alias("id"),
        F.col("p_brand").alias("brand"),
        F.concat(F.lit("Sku"), p.cast("string")).alias("offer_id"),
        F.when(p % 4 == 3, F.col("n2")).otherwise(F.col("n1")).alias("report_country_code"),
        F.struct(_micros(price).alias("amount_micros"),
                 F.lit(CURRENCY).alias("currency_code")).alias("price"),
        F.struct(_micros(price * factor).alias("amount_micros"),
                 F.lit(CURRENCY).alias("currency_code")).alias("benchmark_price"),
    )
    return _on_days(rows, spark, sf_dir).select("partition_date", *rows.columns)


def price_insights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suggestion per product and day; one product in three has none."""
    p = F.col("p_partkey")
    none = p % 3 == 2
    price = F.col("p_retailprice")

    def fraction(divisor: float) -> Column:
        return F.when(~none, (p % 10).cast("double") / F.lit(divisor))

    rows = _catalog(spark, sf_dir).select(
        F.when(p % 11 == 0, F.lit(7)).cast("bigint").alias("aggregator_id"),
        (p % 2).cast("bigint").alias("merchant_id"),
        F.concat(F.lit("online:"), p.cast("string")).alias("id"),
        F.col("p_brand").alias("brand"),
        F.concat(F.lit("Sku"), p.cast("string")).alias("offer_id"),
        F.when(~none, F.struct(_micros(price * F.lit(0.95)).alias("amount_micros"),
                               F.lit(CURRENCY).alias("currency_code"))).alias("suggested_price"),
        fraction(25.0).alias("predicted_impressions_change_fraction"),
        fraction(20.0).alias("predicted_clicks_change_fraction"),
        fraction(40.0).alias("predicted_conversions_change_fraction"),
    )
    return _on_days(rows, spark, sf_dir).select("partition_date", *rows.columns)


def best_sellers_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekly clusters: each product is popular in its own country and in the
    previous nation (which it does not target)."""
    p = F.col("p_partkey")
    week = (F.col("d") / F.lit(7)).cast("bigint")
    nation = _dimension(spark, sf_dir, "nation").select(
        F.col("n_nationkey").cast("bigint").alias("country_key"), F.col("n_name").alias("country_code"))
    base = (_catalog_days(spark, sf_dir, step=7)
            .select("*", F.explode(F.array(p % 25, (p + 24) % 25)).alias("country_key"))
            .join(nation, "country_key"))
    rank = F.lit(1) + F.floor(p / F.lit(25)).cast("bigint") + week
    demand = (p + week) % 5
    previous_demand = (p + F.lit(2) * week) % 5
    has_previous = p % 6 != 0
    price = F.col("p_retailprice")
    return base.select(
        "partition_date",
        "country_code",
        (F.ascii("p_type") * 100 + F.length("p_type")).cast("bigint").alias("report_category_id"),
        F.concat(F.lit("e"), p.cast("string")).alias("entity_id"),
        F.col("p_name").alias("title"),
        F.col("p_brand").alias("brand"),
        F.col("p_type").alias("category_l1"),
        F.col("p_brand").alias("category_l2"),
        F.when(p % 2 == 0, F.lit("")).otherwise(F.concat(F.lit("size "), F.col("p_size").cast("string")))
        .alias("category_l3"),
        F.lit(None).cast("string").alias("category_l4"),
        F.col("p_name").alias("category_l5"),
        F.when(p % 4 == 0, F.concat(_gtin(p), F.lit(" "), _gtin(p + 1))).otherwise(_gtin(p))
        .alias("variant_gtins"),
        _case(p % 3, INVENTORY_LABELS).alias("product_inventory_status"),
        _case(p % 4, INVENTORY_LABELS + ["NOT_IN_INVENTORY"]).alias("brand_inventory_status"),
        rank.cast("bigint").alias("rank"),
        F.when(has_previous, rank + (p + week) % 5 - 2).cast("bigint").alias("previous_rank"),
        _case(demand, DEMAND_LABELS).alias("relative_demand"),
        F.when(has_previous, _case(previous_demand, DEMAND_LABELS)).alias("previous_relative_demand"),
        F.when(~has_previous, F.lit(None).cast("string"))
        .when(demand > previous_demand, F.lit("RISER"))
        .when(demand < previous_demand, F.lit("SINKER"))
        .otherwise(F.lit("FLAT")).alias("relative_demand_change"),
        F.struct(_micros(price * F.lit(0.9)).alias("min_amount_micros"),
                 _micros(price * F.lit(1.1)).alias("max_amount_micros"),
                 F.lit(CURRENCY).alias("currency_code")).alias("price_range"),
    )


def best_sellers_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entity -> own product, weekly. One entity in five matches no product;
    one in four matches a second (neighbouring) product as well."""
    p = F.col("p_partkey")
    own = F.concat(F.lit("online:"), p.cast("string"))
    neighbour = F.concat(F.lit("online:"), (p + 1).cast("string"))
    targets = (F.when(p % 5 == 4, F.array().cast("array<string>"))
               .when(p % 4 == 0, F.array(own, neighbour))
               .otherwise(F.array(own)))
    return _catalog_days(spark, sf_dir, step=7).select(
        "partition_date",
        F.concat(F.lit("e"), p.cast("string")).alias("entity_id"),
        F.explode(targets).alias("product_id"),
    )


_DERIVED: dict = {}


def derive_inputs(spark: SparkSession, sf_dir: str) -> RetailInputs:
    """All eight derived inputs. The lazy plans are kept per session and
    folder, so several queries of one session share them (nothing is cached
    in memory; each query still scans the source tables)."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key not in _DERIVED:
        _DERIVED[key] = _derive_inputs(spark, sf_dir)
    return _DERIVED[key]


def _derive_inputs(spark: SparkSession, sf_dir: str) -> RetailInputs:
    return RetailInputs(
        products=products(spark, sf_dir),
        price_competitiveness=price_competitiveness(spark, sf_dir),
        price_insights=price_insights(spark, sf_dir),
        shopping_product_stats=shopping_product_stats(spark, sf_dir),
        best_sellers_clusters=best_sellers_clusters(spark, sf_dir),
        best_sellers_mapping=best_sellers_mapping(spark, sf_dir),
        geo_targets=geo_targets(spark, sf_dir),
        language_codes=language_codes(spark, sf_dir),
        partitions=partitions_for(spark, _tasks(spark, sf_dir)),
    )
