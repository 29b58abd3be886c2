"""Ad performance: daily sums per offer and country, then rolling 30/7-day sums.

This is the sub-pipeline both views share. Plan shape: the two dimensions are
broadcast (published lists of fixed size), the daily aggregation is a partial +
final hash aggregate (map-side combine before the shuffle), and the ten window
sums share one partitioning and ordering, hence one Exchange + Sort + Window.
Each window partition holds the daily rows of one offer/country/language, so
its size is bounded by the number of days whatever the skew of the raw rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.functions import resource_id
from shelfwise.operators import dims
from shelfwise.schemas import ROLLING_METRICS
from shelfwise.session import dealt

PERF_KEYS = ["merchant_id", "channel", "offer_id", "language_code", "target_country"]
# Keys of the product-side join: merchant, lower-case offer, country,
# language and snapshot day (= ad day + 1).
SNAPSHOT_JOIN_KEYS = ["merchant_id", "offer_key", "targeted_country", "content_language", "date"]
DAILY_METRICS = ["impressions", "clicks", "cost", "conversions", "conversions_value"]

# "30 days" and "7 days" include both ends: 31 and 8 calendar days.
LONG_WINDOW_DAYS = 30
SHORT_WINDOW_DAYS = 7


def located_stats(stats: DataFrame, geo_targets: DataFrame, languages: DataFrame) -> DataFrame:
    """Ad rows with the key columns of an offer: merchant, channel, item, language and country.

    Rows without an item id, or whose country/language id matches no dimension row, are
    dropped (inner joins). Both dimensions are published reference lists (places and
    languages), whose size does not depend on the data, so they are broadcast."""
    geo = F.broadcast(dims.geo_countries(geo_targets))
    lang = F.broadcast(dims.language_codes(languages))
    s = (stats.where(F.col("segments_product_item_id").isNotNull())
         .select(
             "data_date", "latest_date",
             F.col("segments_product_merchant_id").alias("merchant_id"),
             F.lower("segments_product_channel").alias("channel"),
             F.col("segments_product_item_id").alias("offer_id"),
             resource_id("segments_product_country").alias("country_criterion_id"),
             resource_id("segments_product_language").alias("language_criterion_id"),
             "metrics_impressions", "metrics_clicks", "metrics_cost_micros",
             "metrics_conversions", "metrics_conversions_value"))
    return (s.join(geo, s.country_criterion_id == geo.parent_id, "inner")
            .join(lang, s.language_criterion_id == lang.criterion_id.cast("bigint"), "inner")
            .withColumnRenamed("country_code", "target_country"))


def daily_performance(stats: DataFrame, geo_targets: DataFrame, languages: DataFrame) -> DataFrame:
    """Sum the ad metrics per day, transfer run, merchant, channel, item, language and country."""
    return (located_stats(stats, geo_targets, languages)
            .groupBy("data_date", "latest_date", "merchant_id", "channel", "offer_id",
                     "language_code", "target_country")
            .agg(F.sum("metrics_impressions").alias("impressions"),
                 F.sum("metrics_clicks").alias("clicks"),
                 F.try_divide(F.sum("metrics_cost_micros"), F.lit(1e6)).alias("cost"),
                 F.sum("metrics_conversions").alias("conversions"),
                 F.sum("metrics_conversions_value").alias("conversions_value")))


def rolling_performance(daily: DataFrame, partitions: int | None = None) -> DataFrame:
    """Rolling sums over RANGE frames of 30 and 7 preceding days (same-day rows
    are peers, so rows of several transfer runs share one value)."""
    # One partitioning serves the window and, after it, the merge and the product join.
    daily = dealt(daily.withColumn("offer_key", F.lower("offer_id")), partitions,
                  "merchant_id", "offer_key", "target_country", "language_code")
    order = Window.partitionBy(*PERF_KEYS, "offer_key").orderBy(F.unix_date("data_date"))
    long_w = order.rangeBetween(-LONG_WINDOW_DAYS, 0)
    short_w = order.rangeBetween(-SHORT_WINDOW_DAYS, 0)
    sums = [F.sum(m).over(long_w).alias(f"{m}_30days") for m in DAILY_METRICS]
    sums += [F.sum(m).over(short_w).alias(f"{m}_7days") for m in DAILY_METRICS]
    return daily.select(F.col("data_date").alias("date"), *PERF_KEYS, "offer_key", *sums)


def performance_for_snapshot_join(rolling: DataFrame) -> DataFrame:
    """Rolling rows keyed for the product join: the snapshot of day D reads
    the performance of day D-1 exactly, and offers match case-insensitively.

    Channel and transfer run are not join keys, so several rows per key can
    exist; rows equal in all ten metrics are merged here, which the final
    DISTINCT of both views would do anyway (it shrinks the join fan-out).
    The merge and the join that follows reuse the window's partitioning, whose
    keys are among theirs.
    """
    keyed = rolling.select(
        "merchant_id",
        "offer_key",
        F.col("target_country").alias("targeted_country"),
        F.col("language_code").alias("content_language"),
        F.date_add("date", 1).alias("date"),
        *ROLLING_METRICS)
    return keyed.dropDuplicates()
