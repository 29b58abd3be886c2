"""``InventoryView``: one row per product snapshot and targeted country with
benchmark price, price suggestion and rolling ad performance of the day
before.

Join order and plan shape
-------------------------
* Filters on the product row (online channel, has a Shopping destination)
  are applied before any join; left joins keep all product rows, so this is
  the same result with less data moved.
* Status and ad performance are joined on a narrow side, and the wide
  product rows are shuffled once (see :mod:`shelfwise.plans.product_joins`);
  price insights (product key) and benchmark (product key + country) join
  on that partitioning.
* The final whole-row DISTINCT removes the duplicates that the channel and
  item-id case fan-out produce when all metrics agree.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.functions import effective_price, last_path_node, micros_to_units
from shelfwise.operators import performance, status
from shelfwise.plans import product_joins
from shelfwise.schemas import INVENTORY_VIEW_COLUMNS, ROLLING_METRICS
from shelfwise.sources.readers import RetailInputs


def price_competitiveness_rows(pc: DataFrame) -> DataFrame:
    return pc.select(
        F.col("partition_date").alias("date"), "merchant_id",
        F.col("id").alias("product_id"),
        F.col("report_country_code").alias("targeted_country"),
        micros_to_units("benchmark_price.amount_micros").alias("benchmark_price"))


def price_insights_rows(pi: DataFrame) -> DataFrame:
    return pi.select(
        F.col("partition_date").alias("date"), "merchant_id",
        F.col("id").alias("product_id"),
        micros_to_units("suggested_price.amount_micros").alias("suggested_price"),
        "predicted_impressions_change_fraction", "predicted_clicks_change_fraction",
        "predicted_conversions_change_fraction")


def rolling_for_join(inputs: RetailInputs) -> DataFrame:
    daily = performance.daily_performance(inputs.shopping_product_stats, inputs.geo_targets,
                                          inputs.language_codes)
    return performance.performance_for_snapshot_join(performance.rolling_performance(daily, inputs.partitions))


def inventory_view(inputs: RetailInputs, rolling: DataFrame | None = None) -> DataFrame:
    return inventory_rows(inputs, rolling).distinct()


def inventory_rows(inputs: RetailInputs, rolling: DataFrame | None = None) -> DataFrame:
    """The view before its DISTINCT, for marts whose results do not depend on repeated rows.

    A whole-row DISTINCT needs all columns, and so would every join and shuffle below it;
    without it Spark moves just the columns that the mart reads."""
    products = inputs.products.where(
        (F.col("channel") == "online") & status.has_shopping_destination())
    perf = rolling if rolling is not None else rolling_for_join(inputs)
    keyed = product_joins.partitioned_products(products, bucketed=inputs.bucketed, partitions=inputs.partitions)
    joined = (product_joins.join_status_and_performance(keyed, perf)
              .join(price_insights_rows(inputs.price_insights),
                    ["date", "merchant_id", "product_id"], "left")
              .join(price_competitiveness_rows(inputs.price_competitiveness),
                    ["date", "merchant_id", "product_id", "targeted_country"], "left"))

    view = joined.select(
        "date",
        F.coalesce("aggregator_id", "merchant_id").alias("aggregator_id"),
        "merchant_id", "product_id", "offer_id", "targeted_country", "is_disapproved",
        "title", "link", "availability", "brand", "google_brand_id", "gtin",
        effective_price().alias("current_price"),
        "google_product_category", "google_product_category_path",
        last_path_node("google_product_category_path").alias("final_category"),
        "product_type",
        F.struct("image_link", "color", "custom_labels", "condition", "gender")
        .alias("additional_product_attributes"),
        "benchmark_price", "suggested_price",
        "predicted_impressions_change_fraction", "predicted_clicks_change_fraction",
        "predicted_conversions_change_fraction",
        *ROLLING_METRICS,
    )
    assert view.columns == INVENTORY_VIEW_COLUMNS
    return view
