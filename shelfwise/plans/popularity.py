"""Popularity marts over the best-seller view (overview, details, restock
list, GTIN list).

Distinct counts are computed in two aggregation levels (first per entity or
offer, then per group), which keeps each level a plain partial + final hash
aggregate instead of one expanded distinct aggregate per measure.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.plans.pricing import on_date, ordered_list
from shelfwise.schemas import ROLLING_METRICS

# Availability labels from the two inventory-status codes.
# The codes are those of the best-seller report; pass another mapping if the
# source uses different ones.
DEFAULT_STATUS_CODES = {
    "in_stock": "IN_STOCK",
    "out_of_stock": "OUT_OF_STOCK",
    "not_in_inventory": "NOT_IN_INVENTORY",
}
AVAILABILITY_LABELS = {
    "in_stock": "In stock",
    "out_of_stock": "Out of stock",
    "brand_in_stock": "Brand in stock",
    "brand_not_in_stock": "Brand not in stock",
    "not_in_inventory": "Not in inventory",
}
HIGH_DEMAND = ("HIGH", "VERY_HIGH")

CLUSTER_COLUMNS = [
    "date", "country_code", "report_category_id", "entity_id", "title", "brand",
    "category_l1", "category_l2", "category_l3", "category_l4", "category_l5",
    "product_inventory_status", "brand_inventory_status", "rank", "previous_rank",
    "relative_demand", "previous_relative_demand", "relative_demand_change",
]
LEVELS = ["category_l5", "category_l4", "category_l3", "category_l2", "category_l1"]


def category_label() -> Column:
    """MA23: the deepest non-blank category level of a cluster."""
    return F.coalesce(*[F.nullif(F.col(c), F.lit("")) for c in LEVELS])


def availability(codes: dict | None = None) -> Column:
    """MA16: product and brand inventory status folded into five labels."""
    c = codes or DEFAULT_STATUS_CODES
    product, brand = F.col("product_inventory_status"), F.col("brand_inventory_status")
    return (F.when(product == c["in_stock"], F.lit(AVAILABILITY_LABELS["in_stock"]))
            .when(product == c["out_of_stock"], F.lit(AVAILABILITY_LABELS["out_of_stock"]))
            .when(brand == c["in_stock"], F.lit(AVAILABILITY_LABELS["brand_in_stock"]))
            .when(brand == c["out_of_stock"], F.lit(AVAILABILITY_LABELS["brand_not_in_stock"]))
            .otherwise(F.lit(AVAILABILITY_LABELS["not_in_inventory"])))


OVERVIEW_DIMENSIONS = ("category", "brand")


def best_sellers_overview(best_sellers: DataFrame, date=None) -> DataFrame:
    """MA12-MA14 per date and country, by category and by brand: number of
    popular products, how many of them the merchant has, and the share."""
    df = on_date(best_sellers, date)
    dims = F.array(
        F.struct(F.lit("category").alias("dimension"),
                 F.col("report_category_id").cast("string").alias("value")),
        F.struct(F.lit("brand").alias("dimension"), F.col("brand").alias("value")))
    expanded = df.select("date", "country_code", "entity_id",
                         F.col("product_id").isNotNull().alias("matched"), F.inline(dims))
    per_entity = (expanded.groupBy("date", "country_code", "dimension", "value", "entity_id")
                  .agg(F.max("matched").alias("matched")))
    return (per_entity.groupBy("date", "country_code", "dimension", "value")
            .agg(F.count(F.lit(1)).alias("top_products"),
                 F.sum(F.col("matched").cast("bigint")).alias("top_products_you_have"))
            .withColumn("share_you_have",
                        F.col("top_products_you_have") / F.col("top_products")))


def best_sellers_details(best_sellers: DataFrame, date=None, codes: dict | None = None) -> DataFrame:
    """MA15-MA20 per cluster (date, country, category, entity): cluster
    attributes, availability, rank change, own offers, share of disapproved
    offers and 30-day clicks, conversions, conversion rate and ROAS."""
    df = on_date(best_sellers, date)
    # Two distinct counts in one pass: the view repeats a performance row for each of a
    # product's Shopping destinations, so performance is distinct without disapproval, and
    # offers are distinct per merchant.
    metrics = {c: df.schema[c].dataType for c in ROLLING_METRICS}
    none = [F.lit(None).cast(t).alias(c) for c, t in metrics.items()]
    flag = F.coalesce("is_disapproved", F.lit(False))
    both = F.array(
        F.struct(F.lit("performance").alias("kind"), F.lower("offer_id").alias("offer"),
                 F.lit(False).alias("flag"), *[F.col(c) for c in metrics]),
        F.struct(F.lit("offer").alias("kind"), F.col("offer_id").alias("offer"), flag.alias("flag"), *none))
    once = (df.select(*CLUSTER_COLUMNS, "merchant_id", F.inline(both))
            .groupBy(*CLUSTER_COLUMNS, "merchant_id", "kind", "offer", *metrics)
            .agg(F.max("flag").alias("disapproved")))
    is_offer = (F.col("kind") == "offer") & F.col("offer").isNotNull()
    per_cluster = (once.groupBy(*CLUSTER_COLUMNS)
                   .agg(F.count(F.when(is_offer, 1)).alias("offers_in_inventory"),
                        F.count(F.when(is_offer & F.col("disapproved"), 1)).alias("disapproved_offers"),
                        *[F.sum(c).alias(c) for c in ("clicks_30days", "conversions_30days",
                                                      "cost_30days", "conversions_value_30days")]))
    return per_cluster.select(
        "date", "country_code", "report_category_id", "entity_id", "title", "brand",
        category_label().alias("category"),
        availability(codes).alias("availability"),
        "rank", "previous_rank", (F.col("previous_rank") - F.col("rank")).alias("rank_change"),
        "relative_demand", "previous_relative_demand", "relative_demand_change",
        "offers_in_inventory", "disapproved_offers",
        F.try_divide(F.col("disapproved_offers"), F.col("offers_in_inventory"))
        .alias("pct_disapproved_offers"),
        "clicks_30days", "conversions_30days",
        F.try_divide(F.col("conversions_30days"), F.col("clicks_30days")).alias("conversion_rate"),
        F.try_divide(F.col("conversions_value_30days"), F.col("cost_30days")).alias("roas"),
    )


def restock_list(best_sellers: DataFrame, date=None, k: int | None = None,
                 codes: dict | None = None, ranked: bool = False) -> DataFrame:
    """MA21: high-demand popular products the merchant has but out of stock,
    best rank first."""
    c = codes or DEFAULT_STATUS_CODES
    df = on_date(best_sellers, date).where(
        F.col("relative_demand").isin(*HIGH_DEMAND)
        & (F.col("product_inventory_status") == c["out_of_stock"]))
    rows = df.select("date", "country_code", "report_category_id", "entity_id", "title", "brand",
                     "rank", "relative_demand", "relative_demand_change").distinct()
    order = [F.col("rank").asc_nulls_last(),
             *[F.col(x).asc_nulls_first() for x in (
                 "country_code", "report_category_id", "entity_id", "title", "brand",
                 "relative_demand", "relative_demand_change")]]
    return ordered_list(rows, order, k, ranked)


def cluster_gtins(best_sellers: DataFrame, date=None) -> DataFrame:
    """MA22: one row per cluster and GTIN of its space-separated list."""
    df = on_date(best_sellers, date)
    return (df.select("date", "country_code", "entity_id",
                      F.explode(F.split(F.col("variant_gtins"), " ")).alias("gtin"))
            .where(F.col("gtin") != "")
            .distinct())
