"""Explicit schemas of the eight inputs and two outputs.

Daily tables carry their snapshot day in ``partition_date`` (a real ``date``
column used for directory partitioning; a name starting with ``_`` would be
hidden by Spark's file listing). The ad statistics carry ``data_date`` (day of
the metric) and ``latest_date`` (day of the transfer run).
"""

from __future__ import annotations

from pyspark.sql import types as T

S = T.StringType()
L = T.LongType()
D = T.DoubleType()
DATE = T.DateType()
B = T.BooleanType()
PRICE_VALUE = T.DecimalType(38, 9)


def _f(name, dtype, nullable=True):
    return T.StructField(name, dtype, nullable)


def strings(*names):
    return [_f(n, S) for n in names]


MONEY_MICROS = T.StructType([_f("amount_micros", L), _f("currency_code", S)])
MONEY_VALUE = T.StructType([_f("value", PRICE_VALUE)])
CUSTOM_LABELS = T.StructType(strings("label_0", "label_1", "label_2", "label_3", "label_4"))
DESTINATION = T.StructType([
    _f("name", S),
    _f("approved_countries", T.ArrayType(S)),
    _f("pending_countries", T.ArrayType(S)),
    _f("disapproved_countries", T.ArrayType(S)),
])

PRODUCTS = T.StructType([
    _f("partition_date", DATE),
    _f("aggregator_id", L),
    _f("merchant_id", L),
    _f("product_id", S),
    _f("offer_id", S),
    _f("content_language", S),
    _f("channel", S),
    *strings("title", "link", "availability", "brand", "google_brand_id", "gtin"),
    _f("price", MONEY_VALUE),
    _f("sale_price", MONEY_VALUE),
    *strings("google_product_category", "google_product_category_path", "product_type",
             "image_link", "color", "condition", "gender"),
    _f("custom_labels", CUSTOM_LABELS),
    _f("destinations", T.ArrayType(DESTINATION)),
])

PRICE_COMPETITIVENESS = T.StructType([
    _f("partition_date", DATE),
    _f("aggregator_id", L),
    _f("merchant_id", L),
    *strings("id", "brand", "offer_id", "report_country_code"),
    _f("price", MONEY_MICROS),
    _f("benchmark_price", MONEY_MICROS),
])

PRICE_INSIGHTS = T.StructType([
    _f("partition_date", DATE),
    _f("aggregator_id", L),
    _f("merchant_id", L),
    *strings("id", "brand", "offer_id"),
    _f("suggested_price", MONEY_MICROS),
    _f("predicted_impressions_change_fraction", D),
    _f("predicted_clicks_change_fraction", D),
    _f("predicted_conversions_change_fraction", D),
])

SHOPPING_PRODUCT_STATS = T.StructType([
    _f("data_date", DATE),
    _f("latest_date", DATE),
    _f("segments_product_merchant_id", L),
    *strings("segments_product_channel", "segments_product_item_id",
             "segments_product_country", "segments_product_language"),
    _f("metrics_impressions", L),
    _f("metrics_clicks", L),
    _f("metrics_cost_micros", L),
    _f("metrics_conversions", D),
    _f("metrics_conversions_value", D),
])

BEST_SELLERS_CLUSTERS = T.StructType([
    _f("partition_date", DATE),
    _f("country_code", S),
    _f("report_category_id", L),
    *strings("entity_id", "title", "brand", "category_l1", "category_l2", "category_l3",
             "category_l4", "category_l5", "variant_gtins", "product_inventory_status",
             "brand_inventory_status"),
    _f("rank", L),
    _f("previous_rank", L),
    *strings("relative_demand", "previous_relative_demand", "relative_demand_change"),
    _f("price_range", T.StructType([
        _f("min_amount_micros", L), _f("max_amount_micros", L), _f("currency_code", S)])),
])

BEST_SELLERS_MAPPING = T.StructType([
    _f("partition_date", DATE),
    _f("entity_id", S),
    _f("product_id", S),
])

# The location file has more columns; only these two are read downstream.
GEO_TARGETS = T.StructType([
    _f("criterion_id", L),
    _f("name", S),
    _f("parent_id", L),
    _f("country_code", S),
    _f("target_type", S),
])

LANGUAGE_CODES = T.StructType([
    _f("language_name", S),
    _f("language_code", S),
    _f("criterion_id", T.IntegerType()),
])

ROLLING_METRICS = [
    "impressions_30days", "clicks_30days", "cost_30days", "conversions_30days",
    "conversions_value_30days", "impressions_7days", "clicks_7days", "cost_7days",
    "conversions_7days", "conversions_value_7days",
]

INVENTORY_VIEW_COLUMNS = [
    "date", "aggregator_id", "merchant_id", "product_id", "offer_id", "targeted_country",
    "is_disapproved", "title", "link", "availability", "brand", "google_brand_id", "gtin",
    "current_price", "google_product_category", "google_product_category_path",
    "final_category", "product_type", "additional_product_attributes", "benchmark_price",
    "suggested_price", "predicted_impressions_change_fraction",
    "predicted_clicks_change_fraction", "predicted_conversions_change_fraction",
    *ROLLING_METRICS,
]

BEST_SELLERS_VIEW_COLUMNS = [
    "date", "merchant_id", "aggregator_id", "country_code", "report_category_id",
    "entity_id", "title", "brand", "category_l1", "category_l2", "category_l3",
    "category_l4", "category_l5", "full_category", "variant_gtins",
    "product_inventory_status", "brand_inventory_status", "rank", "previous_rank",
    "relative_demand", "previous_relative_demand", "relative_demand_change", "product_id",
    "offer_id", "is_disapproved", "current_price", "benchmark_price", *ROLLING_METRICS,
]

INPUTS = {
    "products": PRODUCTS,
    "price_competitiveness": PRICE_COMPETITIVENESS,
    "price_insights": PRICE_INSIGHTS,
    "shopping_product_stats": SHOPPING_PRODUCT_STATS,
    "best_sellers_product_cluster_weekly": BEST_SELLERS_CLUSTERS,
    "best_sellers_entity_product_mapping": BEST_SELLERS_MAPPING,
    "geo_targets": GEO_TARGETS,
    "language_codes": LANGUAGE_CODES,
}
