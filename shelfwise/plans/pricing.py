"""Pricing marts over the inventory view (price benchmark, breakdown,
reactivation list, price suggestion).

Conventions (decisions the dashboard text leaves open):
* price position compares integer micros, so the band edges are exact:
  cheaper if ``price * 100 <= benchmark * 99``, more expensive if
  ``price * 100 >= benchmark * 101``, similar otherwise; no price or a zero
  benchmark has no position;
* counts are of distinct (merchant, product, country) pairs with a benchmark,
  because the view can repeat a pair (one row per ad channel / item-id case);
  a pair whose rows differ in position counts once, under its dearest row:
  more expensive, else similar, else cheaper;
* every mart is per snapshot ``date``: ``None`` gives all dates;
* lists are complete. ``ranked`` adds each row's ``position`` within its date, exactly and
  without a task that sees a whole date (:mod:`shelfwise.operators.ranking`); that runs a job
  when the list is built. ``k`` keeps the first ``k`` rows of each date and their position;
  Spark computes such a limit per partition before the shuffle (window group limit).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.operators.ranking import first_or_all

CHEAPER = "cheaper"
MORE_EXPENSIVE = "more_expensive"
SIMILAR = "similar"

# The +-1% band of the price position, in percent of the benchmark.
CHEAPER_MAX_PERCENT = 99
MORE_EXPENSIVE_MIN_PERCENT = 101

CUSTOM_LABELS = [f"custom_label_{i}" for i in range(5)]


def on_date(df: DataFrame, date) -> DataFrame:
    """``None``: all dates; ``"latest"``: the newest date of ``df`` (a scalar
    subquery, evaluated once, no driver round trip); else that date.

    ``"latest"`` is meant for a view read from its written, date-partitioned
    table, where the maximum reads one partition column; on a view computed
    in the same query it computes the view a second time.
    """
    if date is None:
        return df
    if date == "latest":
        return df.where(F.col("date") == df.select(F.max("date")).scalar())
    return df.where(F.col("date") == F.lit(date).cast("date"))


def price_ratio() -> Column:
    return F.try_divide(F.col("current_price").cast("double"), F.col("benchmark_price"))


def micros(price: Column) -> Column:
    return F.round(price.cast("double") * 1e6).cast("bigint")


def price_position() -> Column:
    price, benchmark = micros(F.col("current_price")) * 100, micros(F.col("benchmark_price"))
    return (F.when(benchmark == 0, F.lit(None))
            .when(price <= benchmark * CHEAPER_MAX_PERCENT, F.lit(CHEAPER))
            .when(price >= benchmark * MORE_EXPENSIVE_MIN_PERCENT, F.lit(MORE_EXPENSIVE))
            .when(price.isNotNull() & benchmark.isNotNull(), F.lit(SIMILAR)))


def custom_labels() -> list[Column]:
    return [F.col(f"additional_product_attributes.custom_labels.label_{i}").alias(name)
            for i, name in enumerate(CUSTOM_LABELS)]


def ordered_list(df: DataFrame, order: list[Column], k: int | None, ranked: bool) -> DataFrame:
    """A list per date: the first ``k`` rows, or all of them, with their ``position`` if ``ranked``."""
    return first_or_all(df, ["date"], order, k) if ranked or k is not None else df


def price_benchmark(inventory: DataFrame, date=None, disapproved_only: bool = False) -> DataFrame:
    """MA1, MA2, MA5: one row per product, country and price with benchmark,
    delta, relative delta and price position."""
    return _benchmark_rows(inventory, date, disapproved_only).distinct()


def _benchmark_rows(inventory: DataFrame, date=None, disapproved_only: bool = False) -> DataFrame:
    """Benchmark rows, possibly repeated (the counts below are per distinct
    product and country, so they need no DISTINCT of their own)."""
    df = on_date(inventory, date).where(F.col("benchmark_price").isNotNull())
    if disapproved_only:
        df = df.where(F.col("is_disapproved"))
    ratio = price_ratio()
    return df.select(
        "date", "merchant_id", "product_id", "offer_id", "targeted_country", "is_disapproved",
        "title", "brand", F.col("final_category").alias("category"),
        *custom_labels(),
        F.col("current_price").cast("double").alias("current_price"), "benchmark_price",
        (F.col("current_price").cast("double") - F.col("benchmark_price")).alias("price_delta"),
        (ratio - F.lit(1.0)).alias("relative_delta"),
        price_position().alias("price_position"),
    )


PAIR = ["merchant_id", "product_id", "targeted_country"]
CLASSES = {CHEAPER: "cheaper_products", SIMILAR: "similar_products", MORE_EXPENSIVE: "more_expensive_products"}


def _counted_rows(inventory: DataFrame, date=None) -> DataFrame:
    """Benchmark rows with their class as a number (the dearest is greatest, none is NULL) and
    the number of rows of their pair on that date, counted on the view's own partitioning."""
    position = F.col("price_position")
    number = F.coalesce(*[F.when(position == c, F.lit(i)) for i, c in enumerate(CLASSES)])
    return (_benchmark_rows(inventory, date).withColumn("class", number)
            .withColumn("rows_of_pair", F.count(F.lit(1)).over(Window.partitionBy("date", *PAIR))))


def _class_counts(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct pairs per ``keys`` (the date among them) and the class of each one's dearest row.

    Nearly every pair has one row on its date, which is counted where it stands. Only pairs
    of several rows keep a group of their own, so what is shuffled and held does not grow with
    the other pairs times the keys that each row is expanded to.
    """
    alone = F.col("rows_of_pair") == 1
    first = rows.groupBy(*keys, F.when(~alone, F.struct(*PAIR)).alias("pair")).agg(
        F.count(F.when(alone, 1)).alias("alone"),
        *[F.count(F.when(alone & (F.col("class") == i), 1)).alias(f"alone_{i}") for i in range(len(CLASSES))],
        F.max(F.when(~alone, F.col("class"))).alias("dearest"))
    total = F.col("products_with_benchmark")
    return (first.groupBy(*keys)
            .agg((F.sum("alone") + F.count("pair")).alias("products_with_benchmark"),
                 *[(F.sum(f"alone_{i}") + F.count(F.when(F.col("dearest") == i, 1))).alias(n)
                   for i, n in enumerate(CLASSES.values())])
            .select(*keys, "products_with_benchmark", "cheaper_products", "more_expensive_products", "similar_products")
            .withColumn("pct_cheaper", F.col("cheaper_products") / total)
            .withColumn("pct_more_expensive", F.col("more_expensive_products") / total)
            .withColumn("pct_similar", F.col("similar_products") / total))


def price_benchmark_summary(inventory: DataFrame, date=None) -> DataFrame:
    """MA3, MA4 per date and disapproval flag: products with a benchmark and the share cheaper /
    more expensive / similar of them. A product without a price (or with a benchmark of zero)
    is in the denominator and in no class; the shares add up to 1 where there is none."""
    return _class_counts(_counted_rows(inventory, date), ["date", "is_disapproved"])


BREAKDOWN_DIMENSIONS = ("brand", *CUSTOM_LABELS, "category")


def benchmark_breakdown(inventory: DataFrame, date=None) -> DataFrame:
    """MA7: MA3 + MA4 per brand, per each of the five custom labels and per category, in one pass
    (each product row is expanded once per dimension, like GROUPING SETS)."""
    rows = _counted_rows(inventory, date)
    dims = F.array(*[F.struct(F.lit(d).alias("dimension"), F.col(d).alias("value"))
                     for d in BREAKDOWN_DIMENSIONS])
    expanded = rows.select("date", *PAIR, "class", "rows_of_pair", F.inline(dims))
    return _class_counts(expanded, ["date", "dimension", "value"])


SCOPES = ("all", "disapproved")


def benchmark_drill(inventory: DataFrame, date=None) -> DataFrame:
    """MA5 with MA3 + MA4 at every drill level: per scope (all products, disapproved ones only)
    the whole selection (dimension ``total``, no value) and each brand, custom label and
    category. One expansion of each row serves all levels and both scopes."""
    rows = _counted_rows(inventory, date)
    levels = [F.struct(F.lit("total").alias("dimension"), F.lit(None).cast("string").alias("value")),
              *[F.struct(F.lit(d).alias("dimension"), F.col(d).alias("value")) for d in BREAKDOWN_DIMENSIONS]]
    scopes = F.when(F.col("is_disapproved"), F.array(*map(F.lit, SCOPES))).otherwise(F.array(F.lit(SCOPES[0])))
    expanded = (rows.withColumn("scope", F.explode(scopes))
                .select("date", "scope", *PAIR, "class", "rows_of_pair", F.inline(F.array(*levels))))
    return _class_counts(expanded, ["date", "scope", "dimension", "value"])


def focus_brands(inventory: DataFrame, date=None, k: int | None = None, ranked: bool = False) -> DataFrame:
    """MA8: brands with the largest share priced above the benchmark, that share first."""
    brands = benchmark_breakdown(inventory, date).where(F.col("dimension") == "brand")
    order = [F.col("pct_more_expensive").desc_nulls_last(),
             F.col("products_with_benchmark").desc_nulls_last(),
             F.col("brand").asc_nulls_first()]
    return ordered_list(brands.drop("dimension").withColumnRenamed("value", "brand"), order, k, ranked)


def reactivation_list(inventory: DataFrame, date=None, k: int | None = None,
                      ranked: bool = False) -> DataFrame:
    """MA6: disapproved products priced at or below the benchmark, most
    impressions first."""
    df = on_date(inventory, date).where(
        F.col("is_disapproved")
        & (micros(F.col("current_price")) <= micros(F.col("benchmark_price"))))
    rows = df.select(
        "date", "merchant_id", "product_id", "offer_id", "targeted_country", "title", "brand",
        F.col("current_price").cast("double").alias("current_price"), "benchmark_price",
        "impressions_30days", "clicks_30days").distinct()
    order = [F.col("impressions_30days").desc_nulls_last(), F.col("clicks_30days").desc_nulls_last(),
             F.col("product_id").asc_nulls_first(), F.col("targeted_country").asc_nulls_first(),
             F.col("offer_id").asc_nulls_first(), F.col("merchant_id").asc_nulls_first(),
             F.col("current_price").asc_nulls_first(), F.col("benchmark_price").asc_nulls_first(),
             F.col("title").asc_nulls_first(), F.col("brand").asc_nulls_first()]
    return ordered_list(rows, order, k, ranked)


def price_suggestion(inventory: DataFrame, date=None, disapproved_only: bool = False,
                     k: int | None = None, ranked: bool = False) -> DataFrame:
    """MA9-MA11: suggested price with predicted extra 30-day clicks and
    conversions (uplift x last 30 days), highest potential first."""
    df = on_date(inventory, date).where(F.col("suggested_price").isNotNull())
    if disapproved_only:
        df = df.where(F.col("is_disapproved"))
    rows = df.select(
        "date", "merchant_id", "product_id", "offer_id", "targeted_country", "is_disapproved",
        "brand", F.col("final_category").alias("category"),
        *custom_labels(),
        F.col("current_price").cast("double").alias("current_price"), "suggested_price",
        "predicted_clicks_change_fraction", "predicted_conversions_change_fraction",
        "clicks_30days", "conversions_30days",
        (F.col("predicted_clicks_change_fraction") * F.col("clicks_30days"))
        .alias("predicted_clicks_30days"),
        (F.col("predicted_conversions_change_fraction") * F.col("conversions_30days"))
        .alias("predicted_conversions_30days"),
    ).distinct()
    order = [F.col("predicted_clicks_30days").desc_nulls_last(),
             F.col("predicted_conversions_30days").desc_nulls_last(),
             *[F.col(c).asc_nulls_first() for c in (
                 "product_id", "targeted_country", "is_disapproved", "merchant_id", "offer_id",
                 "brand", "category", *CUSTOM_LABELS, "current_price", "suggested_price",
                 "predicted_clicks_change_fraction", "predicted_conversions_change_fraction",
                 "clicks_30days", "conversions_30days")]]
    return ordered_list(rows, order, k, ranked)
