"""Product snapshot rows joined with their country status, ad performance and
price tables: the join core shared by both views.

Shuffle plan (the product rows are the widest and largest input):

1. The product rows are hash partitioned once on the product. Every later
   join key contains that column, so with
   ``spark.sql.requireAllClusterKeysForCoPartition=false`` each join (and
   the views' final DISTINCT) reuses this partitioning; product ids are
   unique per day, so a key has as many rows as there are days and the
   partitioning is not skewed. Days that a task reads one after the other
   stay side by side, and what did not change between them compresses.
2. Offer variants and country statuses come from the same product rows in one
   pass (Spark prunes that branch to key, offer, language and destinations, a
   narrow shuffle on the same keys): the narrow side. So the products are read
   twice, wide and narrow.
3. Only the narrow side is shuffled to meet the ad performance (keyed by
   offer, country, language, day) and back.
4. The wide rows then join the narrow side, the benchmark and the price
   insights on their existing partitioning (the other sides are shuffled
   to match), and the final DISTINCT of the views reuses it too.

Result semantics are those of ``P LEFT JOIN status ON (date, merchant,
product) LEFT JOIN performance ON (P.offer, status.country, P.language,
day)`` even when a product key repeats: the narrow side carries, per
(product key, offer variant), every status row of the key, and it is joined
back on the key plus that variant (null-safe, so a NULL offer or language
still keeps its status rows).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.operators import status
from shelfwise.operators.performance import SNAPSHOT_JOIN_KEYS
from shelfwise.session import dealt

PRODUCT_KEY = ["date", "merchant_id", "product_id"]
PRODUCT_PARTITIONING = ["product_id"]
# In this order a sort by them keeps the days of a product together.
DAY_OF_PRODUCT = ["product_id", "merchant_id", "date"]
ONLY = ["product_id", "date"]
VARIANT = ["offer_key", "content_language"]


def partitioned_products(products: DataFrame, only: DataFrame | None = None, bucketed: bool = False,
                         partitions: int | None = None) -> DataFrame:
    """Product rows keyed for the joins, hash partitioned on the product, or left as they
    lie where the table is bucketed by product: the joins then use the buckets.

    ``only`` (columns ``date, product_id``) keeps just the products it names (each named
    once, joined on the same partitioning), before any other join.
    """
    keyed = (products.withColumnRenamed("partition_date", "date")
             .withColumn("offer_key", F.lower("offer_id")))
    if not bucketed:
        keyed = dealt(keyed, partitions, *PRODUCT_PARTITIONING)
    if only is not None:
        # Not as a semi join: Spark would move that below the repartition and shuffle all
        # products for it, on other keys.
        only = only.select(*ONLY)
        only = only.distinct() if bucketed else dealt(only, partitions, *PRODUCT_PARTITIONING).distinct()
        keyed = keyed.join(only, ONLY).select(*keyed.columns)
    return keyed


def product_variants(products: DataFrame) -> DataFrame:
    """(product key, offer variant) x status row, each once: every variant of a key meets the
    statuses of all its rows.

    One window over a key gathers the statuses of its rows, and each variant speaks once. It
    reuses the products' partitioning and sorts just the narrow columns; nothing is grouped,
    and a task holds the arrays of one key at a time.
    """
    key = Window.partitionBy(*DAY_OF_PRODUCT).orderBy(*VARIANT)
    whole = key.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = (products.dropna(subset=PRODUCT_KEY)
            .select(*PRODUCT_KEY, *VARIANT, status.country_statuses(F.col("destinations")).alias("statuses"))
            .withColumn("before", F.lag(F.struct(*VARIANT)).over(key))
            .withColumn("gathered", F.collect_list("statuses").over(whole))
            .where(F.col("before").isNull() | ~F.col("before").eqNullSafe(F.struct(*VARIANT))))
    return rows.select(*PRODUCT_KEY, *VARIANT, F.inline(F.array_distinct(F.flatten("gathered"))))


def status_with_performance(products: DataFrame, perf: DataFrame) -> DataFrame:
    """Narrow side: (product key, offer variant) x status row x performance."""
    return product_variants(products).join(perf, SNAPSHOT_JOIN_KEYS, "left")


def join_status_and_performance(products: DataFrame, perf: DataFrame) -> DataFrame:
    """``products`` (from :func:`partitioned_products`) left-joined with the
    status rows of their key and the performance of the previous day."""
    narrow = status_with_performance(products, perf)
    narrow = narrow.select(*[F.col(c).alias(f"s_{c}") if c in PRODUCT_KEY + VARIANT else F.col(c)
                             for c in narrow.columns])
    cond = [products[c] == narrow[f"s_{c}"] for c in PRODUCT_KEY]
    cond += [products[c].eqNullSafe(narrow[f"s_{c}"]) for c in VARIANT]
    joined = products.join(narrow, cond, "left")
    return joined.drop(*[f"s_{c}" for c in PRODUCT_KEY + VARIANT])
