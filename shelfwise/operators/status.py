"""Per-product, per-country status from the nested ``destinations`` array.

Only 'Shopping' destinations count. Each one contributes the distinct union
of its approved, pending and disapproved countries; a destination with no
country still yields one row with a NULL country. The disapproval flag is
never NULL. All of this is row-local (higher-order functions + generators):
no join and no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.functions import array_or_empty

SHOPPING = "Shopping"


def shopping_destinations(destinations: Column) -> Column:
    return F.filter(destinations, lambda d: d["name"] == F.lit(SHOPPING))


def has_shopping_destination(destinations: str = "destinations") -> Column:
    """EXISTS a 'Shopping' destination; false (not NULL) for a NULL array."""
    return F.coalesce(F.exists(F.col(destinations), lambda d: d["name"] == F.lit(SHOPPING)),
                      F.lit(False))


def targeted_countries(destination: Column) -> Column:
    """Distinct union of the three country lists (NULL lists count as empty)."""
    return F.array_distinct(_listed(destination))


def _listed(destination: Column) -> Column:
    return F.concat(
        array_or_empty(destination["approved_countries"]),
        array_or_empty(destination["pending_countries"]),
        array_or_empty(destination["disapproved_countries"]))


def country_statuses(destinations: Column) -> Column:
    """All (targeted_country, is_disapproved) of a product's Shopping destinations, as one array."""
    def of(destination):
        # Lambdas are interpreted, nothing in them is shared: the union is made distinct once.
        listed = (F.when(F.size(_listed(destination)) > 0, targeted_countries(destination))
                  .otherwise(F.array(F.lit(None).cast("string"))))
        return F.transform(listed, lambda c: F.struct(
            c.alias("targeted_country"),
            F.coalesce(F.array_contains(destination["disapproved_countries"], c), F.lit(False))
            .alias("is_disapproved")))
    return F.flatten(F.transform(shopping_destinations(F.coalesce(destinations, F.array())), of))


def product_status(products: DataFrame, date_column: str = "partition_date") -> DataFrame:
    """One row per product and Shopping destination (``ProductStatus``)."""
    exploded = products.select(
        F.col(date_column).alias("date"), "merchant_id", "product_id",
        F.explode(shopping_destinations(F.col("destinations"))).alias("destination"))
    return exploded.select("date", "merchant_id", "product_id",
                           targeted_countries(F.col("destination")).alias("targeted_countries"),
                           "destination")


def product_country_status(products: DataFrame, date_column: str = "partition_date") -> DataFrame:
    """One row per product, Shopping destination and targeted country, with
    ``is_disapproved`` (``ProductStatusCountry``)."""
    status = product_status(products, date_column)
    rows = status.select(
        "date", "merchant_id", "product_id",
        F.explode_outer("targeted_countries").alias("targeted_country"),
        F.col("destination.disapproved_countries").alias("disapproved_countries"))
    return rows.select(
        "date", "merchant_id", "product_id", "targeted_country",
        F.coalesce(F.array_contains("disapproved_countries", F.col("targeted_country")),
                   F.lit(False)).alias("is_disapproved"))
