from __future__ import annotations

import datetime as dt
import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from pyspark.sql import SparkSession  # noqa: E402

from shelfwise import schemas  # noqa: E402
from shelfwise.session import DEFAULT_CONF, ensure_checkpoint_dir  # noqa: E402
from shelfwise.sources.readers import RetailInputs  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
D = dt.date


@pytest.fixture(scope="session")
def spark():
    builder = (SparkSession.builder.master("local[*]").appName("shelfwise-tests")
               .config("spark.sql.shuffle.partitions", "8"))
    for key, value in DEFAULT_CONF.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(session)
    yield session


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="shelfwise-test-")


def _complete(row: dict, schema) -> dict:
    return {f.name: row.get(f.name) for f in schema.fields}


def destination(name="Shopping", approved=(), pending=None, disapproved=()):
    return {"name": name,
            "approved_countries": None if approved is None else list(approved),
            "pending_countries": None if pending is None else list(pending),
            "disapproved_countries": None if disapproved is None else list(disapproved)}


def product(day=D(2024, 1, 10), pid="online:1", offer="Sku1", merchant=1, language="en",
            channel="online", destinations=None, price=10.0, sale_price=None,
            path="Root > Toys > Cars", **extra) -> dict:
    from decimal import Decimal
    row = {
        "partition_date": day, "aggregator_id": None, "merchant_id": merchant,
        "product_id": pid, "offer_id": offer, "content_language": language, "channel": channel,
        "title": f"title {pid}", "link": "l", "availability": "in stock", "brand": "B",
        "google_brand_id": "b", "gtin": "1", "price": {"value": Decimal(str(price))},
        "sale_price": None if sale_price is None else {"value": Decimal(str(sale_price))},
        "google_product_category": "Toys", "google_product_category_path": path,
        "product_type": "t", "image_link": "i", "color": "red", "condition": "new",
        "gender": "unisex",
        "custom_labels": {"label_0": "L0", "label_1": None, "label_2": None, "label_3": None,
                          "label_4": None},
        "destinations": ([destination(approved=["US"])] if destinations is None
                         else destinations),
    }
    row.update(extra)
    return row


def stat(day, item="SKU1", merchant=1, channel="ONLINE", country="geoTargetConstants/2840",
         language="languageConstants/1000", impressions=1, clicks=0, cost_micros=0,
         conversions=0.0, value=0.0, latest=D(2024, 3, 1)) -> dict:
    return {
        "data_date": day, "latest_date": latest, "segments_product_merchant_id": merchant,
        "segments_product_channel": channel, "segments_product_item_id": item,
        "segments_product_country": country, "segments_product_language": language,
        "metrics_impressions": impressions, "metrics_clicks": clicks,
        "metrics_cost_micros": cost_micros, "metrics_conversions": conversions,
        "metrics_conversions_value": value,
    }


GEO_ROWS = [
    {"criterion_id": 1, "name": "US", "parent_id": 2840, "country_code": "US", "target_type": "Country"},
    {"criterion_id": 2, "name": "US city", "parent_id": 2840, "country_code": "US", "target_type": "City"},
    {"criterion_id": 3, "name": "DE", "parent_id": 2276, "country_code": "DE", "target_type": "Country"},
]
LANG_ROWS = [
    {"language_name": "English", "language_code": "en", "criterion_id": 1000},
    {"language_name": "English (alt)", "language_code": "en", "criterion_id": 1000},
    {"language_name": "German", "language_code": "de", "criterion_id": 1001},
]


def frame(spark, rows, schema):
    return spark.createDataFrame([_complete(r, schema) for r in rows], schema)


def inputs(spark, products=(), stats=(), pc=(), pi=(), clusters=(), mapping=(),
           geo=GEO_ROWS, lang=LANG_ROWS) -> RetailInputs:
    return RetailInputs(
        products=frame(spark, products, schemas.PRODUCTS),
        price_competitiveness=frame(spark, pc, schemas.PRICE_COMPETITIVENESS),
        price_insights=frame(spark, pi, schemas.PRICE_INSIGHTS),
        shopping_product_stats=frame(spark, stats, schemas.SHOPPING_PRODUCT_STATS),
        best_sellers_clusters=frame(spark, clusters, schemas.BEST_SELLERS_CLUSTERS),
        best_sellers_mapping=frame(spark, mapping, schemas.BEST_SELLERS_MAPPING),
        geo_targets=frame(spark, geo, schemas.GEO_TARGETS),
        language_codes=frame(spark, lang, schemas.LANGUAGE_CODES),
    )


def benchmark(day, pid, country, micros, merchant=1) -> dict:
    return {"partition_date": day, "merchant_id": merchant, "id": pid,
            "report_country_code": country,
            "benchmark_price": {"amount_micros": micros, "currency_code": "USD"}}


def insight(day, pid, micros, clicks_fraction=0.1, merchant=1) -> dict:
    return {"partition_date": day, "merchant_id": merchant, "id": pid,
            "suggested_price": {"amount_micros": micros, "currency_code": "USD"},
            "predicted_impressions_change_fraction": 0.05,
            "predicted_clicks_change_fraction": clicks_fraction,
            "predicted_conversions_change_fraction": 0.02}


def plan_text(df, mode: str = "formatted") -> str:
    """The text ``df.explain(mode)`` prints."""
    import contextlib
    import io

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def plan_nodes(df, name: str) -> int:
    """Number of ``name`` operators in the physical plan tree."""
    import re

    tree = plan_text(df).split("\n\n")[0]
    pattern = rf"^[ :+|-]*{re.escape(name)}(?: [^(\n]*)? \(\d+\)$"
    return len(re.findall(pattern, tree, flags=re.M))


def rows(df, *cols):
    """Sorted list of tuples of the given columns."""
    return sorted((tuple(r[c] for c in cols) for r in df.collect()),
                  key=lambda t: tuple((x is None, str(x)) for x in t))
