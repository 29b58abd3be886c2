"""Readers for the eight inputs (scans, CSV dimensions, empty fallbacks).

Every reader takes an explicit schema, so nothing is inferred at scan time, and
daily tables are read with an optional day range that becomes a partition
filter (pruned at planning time when ``partition_date`` is a directory
partition, pushed into the Parquet scan otherwise).
"""

from __future__ import annotations

import datetime as dt
import json
import re
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise import schemas
from shelfwise.sources import tables

DateLike = str | dt.date | None


@dataclass(frozen=True)
class InputPaths:
    """Where the inputs live. Table names may carry account ids, as the
    warehouse tables of the source system do (``Products_<merchant id>``)."""

    root: str
    merchant_id: str = ""
    ads_customer_id: str = ""
    names: dict = field(default_factory=dict)

    def path(self, table: str) -> str:
        default = {
            "products": f"Products_{self.merchant_id}" if self.merchant_id else "products",
            "price_competitiveness": (f"PriceCompetitiveness_{self.merchant_id}"
                                      if self.merchant_id else "price_competitiveness"),
            "price_insights": (f"PriceInsights_{self.merchant_id}"
                               if self.merchant_id else "price_insights"),
            "shopping_product_stats": (f"ads_ShoppingProductStats_{self.ads_customer_id}"
                                       if self.ads_customer_id else "shopping_product_stats"),
            "best_sellers_product_cluster_weekly": (
                f"BestSellersProductClusterWeekly_{self.merchant_id}"
                if self.merchant_id else "best_sellers_product_cluster_weekly"),
            "best_sellers_entity_product_mapping": (
                f"BestSellersEntityProductMapping_{self.merchant_id}"
                if self.merchant_id else "best_sellers_entity_product_mapping"),
            "geo_targets": "geo_targets",
            "language_codes": "language_codes",
        }[table]
        return f"{self.root.rstrip('/')}/{self.names.get(table, default)}"


def _as_date(value: DateLike):
    if value is None:
        return None
    if isinstance(value, dt.date):
        return F.lit(value)
    return F.lit(value).cast("date")


def restrict_days(df: DataFrame, start: DateLike = None, end: DateLike = None,
                  column: str = "partition_date") -> DataFrame:
    """Keep days ``start <= column <= end`` (either bound optional)."""
    if start is not None:
        df = df.where(F.col(column) >= _as_date(start))
    if end is not None:
        df = df.where(F.col(column) <= _as_date(end))
    return df


def as_day(value: DateLike) -> dt.date | None:
    """The day of a date, a timestamp or their text."""
    if isinstance(value, dt.datetime):
        return value.date()
    return value if value is None or isinstance(value, dt.date) else dt.date.fromisoformat(str(value)[:10])


def read_table(spark: SparkSession, path: str, schema: T.StructType,
               start: DateLike = None, end: DateLike = None,
               date_column: str = "partition_date") -> DataFrame:
    """Scan a daily Parquet table with a fixed schema and an optional day range.

    A table that this library wrote is read as its newest manifest has it. Raises
    ``ValueError`` where any day of the range lacks a column or has it in another type.
    """
    first, last = as_day(start), as_day(end)
    found = tables.manifest(spark, path)
    if found:
        used = {d: x for d, x in found.between(first, last).items() if x.files}
        seen = {d: found.schemas[x.schema] for d, x in used.items() if x.schema}
        if len(seen) < len(used):  # days from before the table had a manifest
            seen |= {d: s for d, s in (footer_schemas(spark, path, date_column, first, last) or {}).items()
                     if d in used and d not in seen}
        check_days(seen, schema, path, date_column)
        return restrict_days(tables.read_days(spark, path, found, schema, first, last), start, end, date_column)
    try:
        inferred = spark.read.parquet(path).schema
    except AnalysisException as exc:
        if "UNABLE_TO_INFER_SCHEMA" not in str(exc):  # a table whose days are all empty
            raise
    else:
        days = footer_schemas(spark, path, date_column, first, last)
        if days is None:  # one schema for a table without day folders
            check_schema(inferred, schema, path)
        check_days(days or {}, schema, path, date_column)
    df = spark.read.schema(schema).parquet(path)
    return restrict_days(df, start, end, date_column)


FOOTER_THREADS = 16


def footer_schemas(spark: SparkSession, path: str, date_column: str, start: dt.date | None,
                   end: dt.date | None) -> dict[str, str] | None:
    """The schema of one file of each day folder of the range, as JSON by day; None for a table
    without day folders. Executors read the footers, in one small job a day, several at a time."""
    folder = tables.Folder(spark, path)
    low, high = (x.isoformat() if x else None for x in (start, end))
    days = {n.removeprefix(f"{date_column}="): n for n in folder.day_folders(date_column)}
    if not days:
        return None
    days = {d: n for d, n in days.items() if (low is None or low <= d) and (high is None or d <= high)}
    files = {d: found[0].getPath().toString() for d, n in days.items() if (found := folder.data_files(n))}
    with ThreadPoolExecutor(FOOTER_THREADS) as pool:
        return dict(zip(files, pool.map(lambda f: spark.read.parquet(f).schema.json(), files.values()), strict=True))


def check_days(found: dict[str, str], wanted: T.StructType, path: str, date_column: str) -> None:
    """:func:`check_schema` for the schemas (JSON) of a table's days; each one is compared once."""
    wanted = T.StructType([f for f in wanted.fields if f.name != date_column])
    first_day = {schema: day for day, schema in sorted(found.items(), reverse=True)}
    for schema, day in sorted(first_day.items(), key=lambda x: x[1]):
        check_schema(T.StructType.fromJson(json.loads(schema)), wanted, f"{path}, {date_column} {day}")


# Types that Parquet reads as a wider one without loss.
WIDENED = {("int", "bigint"), ("smallint", "int"), ("smallint", "bigint"), ("float", "double"),
           ("int", "double")}


def _faults(found: T.DataType, wanted: T.DataType, name: str) -> list[str]:
    if isinstance(wanted, T.StructType) and isinstance(found, T.StructType):
        have = {f.name: f.dataType for f in found.fields}
        return [x for f in wanted.fields for x in (
            _faults(have[f.name], f.dataType, f"{name}.{f.name}" if name else f.name)
            if f.name in have else [f"{name}.{f.name} is missing".lstrip(".")])]
    if isinstance(wanted, T.ArrayType) and isinstance(found, T.ArrayType):
        return _faults(found.elementType, wanted.elementType, f"{name}[]")
    pair = found.simpleString(), wanted.simpleString()
    return [] if pair[0] == pair[1] or pair in WIDENED else [f"{name} is {pair[0]}, not {pair[1]}"]


def check_schema(found: T.StructType, wanted: T.StructType, path: str) -> None:
    """Raise if a required column is missing or mistyped: it would read as NULLs."""
    if faults := _faults(found, wanted, ""):
        raise ValueError(f"{path}: {'; '.join(faults)}")


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType,
                  start: DateLike = None, end: DateLike = None,
                  date_column: str = "partition_date") -> DataFrame:
    """Like :func:`read_table`, but an absent table reads as empty.

    The best-seller tables are only delivered once the report is enabled, so
    the pipeline must still build (with no best-seller rows) without them.
    """
    try:
        return read_table(spark, path, schema, start, end, date_column)
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" not in str(exc) and "Path does not exist" not in str(exc):
            raise
        df = spark.createDataFrame([], schema)
    return restrict_days(df, start, end, date_column)


def _snake(name: str) -> str:
    return re.sub(r"[^0-9a-z]+", "_", name.strip().lower()).strip("_")


def read_csv_dimension(spark: SparkSession, path: str, columns: dict[str, T.DataType]) -> DataFrame:
    """Read a CSV with a header row; header names are normalised to snake case
    (``"Parent ID"`` -> ``parent_id``) and the requested columns are cast."""
    raw = spark.read.option("header", True).option("inferSchema", False).csv(path)
    raw = raw.toDF(*[_snake(c) for c in raw.columns])
    return raw.select([F.col(name).cast(dtype).alias(name) for name, dtype in columns.items()])


def load_language_codes(spark: SparkSession, path: str) -> DataFrame:
    """Language dimension: ``language_name, language_code, criterion_id``."""
    return read_csv_dimension(spark, path, {
        "language_name": T.StringType(),
        "language_code": T.StringType(),
        "criterion_id": T.IntegerType(),
    })


def load_geo_targets(spark: SparkSession, path: str) -> DataFrame:
    """Location dimension; only ``parent_id`` and ``country_code`` are used."""
    return read_csv_dimension(spark, path, {
        "criteria_id": T.LongType(),
        "name": T.StringType(),
        "parent_id": T.LongType(),
        "country_code": T.StringType(),
        "target_type": T.StringType(),
    }).withColumnRenamed("criteria_id", "criterion_id")


@dataclass
class RetailInputs:
    """The eight inputs as DataFrames."""

    products: DataFrame
    price_competitiveness: DataFrame
    price_insights: DataFrame
    shopping_product_stats: DataFrame
    best_sellers_clusters: DataFrame
    best_sellers_mapping: DataFrame
    geo_targets: DataFrame
    language_codes: DataFrame
    # products and both price tables are bucketed by product id (:func:`read_bucketed`)
    bucketed: bool = False
    # into how many partitions product rows are dealt (None: as the session deals)
    partitions: int | None = None


def read_inputs(spark: SparkSession, paths: InputPaths, start: DateLike = None,
                end: DateLike = None, ads_start: DateLike = None,
                geo_csv: str | None = None, language_csv: str | None = None) -> RetailInputs:
    """Read all eight inputs. ``ads_start`` bounds the ad statistics separately
    (the rolling windows need up to 31 days before ``start``)."""
    geo = (load_geo_targets(spark, geo_csv) if geo_csv
           else read_table(spark, paths.path("geo_targets"), schemas.GEO_TARGETS))
    lang = (load_language_codes(spark, language_csv) if language_csv
            else read_table(spark, paths.path("language_codes"), schemas.LANGUAGE_CODES))
    return RetailInputs(
        products=read_table(spark, paths.path("products"), schemas.PRODUCTS, start, end),
        price_competitiveness=read_table(spark, paths.path("price_competitiveness"),
                                         schemas.PRICE_COMPETITIVENESS, start, end),
        price_insights=read_table(spark, paths.path("price_insights"),
                                  schemas.PRICE_INSIGHTS, start, end),
        shopping_product_stats=read_table(spark, paths.path("shopping_product_stats"),
                                          schemas.SHOPPING_PRODUCT_STATS, ads_start, end,
                                          date_column="data_date"),
        best_sellers_clusters=read_or_empty(spark,
                                            paths.path("best_sellers_product_cluster_weekly"),
                                            schemas.BEST_SELLERS_CLUSTERS, start, end),
        best_sellers_mapping=read_or_empty(spark,
                                           paths.path("best_sellers_entity_product_mapping"),
                                           schemas.BEST_SELLERS_MAPPING, start, end),
        geo_targets=geo,
        language_codes=lang,
    )


# The tables that meet on the product, and the column that holds its id.
BUCKETED = {"products": "product_id", "price_competitiveness": "id", "price_insights": "id"}


def write_bucketed(df: DataFrame, table: str, kind: str, buckets: int, mode: str = "overwrite",
                   path: str | None = None) -> None:
    """Write one of the tables of ``BUCKETED`` as a catalog table bucketed by product id and
    partitioned by day. All three need the same number of buckets; a day's product then lies
    in the same bucket of each, so the views join them where they are."""
    column = BUCKETED[kind]
    writer = (df.repartition(buckets, column).write.mode(mode).format("parquet").partitionBy("partition_date")
              .bucketBy(buckets, column))
    (writer.option("path", path) if path else writer).saveAsTable(table)


def read_bucketed(spark: SparkSession, inputs: RetailInputs, names: dict[str, str], start: DateLike = None,
                  end: DateLike = None) -> RetailInputs:
    """``inputs`` with the tables of ``BUCKETED`` read from the catalog tables ``names``.

    Raises ``ValueError`` where their schemas differ from the expected ones or a table is not
    bucketed by product id as the others are.
    """
    wanted = {"products": schemas.PRODUCTS, "price_competitiveness": schemas.PRICE_COMPETITIVENESS,
              "price_insights": schemas.PRICE_INSIGHTS}
    found, layout = {}, set()
    for kind, column in BUCKETED.items():
        table = spark.table(names[kind])
        check_schema(table.schema, wanted[kind], names[kind])
        about = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {names[kind]}").collect()}
        if about.get("Bucket Columns") != f"[`{column}`]":
            raise ValueError(f"{names[kind]} is not bucketed by {column}")
        layout.add(about["Num Buckets"])
        found[kind] = restrict_days(table.select([f.name for f in wanted[kind].fields]), start, end)
    if len(layout) > 1:
        raise ValueError(f"numbers of buckets differ: {sorted(layout)}")
    return replace(inputs, **found, bucketed=True)
