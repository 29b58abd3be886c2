"""Jobs and sinks: daily rebuild of both views, incremental rebuild, snapshot
ingestion with a refresh window, and backfill.

Writes are date-partitioned Parquet whose days are replaced in one switch, so a run
that stops leaves the whole old table. A full rebuild replaces the whole table (the views
are rebuilt whole every day); the incremental rebuild and the snapshot ingestion replace the
days asked for, also those that have become empty, so a rerun of the same days is idempotent
and a lost executor only costs task retries. ``run_changed`` finds the days itself: each
written day remembers the input days it was built from.

The shared ad-performance sub-pipeline is written once per run as a table under
the output root, and both views read it.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import json
from collections.abc import Callable
from dataclasses import dataclass, replace
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.operators import performance, ranking, running_totals
from shelfwise.plans import best_sellers, inventory, popularity, pricing
from shelfwise.session import FILE_BYTES_PER_TASK, partitions_for
from shelfwise.sources import tables
from shelfwise.sources.readers import (
    InputPaths,
    RetailInputs,
    as_day,
    load_geo_targets,
    load_language_codes,
    read_inputs,
    restrict_days,
)

# The snapshot of day D joins the ad performance of day D-1, whose 30-day
# frame starts 30 days earlier: D-31 ... D-1.
AD_LOOKBACK_DAYS = performance.LONG_WINDOW_DAYS + 1

PERFORMANCE_TABLE = "RollingPerformance"
INVENTORY_TABLE = "InventoryView"
BEST_SELLERS_TABLE = "BestSellerWeeklyProductView"


# ------------------------------------------------------------------ sinks

def write_partitioned(df: DataFrame | list[DataFrame], path: str, replace_all: bool = True,
                      partition_column: str = "date", days: list[dt.date] | None = None,
                      start: dt.date | None = None, end: dt.date | None = None,
                      built_from: dict[str, str] | None = None) -> None:
    """SK1/SK2: write ``df`` (or a list, one frame after the other) partitioned by day and replace
    the table's days in one switch.

    ``replace_all=True`` also drops the days that ``df`` no longer has; otherwise only those
    of ``days``, and of the range ``start .. end`` (one bound is enough), that it does not
    have. A run that stops at any point leaves the whole old table or the whole new one
    (:mod:`shelfwise.sources.tables`).
    """
    tables.replace_days(df, path, partition_column, replace_all, days, start, end, built_from)


def _days(start: dt.date, end: dt.date) -> list[dt.date]:
    return [start + dt.timedelta(days=i) for i in range((end - start).days + 1)]


def load_dimension(spark: SparkSession, csv_path: str, table_path: str, kind: str) -> None:
    """SK3: load a CSV dimension (``"geo_targets"`` or ``"language_codes"``)
    into a Parquet table, replacing it (a rerun does not double the rows)."""
    loaders = {"geo_targets": load_geo_targets, "language_codes": load_language_codes}
    loaders[kind](spark, csv_path).write.mode("overwrite").parquet(table_path)


def ingest_snapshot(df: DataFrame, path: str, day, partition_column: str = "partition_date") -> None:
    """SK5: store one day's export as the partition ``day`` (replacing it)."""
    rows = df.withColumn(partition_column, F.lit(as_day(day)))
    write_partitioned(rows, path, replace_all=False, partition_column=partition_column,
                      days=[as_day(day)])


def _replace_days(rows: DataFrame, path: str, start: dt.date, end: dt.date,
                  partition_column: str) -> None:
    """Replace the days ``start .. end``; timestamps are truncated to their day."""
    rows = rows.withColumn(partition_column, F.col(partition_column).cast("date"))
    write_partitioned(restrict_days(rows, start, end, partition_column), path, replace_all=False,
                      partition_column=partition_column, days=_days(start, end))


def refresh_window(export: Callable[[dt.date, dt.date], DataFrame], path: str, day,
                   window_days: int, partition_column: str = "partition_date") -> None:
    """SK6: re-ingest the trailing ``window_days`` days and ``day`` itself.

    ``export(start, end)`` returns the source rows of those days with their
    day in ``partition_column``; all days are written by one job.
    """
    end = as_day(day)
    start = end - dt.timedelta(days=window_days)
    _replace_days(export(start, end), path, start, end, partition_column)


def backfill(export: Callable[[dt.date, dt.date], DataFrame], path: str, day,
             days: int = 30, partition_column: str = "partition_date") -> None:
    """SK7: ingest the ``days`` whole days before ``day`` in one job."""
    end = as_day(day) - dt.timedelta(days=1)
    start = end - dt.timedelta(days=days - 1)
    _replace_days(export(start, end), path, start, end, partition_column)


# ------------------------------------------------------------------- jobs

def write_performance(inputs: RetailInputs, path: str, replace_all: bool, start: dt.date | None = None,
                      end: dt.date | None = None, days: list[dt.date] | None = None,
                      built_from: dict[str, str] | None = None) -> None:
    """Write the rolling performance keyed for the product join, partitioned by snapshot day.

    Only the snapshot days asked for are written: those outside them would lack the ad days
    of their frames, which an incremental run does not read.
    """
    rolling = restrict_days(inventory.rolling_for_join(inputs), start, end, "date")
    if days is not None:
        rolling = rolling.where(F.col("date").isin(days))
    write_partitioned(rolling, path, replace_all, days=days, start=start, end=end, built_from=built_from)


def read_performance(inputs: RetailInputs, path: str) -> DataFrame:
    """The written rolling performance (empty where no ad day has been delivered yet)."""
    schema = inventory.rolling_for_join(inputs).schema
    spark = inputs.products.sparkSession
    found = tables.manifest(spark, path)
    return tables.read_days(spark, path, found, schema) if found else spark.createDataFrame([], schema)


def incremental_inputs(inputs: RetailInputs, start, end) -> RetailInputs:
    """Inputs needed to rebuild snapshot days ``start .. end`` only: those
    days of the daily tables and ad days ``start - 31 .. end - 1``."""
    start, end = as_day(start), as_day(end)
    ads_start = start - dt.timedelta(days=AD_LOOKBACK_DAYS)
    ads_end = end - dt.timedelta(days=1)
    return RetailInputs(
        products=restrict_days(inputs.products, start, end),
        price_competitiveness=restrict_days(inputs.price_competitiveness, start, end),
        price_insights=restrict_days(inputs.price_insights, start, end),
        shopping_product_stats=restrict_days(inputs.shopping_product_stats, ads_start, ads_end,
                                             "data_date"),
        best_sellers_clusters=restrict_days(inputs.best_sellers_clusters, start, end),
        best_sellers_mapping=restrict_days(inputs.best_sellers_mapping, start, end),
        geo_targets=inputs.geo_targets,
        language_codes=inputs.language_codes,
    )


def incremental_inventory_view(inputs: RetailInputs, start, end) -> DataFrame:
    """Inventory rows of snapshot days ``start .. end``, equal to the full
    rebuild's rows of those days."""
    return inventory.inventory_view(incremental_inputs(inputs, start, end))


@dataclass
class DailyConfig:
    """Where to read and write. ``start``/``end`` bound the snapshot days
    (``None`` = all, the full rebuild)."""

    inputs: InputPaths
    output_root: str
    start: str | None = None
    end: str | None = None
    geo_csv: str | None = None
    language_csv: str | None = None
    # run_changed: rolling sums from running totals instead of 31 days of ad rows a day
    running_totals: bool = False
    # Input (file bytes) of the days of a view that are built at a time. A build shuffles some ten
    # times that, and its shuffle files go before the next one starts.
    batch_bytes: int = 512 * 1024 * 1024


def run_daily(spark: SparkSession, cfg: DailyConfig) -> None:
    """SK4: build and write both views (inventory first, then best sellers).

    Without a day range both tables are replaced whole; with one, or one bound, only those
    days are replaced, also where they have become empty, and the ad statistics are read
    from 31 days earlier.
    """
    start, end = as_day(cfg.start), as_day(cfg.end)
    ads_start = None if start is None else start - dt.timedelta(days=AD_LOOKBACK_DAYS)
    inputs = read_inputs(spark, cfg.inputs, start, end, ads_start=ads_start,
                         geo_csv=cfg.geo_csv, language_csv=cfg.language_csv)
    span = {"replace_all": start is None and end is None, "start": start, "end": end}
    noted = {table: {d: x for d, x in days.items() if _within(d, start, end)}
             for table, days in lineage(spark, cfg).items()}
    root = cfg.output_root.rstrip("/")
    write_performance(inputs, f"{root}/{PERFORMANCE_TABLE}", **span, built_from=noted[PERFORMANCE_TABLE])
    rolling = restrict_days(read_performance(inputs, f"{root}/{PERFORMANCE_TABLE}"), start, end, "date")
    for table in VIEWS:
        write_partitioned(_in_batches(spark, cfg, table, inputs, rolling), f"{root}/{table}", **span,
                          built_from=noted[table])


VIEWS = {INVENTORY_TABLE: inventory.inventory_view, BEST_SELLERS_TABLE: best_sellers.best_sellers_view}


def batches(spark: SparkSession, cfg: DailyConfig, table: str,
            days: list[dt.date] | None = None) -> list[tuple[dt.date | None, int]]:
    """The batches in which a view's days are built, each by the day where it starts (None: open
    below) and the bytes of its input, below ``cfg.batch_bytes`` or one day's. ``days`` are those
    built, by default all within the bounds of ``cfg``."""
    sizes = [tables.day_bytes(spark, cfg.inputs.path(n), "partition_date") for n in SAME_DAY_INPUTS[table]]
    start, end = as_day(cfg.start), as_day(cfg.end)
    wanted = {d for d in sizes[0] if d[:1].isdigit() and _within(d, start, end)}
    if days is not None:
        wanted &= {d.isoformat() for d in days}
    found: list[tuple[dt.date | None, int]] = [(None, 0)]
    for day in sorted(wanted):
        size, (begin, held) = sum(x.get(day, 0) for x in sizes), found[-1]
        if held and held + size > cfg.batch_bytes:
            found.append((dt.date.fromisoformat(day), size))
        else:
            found[-1] = begin, held + size
    return found


def _in_batches(spark: SparkSession, cfg: DailyConfig, table: str, inputs: RetailInputs, rolling: DataFrame,
                days: list[dt.date] | None = None) -> list[DataFrame]:
    """A view as frames of some days each: a day of it reads that day of its inputs only. The
    batches leave out nothing: the first one is open below and has the rows without a day, the
    last one is open above."""
    found = batches(spark, cfg, table, days)

    def of(df: DataFrame, column: str, start: dt.date | None, end: dt.date | None) -> DataFrame:
        if start is not None:
            df = df.where(F.col(column) >= F.lit(start))
        if end is not None:
            before = F.col(column) < F.lit(end)
            df = df.where(before if start is not None else before | F.col(column).isNull())
        return df

    frames = []
    for (start, size), end in zip(found, [*(s for s, _ in found[1:]), None], strict=True):
        daily = {n: of(getattr(inputs, n), "partition_date", start, end) for n in DAILY_INPUTS}
        partitions = partitions_for(spark, -(-size // FILE_BYTES_PER_TASK))
        frames.append(VIEWS[table](replace(inputs, **daily, partitions=partitions), of(rolling, "date", start, end)))
    return frames


# ------------------------------------------------------- what a change affects

# The daily inputs whose day D a table's day D reads, besides the ad days D-31 ... D-1.
# The first one says which days the table has.
SAME_DAY_INPUTS = {
    INVENTORY_TABLE: ("products", "price_competitiveness", "price_insights"),
    BEST_SELLERS_TABLE: ("best_sellers_product_cluster_weekly", "best_sellers_entity_product_mapping",
                         "products", "price_competitiveness"),
}
# The inputs of which a view's day reads that day.
DAILY_INPUTS = ("products", "price_competitiveness", "price_insights", "best_sellers_clusters", "best_sellers_mapping")
# Raise it when a view's definition changes: all days are then built anew.
DEFINITION = 1


def _within(day: str, start: dt.date | None, end: dt.date | None) -> bool:
    return (start is None or start.isoformat() <= day) and (end is None or day <= end.isoformat())


def lineage(spark: SparkSession, cfg: DailyConfig) -> dict[str, dict[str, str]]:
    """For each written table and day, a digest of the input days it is built from: the map
    along which a change of an input day reaches the days that must be built again. A change
    of ad day A reaches the snapshots A+1 ... A+31, one of a product day that day only, and
    one of a dimension all days."""
    def states(name: str) -> dict[str, str]:
        column = "data_date" if name == "shopping_product_stats" else "partition_date"
        return tables.day_states(spark, cfg.inputs.path(name), column)

    names = {n for of in SAME_DAY_INPUTS.values() for n in of}
    daily = {n: states(n) for n in names}
    ads = states("shopping_product_stats")
    dims = [tables.state(spark, path or cfg.inputs.path(name)) for name, path in (
        ("geo_targets", cfg.geo_csv), ("language_codes", cfg.language_csv))]

    def digest(day: str, inputs: tuple[str, ...]) -> str:
        first = dt.date.fromisoformat(day)
        before = [(first - dt.timedelta(days=k)).isoformat() for k in range(1, AD_LOOKBACK_DAYS + 1)]
        read = [DEFINITION, dims, [daily[n].get(day) for n in inputs], [ads.get(d) for d in before]]
        return hashlib.sha1(json.dumps(read).encode()).hexdigest()

    def real(days) -> list[str]:  # rows without a day are in no view
        return [d for d in days if d[:1].isdigit()]

    found = {table: {d: digest(d, inputs) for d in real(daily[inputs[0]])} for table, inputs in SAME_DAY_INPUTS.items()}
    after = {(dt.date.fromisoformat(d) + dt.timedelta(days=1)).isoformat() for d in real(ads)}
    return {PERFORMANCE_TABLE: {d: digest(d, ()) for d in after}} | found


def changed_days(spark: SparkSession, cfg: DailyConfig) -> dict[str, list[dt.date]]:
    """The days of each written table that are not built from the inputs as they are now:
    missing ones, those that a change reaches, and those whose input day is gone."""
    out = {}
    for table, wanted in lineage(spark, cfg).items():
        found = tables.manifest(spark, f"{cfg.output_root.rstrip('/')}/{table}")
        have = {d: x.built_from for d, x in found.days.items()} if found else {}
        out[table] = sorted(dt.date.fromisoformat(d) for d in set(wanted) | {h for h in have if h[:1].isdigit()}
                            if wanted.get(d) != have.get(d) or d not in wanted)
    return out


def inputs_of_days(inputs: RetailInputs, days: list[dt.date]) -> RetailInputs:
    """Inputs needed to rebuild just ``days``, which need not be neighbours."""
    ads = sorted({d - dt.timedelta(days=k) for d in days for k in range(1, AD_LOOKBACK_DAYS + 1)})

    def of(df: DataFrame, column: str = "partition_date", wanted: list[dt.date] = days) -> DataFrame:
        return df.where(F.col(column).isin(wanted))

    return replace(
        inputs, products=of(inputs.products), price_competitiveness=of(inputs.price_competitiveness),
        price_insights=of(inputs.price_insights),
        shopping_product_stats=of(inputs.shopping_product_stats, "data_date", ads),
        best_sellers_clusters=of(inputs.best_sellers_clusters), best_sellers_mapping=of(inputs.best_sellers_mapping))


def run_changed(spark: SparkSession, cfg: DailyConfig) -> dict[str, list[dt.date]]:
    """SK4, SK6, SK7: bring the written tables up to date with the inputs, rebuilding just the
    days that a change reaches, and return those days by table.

    What a day was built from is switched together with its rows, so this is also the restart
    of a job that stopped: tables and days that it had finished are not built again. The
    result equals a full rebuild. ``start`` and ``end`` of ``cfg`` bound the days looked at.
    """
    root = cfg.output_root.rstrip("/")
    if not tables.day_states(spark, cfg.inputs.path("products"), "partition_date"):
        raise ValueError(f"{cfg.inputs.path('products')} has no days: changes are told apart by day folders")
    wanted = lineage(spark, cfg)
    start, end = as_day(cfg.start), as_day(cfg.end)
    stale = {t: [d for d in days if _within(d.isoformat(), start, end)] for t, days in changed_days(spark, cfg).items()}
    rebuilt = {}
    for table, days in stale.items():
        rebuilt[table] = days
        if not days:
            continue
        if table == PERFORMANCE_TABLE and cfg.running_totals:
            run_totals(spark, cfg, days)
            continue
        noted = {d.isoformat(): wanted[table][d.isoformat()] for d in days if d.isoformat() in wanted[table]}
        inputs = inputs_of_days(
            read_inputs(spark, cfg.inputs, days[0], days[-1], ads_start=days[0] - dt.timedelta(days=AD_LOOKBACK_DAYS),
                        geo_csv=cfg.geo_csv, language_csv=cfg.language_csv), days)
        if table == PERFORMANCE_TABLE:
            write_performance(inputs, f"{root}/{table}", False, days=days, built_from=noted)
            continue
        rolling = read_performance(inputs, f"{root}/{PERFORMANCE_TABLE}").where(F.col("date").isin(days))
        write_partitioned(_in_batches(spark, cfg, table, inputs, rolling, days), f"{root}/{table}", False,
                          days=days, built_from=noted)
    return rebuilt


# ---------------------------------------------------------- running totals

TOTALS_TABLE = "RunningTotals"


def totals_lineage(spark: SparkSession, cfg: DailyConfig) -> dict[dt.date, str]:
    """For each calendar day from the first ad day to the last a digest of all ad days up to
    it: a state adds to the one before, so a change reaches every later state."""
    ads = {dt.date.fromisoformat(d): x for d, x in tables.day_states(
        spark, cfg.inputs.path("shopping_product_stats"), "data_date").items() if d[:1].isdigit()}
    dims = [tables.state(spark, path or cfg.inputs.path(name)) for name, path in (
        ("geo_targets", cfg.geo_csv), ("language_codes", cfg.language_csv))]
    out, digest = {}, json.dumps([DEFINITION, dims])
    for day in _days(min(ads), max(ads)) if ads else []:
        digest = hashlib.sha1(f"{digest} {ads.get(day)}".encode()).hexdigest()
        out[day] = digest
    return out


def run_totals(spark: SparkSession, cfg: DailyConfig, snapshots: list[dt.date] | None = None,
               first: dt.date | None = None) -> list[dt.date]:
    """WI1-WI10, incremental: bring the running totals up to date, day by day, and write the
    rolling performance of ``snapshots`` (by default of all days whose totals are new).

    Each new day reads its own ad rows and three days of totals, whatever the frames' length.
    A table of totals may start at ``first``: its first state is then summed from all ad rows
    up to 31 days before, and the performance of earlier snapshots is not written. Days that
    are done are not done again; what is left of a run that stopped is done by the next one.
    """
    root = cfg.output_root.rstrip("/")
    path, wanted = f"{root}/{TOTALS_TABLE}", totals_lineage(spark, cfg)
    found = tables.manifest(spark, path)
    have = {dt.date.fromisoformat(d): x.built_from for d, x in found.days.items()} if found else {}
    begin = min([*have, *([first - dt.timedelta(days=AD_LOOKBACK_DAYS)] if first and not have else [])], default=None)
    stale = [d for d, x in wanted.items() if have.get(d) != x and (begin is None or d >= begin)]
    performance_of = lineage(spark, cfg)[PERFORMANCE_TABLE]
    schema = None

    def state(day: dt.date) -> DataFrame | None:
        now = tables.manifest(spark, path)
        if now is None or day.isoformat() not in now.days:
            return None
        return tables.read_days(spark, path, now, schema, day, day).drop("date")

    def ads(start: dt.date | None, end: dt.date) -> DataFrame:
        inputs = read_inputs(spark, cfg.inputs, end, end, ads_start=start, geo_csv=cfg.geo_csv, language_csv=cfg.language_csv)
        return running_totals.day_totals(inputs.shopping_product_stats, inputs.geo_targets, inputs.language_codes)

    for day in stale:
        before = state(day - dt.timedelta(days=1)) if schema else None
        if schema is None:
            totals = ads(day, day)
            schema = T.StructType([*totals.schema.fields, T.StructField("date", T.DateType())])
            before = state(day - dt.timedelta(days=1))
        if before is None and day != min(wanted):
            new = running_totals.state_of(ads(None, day), day)
        else:
            new = running_totals.next_state(before, ads(day, day), day)
        write_partitioned(new.withColumn("date", F.lit(day)), path, False, days=[day],
                          built_from={day.isoformat(): wanted[day]})
        after = day + dt.timedelta(days=1)
        noted = performance_of.get(after.isoformat())
        in_frames = begin is None or begin <= min(wanted) or day >= begin + dt.timedelta(days=AD_LOOKBACK_DAYS)
        if noted is None or not in_frames or (snapshots is not None and after not in snapshots):
            continue
        rolling = running_totals.snapshot_performance(
            state(day), state(day - dt.timedelta(days=performance.LONG_WINDOW_DAYS + 1)),
            state(day - dt.timedelta(days=performance.SHORT_WINDOW_DAYS + 1)), day)
        write_partitioned(rolling, f"{root}/{PERFORMANCE_TABLE}", False, days=[after],
                          built_from={after.isoformat(): noted})
    return stale


# ------------------------------------------------------------------- marts

MARTS = {
    INVENTORY_TABLE: {
        "price_benchmark": pricing.price_benchmark,
        "price_benchmark_disapproved": partial(pricing.price_benchmark, disapproved_only=True),
        "price_benchmark_summary": pricing.price_benchmark_summary,
        "benchmark_breakdown": pricing.benchmark_breakdown,
        "benchmark_drill": pricing.benchmark_drill,
        "focus_brands": partial(pricing.focus_brands, ranked=True),
        "reactivation_list": partial(pricing.reactivation_list, ranked=True),
        "price_suggestion": partial(pricing.price_suggestion, ranked=True),
        "price_suggestion_disapproved": partial(pricing.price_suggestion, disapproved_only=True, ranked=True),
    },
    BEST_SELLERS_TABLE: {
        "best_sellers_overview": popularity.best_sellers_overview,
        "best_sellers_details": popularity.best_sellers_details,
        "restock_list": partial(popularity.restock_list, ranked=True),
        "cluster_gtins": popularity.cluster_gtins,
    },
}


def newest_day(spark: SparkSession, path: str) -> dt.date | None:
    """The newest day of a written table, from its list of days (no scan)."""
    days = [d for d in tables.day_states(spark, path, "date") if d[:1].isdigit()]
    return dt.date.fromisoformat(max(days)) if days else None


def build_marts(spark: SparkSession, output_root: str, date="latest") -> None:
    """Build every mart from the written views (no view is computed again) and write it
    partitioned by day: by default for each view's newest day, which replaces that day of the
    marts; a date builds that day, and ``None`` all days, replacing the marts whole."""
    root = output_root.rstrip("/")
    for table, marts in MARTS.items():
        newest = newest_day(spark, f"{root}/{table}")
        if newest is None:
            continue
        view = tables.read(spark, f"{root}/{table}")
        day = newest if date == "latest" else as_day(date)
        for name, mart in marts.items():
            write_partitioned(mart(view, day), f"{root}/marts/{name}", replace_all=day is None,
                              days=None if day is None else [day])
            ranking.drop_written(spark)


def register_views(spark: SparkSession, output_root: str) -> None:
    """Expose the written views to SQL as ``InventoryView`` and
    ``BestSellerWeeklyProductView`` (temporary views over the tables)."""
    root = output_root.rstrip("/")
    for name in (INVENTORY_TABLE, BEST_SELLERS_TABLE):
        tables.read(spark, f"{root}/{name}").createOrReplaceTempView(name)
