"""Rolling sums as differences of running totals (WI1-WI10, incremental): equal to the RANGE
frames on random gaps, and kept up to date by the job."""

from __future__ import annotations

import datetime as dt
import os
import random

import pytest
from conftest import D, frame, inputs, product, stat

from shelfwise import jobs, schemas
from shelfwise.operators import performance, running_totals
from shelfwise.sources import readers, tables

FIRST = D(2024, 1, 1)
# Gaps between a key's ad days: within a frame, at its ends, and just beyond (a new start).
GAPS = [1, 1, 2, 5, 7, 8, 9, 29, 30, 31, 32, 33, 40]


def _day(k):
    return FIRST + dt.timedelta(days=k)


def _random_stats(seed, keys=12, last=110):
    rng = random.Random(seed)
    out = []
    for k in range(keys):
        at = rng.randint(0, 6)
        while at <= last:
            for _ in range(rng.choice([1, 1, 2])):
                out.append(stat(
                    _day(at), item=rng.choice([f"SKU{k}", f"SKU{k}", f"sku{k}"]), channel=rng.choice(["ONLINE", "LOCAL"]),
                    clicks=rng.choice([None, 0, 3, 10**12]), impressions=rng.randint(0, 9), cost_micros=rng.choice([None, 1, 333_333]),
                    conversions=rng.choice([None, 0.1, 0.25, 1e-7]), value=rng.choice([0.0, 12.34, 1e9 + 0.01]),
                    latest=rng.choice([D(2024, 8, 1), D(2024, 8, 2)])))
            at += rng.choice(GAPS)
    return out


def _rows(df):
    """Rolling rows as comparable tuples, each once."""
    names = ["date", *performance.PERF_KEYS, *schemas.ROLLING_METRICS]
    return sorted({tuple(round(r[n], 6) if isinstance(r[n], float) else r[n] for n in names) for r in df.collect()}, key=str)


def test_frames_equal_the_range_frames_on_random_gaps(spark):
    i = inputs(spark, stats=_random_stats(7))
    want = _rows(performance.rolling_performance(performance.daily_performance(
        i.shopping_product_stats, i.geo_targets, i.language_codes)))
    totals = running_totals.day_totals(i.shopping_product_stats, i.geo_targets, i.language_codes)
    by_day = {}
    for r in totals.collect():
        by_day.setdefault(r["last_day"], []).append(r)
    states, got, held = {}, [], []
    for k in range(111):
        state = running_totals.next_state(states.get(k - 1), spark.createDataFrame(by_day.get(_day(k), []), totals.schema), _day(k))
        kept = state.collect()
        held.append(len(kept))
        states[k] = spark.createDataFrame(kept, state.schema)
        if _day(k) in by_day:
            got += _rows(running_totals.frames(states[k], states.get(k - 31), states.get(k - 8), _day(k)))
    assert sorted(got, key=str) == want
    assert min(held[40:]) < max(held)  # keys leave the state
    for k in (0, 20, 31, 50, 77, 110):  # a state from all rows is the state of the chain
        again = running_totals.state_of(totals, _day(k)).select(states[k].columns)
        assert sorted(map(str, again.collect())) == sorted(map(str, states[k].collect()))


def test_a_state_needs_no_join(spark):
    from conftest import plan_nodes, plan_text

    i = inputs(spark, stats=[stat(FIRST)])
    totals = running_totals.day_totals(i.shopping_product_stats, i.geo_targets, i.language_codes)
    state = spark.createDataFrame(running_totals.next_state(None, totals, FIRST).collect(), totals.schema)
    again = running_totals.next_state(state, state, FIRST)
    assert plan_nodes(again, "Exchange") == 1 and "Join" not in plan_text(again)
    rolled = running_totals.frames(state, state, state, FIRST)
    assert plan_nodes(rolled, "Exchange") == 1 and "Join" not in plan_text(rolled)


@pytest.fixture()
def config(spark, tmp_dir):
    rng = random.Random(3)
    paths = readers.InputPaths(os.path.join(tmp_dir, "in"))
    stats = [stat(_day(k), item=f"SKU{n}", clicks=rng.randint(0, 5), conversions=0.1) for k in range(36) for n in range(3)
             if rng.random() < 0.7 and k not in (4, 5)]
    i = inputs(spark, stats=stats, products=[product(day=_day(k), pid=f"p{n}", offer=f"Sku{n}") for k in (5, 20, 33, 36) for n in range(3)])
    for name, df, column in [("products", i.products, "partition_date"), ("price_competitiveness", i.price_competitiveness, "partition_date"),
                             ("price_insights", i.price_insights, "partition_date"),
                             ("shopping_product_stats", i.shopping_product_stats, "data_date")]:
        jobs.write_partitioned(df, paths.path(name), partition_column=column)
    for name, df in [("geo_targets", i.geo_targets), ("language_codes", i.language_codes)]:
        df.write.parquet(paths.path(name))
    return jobs.DailyConfig(inputs=paths, output_root=os.path.join(tmp_dir, "out"), running_totals=True)


def _content(spark, cfg):
    def plain(r):
        return str([round(v, 6) if isinstance(v, float) else v for v in r])

    return {t: sorted(map(plain, tables.read(spark, f"{cfg.output_root}/{t}").select(*columns).collect())) for t, columns in (
        (jobs.INVENTORY_TABLE, schemas.INVENTORY_VIEW_COLUMNS), (jobs.PERFORMANCE_TABLE, [
            "date", *performance.SNAPSHOT_JOIN_KEYS[:-1], *schemas.ROLLING_METRICS]))}


def test_the_job_keeps_the_rolling_performance_up_to_date(spark, tmp_dir, config):
    full = jobs.DailyConfig(config.inputs, os.path.join(tmp_dir, "full"))
    jobs.run_changed(spark, config)
    jobs.run_daily(spark, full)
    assert _content(spark, config) == _content(spark, full)
    assert not any(jobs.run_changed(spark, config).values()) and not jobs.run_totals(spark, config)

    late = frame(spark, [stat(_day(33), item="SKU1", clicks=70), stat(_day(33), item="SKU9", clicks=1)], schemas.SHOPPING_PRODUCT_STATS)
    jobs.refresh_window(lambda a, b: late, config.inputs.path("shopping_product_stats"), _day(33), 0, "data_date")
    assert jobs.run_totals(spark, config) == [_day(k) for k in (33, 34, 35)]
    jobs.run_changed(spark, config)
    jobs.run_daily(spark, full)
    assert _content(spark, config) == _content(spark, full)


def test_totals_may_start_late(spark, tmp_dir, config):
    full = jobs.DailyConfig(config.inputs, os.path.join(tmp_dir, "full"))
    jobs.run_daily(spark, full)
    assert jobs.run_totals(spark, config, first=_day(34))[0] == _day(3)
    got = tables.read(spark, f"{config.output_root}/{jobs.PERFORMANCE_TABLE}")
    assert {r["date"] for r in got.collect()} == {_day(35), _day(36)}
    want = [r for r in _content(spark, full)[jobs.PERFORMANCE_TABLE] if str([_day(35)])[1:-1] in r or str([_day(36)])[1:-1] in r]
    columns = ["date", *performance.SNAPSHOT_JOIN_KEYS[:-1], *schemas.ROLLING_METRICS]
    assert sorted(str([round(v, 6) if isinstance(v, float) else v for v in r]) for r in got.select(*columns).collect()) == want
