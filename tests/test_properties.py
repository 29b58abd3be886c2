"""Properties over random ad rows (hypothesis): rolling sums against a
brute-force computation, 30-day >= 7-day sums, and the day-before join."""

from __future__ import annotations

import datetime as dt

from conftest import D, inputs, stat
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from shelfwise.operators import performance

BASE = D(2024, 1, 1)
ads = st.lists(st.tuples(st.integers(0, 60), st.sampled_from(["SKU1", "sku1", "SKU2"]),
                         st.sampled_from(["ONLINE", "LOCAL"]), st.integers(0, 5)),
               min_size=1, max_size=25)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(ads)
def test_rolling_sums_equal_brute_force(spark, rows):
    stats = [stat(BASE + dt.timedelta(days=d), item=item, channel=ch, clicks=c)
             for d, item, ch, c in rows]
    i = inputs(spark, stats=stats)
    daily = performance.daily_performance(i.shopping_product_stats, i.geo_targets, i.language_codes)
    got = {(r["date"], r["channel"], r["offer_id"]): (r["clicks_30days"], r["clicks_7days"])
           for r in performance.rolling_performance(daily).collect()}
    for (day, channel, offer), (c30, c7) in got.items():
        def total(span):
            return sum(c for d, it, ch, c in rows
                       if it == offer and ch.lower() == channel
                       and 0 <= (day - (BASE + dt.timedelta(days=d))).days <= span)
        assert (c30, c7) == (total(30), total(7))
        assert c30 >= c7
