"""shelfwise: retail pricing and demand views built as Spark DataFrame plans.

Layout
------
sources/    readers for the eight inputs (and an adapter that derives them
            from the benchmark tables used by the checks)
functions/  column expressions shared by the operators
operators/  reusable building blocks: dimensions, ad performance, country status
plans/      the two materialised views and the marts read by the dashboard
jobs.py     sinks: partitioned overwrite, snapshot ingest, refresh, backfill
"""

__version__ = "0.1.0"
