"""Command line for the daily job (what a scheduler calls once a day):

    spark-submit shelfwise/cli.py --input-root s3://bucket/merchant \\
        --merchant-id 123 --ads-customer-id 456 --output-root s3://bucket/views \\
        [--start 2024-05-01 --end 2024-05-07] [--geo-csv ... --language-csv ...]

Without ``--start``/``--end`` both views are rebuilt whole; with them only
those snapshot days are replaced.
"""

from __future__ import annotations

import argparse
import os
import sys

if __package__ in (None, ""):  # run as a file by spark-submit
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from shelfwise.jobs import DailyConfig, register_views, run_daily  # noqa: E402
from shelfwise.sources.readers import InputPaths  # noqa: E402


def parse_args(argv: list[str] | None = None) -> DailyConfig:
    p = argparse.ArgumentParser(prog="shelfwise", description=__doc__.splitlines()[0])
    p.add_argument("--input-root", required=True)
    p.add_argument("--output-root", required=True)
    p.add_argument("--merchant-id", default="")
    p.add_argument("--ads-customer-id", default="")
    p.add_argument("--start")
    p.add_argument("--end")
    p.add_argument("--geo-csv")
    p.add_argument("--language-csv")
    a = p.parse_args(argv)
    # the ad account id may be given with dashes, as it is usually displayed
    ads_id = a.ads_customer_id.replace("-", "")
    return DailyConfig(inputs=InputPaths(a.input_root, a.merchant_id, ads_id),
                       output_root=a.output_root, start=a.start, end=a.end,
                       geo_csv=a.geo_csv, language_csv=a.language_csv)


def main(argv: list[str] | None = None) -> None:
    from pyspark.sql import SparkSession

    from shelfwise.session import configure

    cfg = parse_args(argv)
    spark = configure(SparkSession.builder.appName("shelfwise-daily").getOrCreate())
    run_daily(spark, cfg)
    register_views(spark, cfg.output_root)


if __name__ == "__main__":
    main()
