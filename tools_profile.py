"""
rows, shuffle bytes written, spill bytes and Exchange/Sort/Window counts of
the physical plan. Stage metrics come from Spark's event log written to a
scratch folder (no UI, no server).

usage: python tools_profile.py SF_DIR [RUNS] [query ...]
"""

from __future__ import annotations

import contextlib
import glob
import io
import json
import re
import statistics
import sys
import tempfile
import time

import zstandard
from pyspark.sql import SparkSession

from shelfwise import catalog
from shelfwise.session import DEFAULT_CONF


def plan_counts(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    tree = buf.getvalue().split("\n\n")[0]
    count = lambda n: len(re.findall(rf"^[ :+|-]*{n}(?: [^(\n]*)? \(\d+\)$", tree, flags=re.M))
    return {"exchange": count("Exchange"), "broadcast": count("BroadcastExchange"),
            "sort": count("Sort"), "window": count("Window")}


def stage_metrics(log_dir):
    out = {}
    for f in glob.glob(f"{log_dir}/*/events_*"):
        with open(f, "rb") as fh:
            raw = fh.read()
            data = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw)).read() if f.endswith(".zstd") else raw
        jobs = {}
        for line in data.decode().splitlines():
            e = json.loads(line)
            if e["Event"] == "SparkListenerJobStart":
                group = e.get("Properties", {}).get("spark.jobGroup.id")
                for sid in e.get("Stage IDs", []):
                    jobs[sid] = group
            if e["Event"] == "SparkListenerStageCompleted":
                si = e["Stage Info"]
                group = jobs.get(si["Stage ID"])
                acc = {a["Name"]: a.get("Value") for a in si.get("Accumulables", [])}
                m = out.setdefault(group, {"shuffle_bytes": 0, "spill_bytes": 0})
                m["shuffle_bytes"] += int(acc.get("internal.metrics.shuffle.write.bytesWritten", 0) or 0)
                m["spill_bytes"] += int(acc.get("internal.metrics.diskBytesSpilled", 0) or 0)
    return out


def main():
    sf_dir = sys.argv[1]
    runs = int(sys.argv[2]) if len(sys.argv) > 2 else 3
    names = sys.argv[3:] or list(catalog.QUERIES)
    log_dir = tempfile.mkdtemp(prefix="shelfwise-evlog-")
    b = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "16")
         .config("spark.driver.memory", "16g").config("spark.eventLog.enabled", "true")
         .config("spark.eventLog.dir", f"file://{log_dir}"))
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    catalog.QUERIES["inventory_view"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    results = {}
    for name in names:
        times = []
        for run in range(runs):
            spark.sparkContext.setJobGroup(f"{name}#{run}", name)
            t0 = time.perf_counter()
            df = catalog.QUERIES[name](spark, sf_dir)
            df.write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - t0)
        spark.sparkContext.setJobGroup(f"{name}#count", name)
        results[name] = {"sec": round(statistics.median(times), 2), "rows": df.count(),
                         **plan_counts(df)}
    spark.stop()
    metrics = stage_metrics(log_dir)
    for name, r in results.items():
        m = metrics.get(f"{name}#0", {})
        r["shuffle_mb"] = round(m.get("shuffle_bytes", 0) / 1e6, 1)
        r["spill_mb"] = round(m.get("spill_bytes", 0) / 1e6, 1)
        print(json.dumps({"query": name, **r}))


if __name__ == "__main__":
    main()
