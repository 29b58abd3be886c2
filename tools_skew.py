"""Skew check: run the inventory view with a third of all events moved to one
user (so one offer/merchant/country key holds a third of the ad rows) and
print, per multi-task stage, the median and maximum task time from Spark's
event log (written to a scratch folder; no UI).

usage: python tools_skew.py SF_DIR
"""

from __future__ import annotations

import glob
import io
import json
import statistics
import sys
import tempfile
import time

import zstandard
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from shelfwise.session import DEFAULT_CONF
from shelfwise.sources import tpch_retail


def main(sf_dir: str) -> None:
    log_dir = tempfile.mkdtemp(prefix="shelfwise-skew-")
    b = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "16")
         .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", f"file://{log_dir}")
         .config("spark.driver.memory", "16g"))
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")

    plain_read = tpch_retail._read

    def skewed_read(session, folder, name):
        df = plain_read(session, folder, name)
        if name == "events":
            df = df.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(0))
                               .otherwise(F.col("user_id")))
        return df

    tpch_retail._read = skewed_read
    from shelfwise import catalog

    catalog.q_inventory_view(spark, sf_dir).write.format("noop").mode("overwrite").save()
    spark.sparkContext.setJobGroup("skew", "skew")
    t0 = time.time()
    catalog.q_inventory_view(spark, sf_dir).write.format("noop").mode("overwrite").save()
    print("inventory_view wall seconds", round(time.time() - t0, 2))
    spark.stop()

    tasks, stage_job, names = {}, {}, {}
    for fn in glob.glob(f"{log_dir}/*/events_*"):
        raw = open(fn, "rb").read()
        data = (zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw)).read()
                if fn.endswith(".zstd") else raw)
        for line in data.decode().splitlines():
            e = json.loads(line)
            if e["Event"] == "SparkListenerJobStart":
                for sid in e["Stage IDs"]:
                    stage_job[sid] = e.get("Properties", {}).get("spark.jobGroup.id")
            elif e["Event"] == "SparkListenerTaskEnd" and e.get("Task Info"):
                ti = e["Task Info"]
                tasks.setdefault(e["Stage ID"], []).append((ti["Finish Time"] - ti["Launch Time"]) / 1000)
            elif e["Event"] == "SparkListenerStageCompleted":
                si = e["Stage Info"]
                scopes = {json.loads(r.get("Scope", "{}") or "{}").get("name", "") for r in si["RDD Info"]}
                names[si["Stage ID"]] = ",".join(sorted(scopes - {""}))[:80]
    for sid in sorted(tasks):
        t = tasks[sid]
        if stage_job.get(sid) == "skew" and len(t) >= 4:
            print(f"stage {sid:4d} tasks {len(t):3d} median {statistics.median(t):5.2f}s "
                  f"max {max(t):5.2f}s  {names.get(sid, '')}")


if __name__ == "__main__":
    main(sys.argv[1])
