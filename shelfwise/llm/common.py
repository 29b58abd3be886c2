"""Helpers shared by the operators: picking columns, the shared folder, totals in order."""

from __future__ import annotations

import os
import tempfile
import uuid
from pathlib import Path

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Rows of one Arrow batch: texts are long, so a batch holds few of them.
ARROW_ROWS = 512
WORD = r"[^\x20\x09-\x0D]+"


def prepare(spark: SparkSession) -> None:
    """What the operators that run Python in tasks need: small Arrow batches, and this
    package on the workers' path (a cluster that gets it by --py-files has it already)."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    env, root = spark.sparkContext.environment, str(Path(__file__).resolve().parents[2])
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *paths])


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    A folder of our own is set only where that is unset and Spark runs in one
    process (tests); a cluster without the setting is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the cluster shares")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="llm-shared-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a new Parquet table in the shared folder and read it back:
    cuts the lineage, and a lost executor costs no recomputation."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/llm-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def pick(df: DataFrame, *names: str) -> DataFrame:
    """The first column of each exact name, whatever other columns are called
    (columns whose names differ in case only, or repeat, cannot be addressed by name)."""
    prepare(df.sparkSession)
    flat = df.toDF(*(f"c{i}" for i in range(len(df.columns))))
    return flat.select(*(F.col(f"c{df.columns.index(n)}").alias(n) for n in names))


def marked(df: DataFrame) -> tuple[DataFrame, list[str]]:
    """``df`` under positional names ``c0, c1, ...`` and its own names, so that added
    columns clash with none of them; ``unmarked`` undoes it."""
    return df.toDF(*(f"c{i}" for i in range(len(df.columns)))), list(df.columns)


def unmarked(df: DataFrame, names: list[str]) -> DataFrame:
    return df.select(*(f"c{i}" for i in range(len(names)))).toDF(*names)


def at(names: list[str], name: str) -> Column:
    return F.col(f"c{names.index(name)}")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def in_order(df: DataFrame, order: list[Column], totals: dict[str, Column], name: str) -> DataFrame:
    """Add running totals (this row excluded) over all rows in ``order``, exactly and
    without a task that sees all rows.

    Rows are dealt by ranges of the order and stored; each range is summed, the ranges'
    offsets are totalled (one row for each range) and joined back, and each range is
    totalled for itself. Rows that are equal in ``order`` may stand in any order.
    """
    spark = df.sparkSession
    ranged = df.repartitionByRange(partitions(spark), *order).withColumn("__range", F.spark_partition_id())
    ranged = stored(ranged, name)
    sums = ranged.groupBy("__range").agg(*(F.sum(v).alias(f"__{k}") for k, v in totals.items()))
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("__range", *(F.coalesce(F.sum(f"__{k}").over(before), F.lit(0)).alias(f"__{k}")
                                       for k in totals))
    within = Window.partitionBy("__range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    rows = ranged.select("*", *(F.coalesce(F.sum(v).over(within), F.lit(0)).alias(f"__in_{k}")
                                for k, v in totals.items()))
    return rows.join(F.broadcast(offsets), "__range").select(
        *df.columns, *((F.col(f"__in_{k}") + F.col(f"__{k}")).alias(k) for k in totals))


class Marks:
    """A set of longs as a bitmap of fixed size (4 MB, whatever the set holds).

    It says yes to all members and to few others while the set is small against its bits;
    where it is not, it says yes to more and only saves less. Tasks get it by broadcast.
    """

    BITS = 25

    def __init__(self, df: DataFrame, column: str, place: Column | None = None) -> None:
        place = self.place(column) if place is None else place
        rows = df.select(F.shiftright(place, 15).alias("page"), place.bitwiseAND(F.lit(32767)).alias("bit")).groupBy(
            "page").agg(F.bitmap_construct_agg("bit").alias("bits")).collect()
        bits = np.zeros(1 << (self.BITS - 3), np.uint8)
        for r in rows:
            bits[4096 * r["page"]:4096 * (r["page"] + 1)] = np.frombuffer(bytes(r["bits"]), np.uint8)
        self.shared = df.sparkSession.sparkContext.broadcast(bits)

    @staticmethod
    def place(column: str | Column) -> Column:
        return F.pmod(F.xxhash64(column), F.lit(1 << Marks.BITS))

    def have(self, places: np.ndarray) -> np.ndarray:
        return (self.shared.value[places >> 3] >> (places & 7).astype(np.uint8)) & 1 == 1
