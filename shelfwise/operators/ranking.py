"""Exact positions in an ordered list, without a task that sees a whole list.

Rows are range-partitioned by (group, order) and sorted within their partition, so a group
spans neighbouring partitions and a row's place is

    rows of its group in the partitions before + rows of its group before it in its own.

The first term is a running sum over one row for each (partition, group), the second a
difference of row numbers in the partition. A group of any size, also one that holds all
rows, is spread over as many partitions as its rows need; equal groups or order values do
not gather in one task, because the range bounds are cut from the whole order.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfwise.session import ensure_checkpoint_dir

# monotonically_increasing_id: the partition above these bits, the row number below.
ROW_BITS = 33

# Offsets are broadcast up to this many rows (some megabytes), and joined by shuffle beyond.
MOST_BROADCAST = 100_000


def with_positions(df: DataFrame, group: list[str], order: list[Column], name: str = "position",
                   partitions: int | None = None) -> DataFrame:
    """``df`` with ``name``: 1, 2, ... within each ``group`` under ``order``.

    ``order`` should be total; rows that tie in it get neighbouring positions in any order.
    A NULL group is a group. The ranged rows are written, with their row numbers, to the
    shared folder that ``spark.checkpoint.dir`` names: the counts and the rows must see the
    same partitions, and a lost executor then costs no new ranging. This runs when the frame
    is built; :func:`drop_written` deletes what it left once the frame has been used.
    """
    spark = df.sparkSession
    keys = [F.col(g).asc_nulls_first() for g in group] + order
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
    numbered = _written(ranged.withColumn("__row", F.monotonically_increasing_id()))
    piece = F.shiftright("__row", ROW_BITS)
    pieces = (numbered.groupBy(*group, piece.alias("__piece"))
              .agg(F.count(F.lit(1)).alias("__n"), F.min("__row").alias("__first")))
    before = Window.partitionBy(*group).orderBy("__piece").rowsBetween(Window.unboundedPreceding, -1)
    offsets = _written(pieces.select(
        *[F.col(g).alias(f"__{g}") for g in group], F.col("__piece").alias("__of"),
        (F.coalesce(F.sum("__n").over(before), F.lit(0)) - F.col("__first") + 1).alias("__shift")))
    # One row for each partition and one more for each group that starts inside one.
    if offsets.count() <= MOST_BROADCAST:
        offsets = F.broadcast(offsets)
    same = [piece == F.col("__of")] + [F.col(g).eqNullSafe(F.col(f"__{g}")) for g in group]
    placed = numbered.join(offsets, same)
    return placed.select(*df.columns, (F.col("__row") + F.col("__shift")).alias(name))


_FOLDERS: list[str] = []


def _written(df: DataFrame) -> DataFrame:
    """``df`` as a new table in the shared folder, read back."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/positions-{uuid.uuid4().hex}"
    _FOLDERS.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_written(spark: SparkSession) -> None:
    """Delete the tables behind the positions given so far."""
    while _FOLDERS:
        path = spark._jvm.org.apache.hadoop.fs.Path(_FOLDERS.pop())
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def first_or_all(df: DataFrame, group: list[str], order: list[Column], k: int | None,
                 name: str = "position") -> DataFrame:
    """All rows with their position or, with ``k``, the first ``k`` of each group only:
    Spark cuts those per partition before the shuffle (window group limit)."""
    if k is None:
        return with_positions(df, group, order, name)
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(name, F.row_number().over(w).cast("bigint")).where(F.col(name) <= k)
