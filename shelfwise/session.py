"""Session settings shared by tests, the bench and the driver entry points."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

# Settings that matter at any scale: adaptive execution (coalescing, skew
# splitting, runtime broadcast), UTC day boundaries, ANSI semantics.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Broadcast only with a proven bound: static plan estimates are not one
    # (they do not grow through explode), so the planner's size guess is off
    # and broadcasts come from explicit, checked hints or from AQE, which
    # decides on measured shuffle sizes.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "10485760",
    # After a shuffle, join by hash instead of sorting the wide rows when
    # every build-side partition is measured below this size. The measure is of
    # compressed bytes, which can be a tenth of the table that a join then holds
    # and cannot spill; a task holds up to three.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": str(16 * 1024 * 1024),
    # Let a join on (product key + country) reuse a partitioning on the
    # product key instead of re-shuffling the wide side.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings that are safe to change on a running session."""
    for key, value in DEFAULT_CONF.items():
        if key in ("spark.ui.enabled", "spark.ui.showConsoleProgress"):
            continue
        spark.conf.set(key, value)
    return spark


# Rows of the wide tables that a task makes or gathers: with the joins' tables and both maps
# of a DISTINCT, some 400 MB. Bytes of input files (compressed) that hold about as many.
ROWS_PER_TASK = 100_000
FILE_BYTES_PER_TASK = 6 * 1024 * 1024


def partitions_for(spark: SparkSession, tasks: int) -> int | None:
    """How many partitions a shuffle whose rows need ``tasks`` tasks is dealt into, or None where
    the cores are enough: adaptive execution then merges partitions. It goes by compressed bytes,
    which say little about the memory that the rows of a task take."""
    if tasks <= spark.sparkContext.defaultParallelism:
        return None
    return max(tasks, int(spark.conf.get("spark.sql.shuffle.partitions")))


def dealt(df: DataFrame, partitions: int | None, *columns: str) -> DataFrame:
    """``df`` hash partitioned on ``columns``, with a count of partitions or as the session deals."""
    return df.repartition(partitions, *columns) if partitions else df.repartition(*columns)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster that setting names a shared folder and is used as is; a
    cluster without it is an error. Only in local mode (tests) a scratch
    folder is created when it is unset.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster; "
                               "a machine-local folder would not survive a lost executor")
        configured = tempfile.mkdtemp(prefix="shelfwise-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "shelfwise") -> SparkSession:
    """Session for tests and the local bench (``local[cores]``)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("SHELFWISE_DRIVER_MEMORY", "16g"))
    )
    for key, value in DEFAULT_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


# Target bytes per shuffle partition / scan split on a cluster: large enough
# to keep the task count manageable at 100 TB, small enough that a sort or
# hash-join partition fits an executor core's share of memory with room to
# spill.
CLUSTER_PARTITION_BYTES = 256 * 1024 * 1024


def cluster_settings(largest_shuffle_bytes: int, cores: int,
                     partition_bytes: int = CLUSTER_PARTITION_BYTES) -> dict[str, str]:
    """Settings for a cluster run, sized from the largest expected shuffle.

    The largest shuffle of the views is the one of the wide product rows
    (about the size of the products snapshot being rebuilt, uncompressed).
    Shuffle partitions start at ``largest / partition_bytes`` (at least two
    waves of the cluster's cores) and AQE coalesces smaller shuffles to the
    same advisory size; skewed partitions above 4x the median and
    ``partition_bytes`` are split.
    """
    partitions = max(2 * cores, -(-largest_shuffle_bytes // partition_bytes))
    size = str(partition_bytes)
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": size,
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.files.maxPartitionBytes": size,
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": size,
    }
