"""Broadcast hints that are given only after a look at the size."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F

BROADCAST_LIMIT = 32 * 1024 * 1024
PARTITION_BYTES = 256 * 1024 * 1024
UNKNOWN = 1 << 62


def planned_bytes(df: DataFrame) -> int:
    """Upper bound for the size of ``df`` from the optimizer's statistics."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def input_bytes(df: DataFrame) -> int:
    """Total size of the files and tables that ``df`` reads; inputs of unknown size count as 0."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    return sum(s for s in sizes if s < UNKNOWN)


def shuffle_partitions(df: DataFrame, per_partition: int = PARTITION_BYTES) -> int:
    """The configured number of shuffle partitions, or more when the input is too big for it."""
    configured = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(configured, -(-input_bytes(df) // per_partition))


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_LIMIT) -> DataFrame:
    """Hint a broadcast when the size is known to be within ``limit``.

    Otherwise the frame is returned as it is, so the join shuffles and adaptive
    execution may still switch to a broadcast once the real size is known.
    """
    return F.broadcast(df) if planned_bytes(df) <= limit else df


def scan_tasks(df: DataFrame) -> int | None:
    """Number of tasks that read the inputs of ``df``, without compiling or running what lies above them.

    None when an input is neither a set of files nor a local or checkpointed table, so that nothing is known.
    """
    leaves = df._jdf.queryExecution().sparkPlan().collectLeaves()
    total = 0
    for leaf in (leaves.apply(i) for i in range(leaves.size())):
        kind = leaf.getClass().getSimpleName()
        if kind in ("FileSourceScanExec", "BatchScanExec"):
            total += leaf.inputRDD().getNumPartitions()
        elif kind in ("LocalTableScanExec", "RDDScanExec", "RangeExec"):
            total += leaf.execute().getNumPartitions()
        else:
            return None
    return total


@contextmanager
def scans_of_files(spark: SparkSession, files: int) -> Iterator[None]:
    """Lets a scan have as many tasks as there are files to read, when these are more than the cores."""
    key = "spark.sql.files.minPartitionNum"
    old = spark.conf.get(key, None)
    if files > max(spark.sparkContext.defaultParallelism, int(old or 0)):
        spark.conf.set(key, str(files))
    try:
        yield
    finally:
        if old is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, old)


def balanced(df: DataFrame) -> DataFrame:
    """Spread the rows when the inputs are read by fewer tasks than there are cores.

    For work that is heavy per row (text, vectors, model fits) on a few big files. Inputs that
    already fill the cluster are left alone, so large ones are never shuffled for this. Only the
    scans are looked at: no job is started.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    tasks = scan_tasks(df)
    return df if tasks is None or tasks >= cores else df.repartition(cores)
