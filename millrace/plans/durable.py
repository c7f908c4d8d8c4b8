"""Lineage cuts and written intermediate tables that outlive any single executor.

Everything is placed in the shared folder named by ``spark.checkpoint.dir``. Only a local
session without that setting gets a fresh folder of its own.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_LOCAL_FOLDERS: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    app = context.applicationId
    if app not in _LOCAL_FOLDERS:
        _LOCAL_FOLDERS[app] = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    return _LOCAL_FOLDERS[app]


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that nothing has used yet."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """Compute ``df`` now and cut its lineage with a reliable checkpoint."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)


def staged(df: DataFrame, label: str = "stage", file_rows: int = 0) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Unlike a checkpoint the result is columnar: later reads prune columns, push filters
    and know their size. No file has more than ``file_rows`` rows, if that is set.
    """
    path = fresh_path(df.sparkSession, label)
    df.write.option("maxRecordsPerFile", file_rows).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a query are removed when it ends, not when the driver happens to collect its garbage.

    For chains of written steps, none of which is read again through an older step's shuffle.
    """
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    old = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, old)
