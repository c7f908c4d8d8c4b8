"""File streams that are run slice by slice, and sinks keyed by batch.

A slice is whatever arrived since the last run. Each run uses ``availableNow`` on the same
checkpoint, so every further slice is also a restart. Results are never gathered on the
driver: each batch writes its own folder, and writing a batch twice replaces it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import IntegerType, StructType

from millrace.plans.durable import fresh_path


def file_stream(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """New Parquet files of a folder as rows."""
    return spark.readStream.schema(schema).parquet(path)


@contextmanager
def _local_state_partitions(spark: SparkSession):
    """A local run needs no more state partitions than cores; a cluster keeps its setting."""
    key = "spark.sql.shuffle.partitions"
    old = spark.conf.get(key)
    cores = spark.sparkContext.defaultParallelism
    if spark.sparkContext.master.startswith("local") and int(old) > cores:
        spark.conf.set(key, str(cores))
    try:
        yield
    finally:
        spark.conf.set(key, old)


class BatchTable:
    """A folder of batches. ``write`` is idempotent, ``read`` returns all batches with their number.

    Given the folder of an earlier run, it goes on with what is there.
    """

    def __init__(self, spark: SparkSession, label: str, folder: str | None = None):
        self.spark, self.path = spark, f"{folder}/{label}" if folder else fresh_path(spark, label)
        self.schema = self._stored() if folder else None

    def _stored(self) -> StructType | None:
        """The schema of the batches that an earlier run has written."""
        try:
            found = self.spark.read.parquet(self.path).schema
        except AnalysisException as e:
            if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                return None
            raise
        return StructType([f for f in found.fields if f.name != "batch"])

    def write(self, df: DataFrame, batch: int) -> None:
        self.schema = df.schema
        df.write.mode("overwrite").parquet(f"{self.path}/batch={batch}")

    def read(self, before: int | None = None) -> DataFrame | None:
        """Everything written, or what was written before a batch; None when there is nothing."""
        if self.schema is None:
            return None
        whole = self.spark.read.schema(StructType(self.schema.fields).add("batch", IntegerType())).parquet(self.path)
        return whole if before is None else whole.where(F.col("batch") < before)

    def only(self, batch: int) -> DataFrame | None:
        """What one batch wrote, without its number."""
        whole = self.read()
        return None if whole is None or batch < 0 else whole.where(F.col("batch") == batch).drop("batch")

    def latest(self, keys: Iterable[str]) -> DataFrame:
        """The newest row of every key."""
        keys = list(keys)
        df = self.read()
        values = [c for c in df.columns if c not in keys and c != "batch"]
        newest = df.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch").alias("_v"))
        return newest.select(*keys, "_v.*")


class Replay:
    """Feeds one or more inputs in slices to a streaming query.

    With a ``folder`` the inputs and the checkpoint lie there, and a later run on it, begun at slice ``first``,
    goes on where the last one stopped. ``progress`` receives what Spark reports of every batch that had rows.
    """

    def __init__(self, spark: SparkSession, inputs: dict[str, DataFrame], slice_column: str = "slice", slices: int = 3,
                 folder: str | None = None, first: int = 0, progress: list | None = None):
        self.spark, self.inputs, self.slice_column, self.slices = spark, inputs, slice_column, slices
        self.progress = progress
        self.root, self.first = f"{folder}/stream" if folder else fresh_path(spark, "stream"), first

    def stream(self, name: str) -> DataFrame:
        return file_stream(self.spark, f"{self.root}/in-{name}", self.inputs[name].schema)

    def run(self, build: Callable[..., DataFrame], each: Callable[[DataFrame, int], None], mode: str = "append") -> None:
        """Push every slice and let the query catch up after each.

        ``build`` makes the streaming result from the input streams, ``each`` handles a batch.
        """
        for s in range(self.first, self.slices):
            for name, df in self.inputs.items():
                df.where(F.col(self.slice_column) == s).write.mode("append").parquet(f"{self.root}/in-{name}")
            with _local_state_partitions(self.spark):
                built = build(*[self.stream(n) for n in self.inputs])
                query = (built.writeStream.outputMode(mode).option("checkpointLocation", f"{self.root}/checkpoint")
                         .trigger(availableNow=True).foreachBatch(each).start())
                query.awaitTermination()
                if self.progress is not None:
                    self.progress += [p for p in query.recentProgress if p["numInputRows"]]


def updates(spark: SparkSession, inputs: dict[str, DataFrame], build: Callable[..., DataFrame], keys: Iterable[str],
            slices: int = 3, slice_column: str = "slice") -> DataFrame:
    """Final rows of a streaming aggregate run in update mode: only changed keys are written per batch."""
    out = BatchTable(spark, "updates")
    Replay(spark, inputs, slice_column, slices).run(build, out.write, mode="update")
    return out.latest(keys)


def per_batch(spark: SparkSession, inputs: dict[str, DataFrame], work: Callable[[DataFrame], DataFrame],
              slices: int = 3, slice_column: str = "slice") -> DataFrame:
    """Rows that ``work`` makes of every batch, with the batch number."""
    out = BatchTable(spark, "batches")
    Replay(spark, inputs, slice_column, slices).run(
        lambda *streams: streams[0], lambda df, i: out.write(work(df), i))
    return out.read()


def windowed(stream: DataFrame, time: str, length: str, slide: str | None, keys: Iterable[str], *aggs: Column,
             delay: str = "1 hour") -> DataFrame:
    """Aggregates per event-time window [start, end) and keys; the watermark lets old state go."""
    window = F.window(time, length, slide) if slide else F.window(time, length)
    grouped = stream.withWatermark(time, delay).groupBy(window.alias("w"), *keys).agg(*aggs)
    rest = [c for c in grouped.columns if c != "w"]
    return grouped.select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), *rest)
