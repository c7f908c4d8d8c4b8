"""A count per key in Spark's state store, with seeds and expiry.

Rows are counted per key inside the tasks that read them, so a key that holds most rows reaches the stateful operator
as a few numbers. The operator changes the states of a batch's own keys only; RocksDB's change log writes just those.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from datetime import timedelta

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # With expiry the operator asks for batches without rows for ever, and a run over what is available would not end.
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
}
CHANGED = "key string, before bigint, n bigint"


@contextmanager
def state_store(spark: SparkSession) -> Iterator[None]:
    """Streams started inside keep their state in RocksDB and write only what a batch changed."""
    old = {key: spark.conf.get(key, None) for key in STATE_SETTINGS}
    for key, value in STATE_SETTINGS.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in old.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


class _Counter(StatefulProcessor):
    """Adds a batch's counts to a key's state and tells what it was before."""

    def __init__(self, expiry: timedelta | None):
        self.expiry = expiry

    def init(self, handle: StatefulProcessorHandle) -> None:
        life = None if self.expiry is None else max(1, int(self.expiry.total_seconds() * 1000))
        self.count = handle.getValueState("count", "n bigint", life)

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        self.count.update((int(initialState["n"].iloc[0]),))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        n = sum(int(part["n"].sum()) for part in rows)
        before = int(self.count.get()[0]) if self.count.exists() else 0
        self.count.update((before + n,))
        yield pd.DataFrame({"key": [key[0]], "before": [before], "n": [n]})

    def close(self) -> None:
        pass


def counts_in_task(stream: DataFrame, key: str) -> DataFrame:
    """(key, n) of every batch of rows inside a task: stateless, and small for a hot key. Null is a key like any other."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pc.value_counts(batch.column(0))
            if len(found):
                yield pa.RecordBatch.from_arrays([found.field("values").cast(pa.string()), found.field("counts").cast(pa.int64())], names=["key", "n"])

    return stream.selectExpr(f"CAST(`{key}` AS STRING) AS key").mapInArrow(count, "key string, n bigint")


def changed_counts(spark: SparkSession, stream: DataFrame, key: str, initial: Mapping[str, int], expiry: timedelta | None = None) -> DataFrame:
    """For each key of a batch: its count ``before`` the batch (seed included) and ``n`` rows in it.

    Seeds enter the state with the first batch; a seeded key that never arrives emits nothing. With ``expiry`` a key
    that has not been seen for so long starts at nothing again.
    """
    seeds = spark.createDataFrame(list(initial.items()), "key string, n bigint").groupBy("key")
    return counts_in_task(stream, key).groupBy("key").transformWithStateInPandas(
        _Counter(expiry), CHANGED, "Append", "None" if expiry is None else "ProcessingTime", seeds if initial else None)
