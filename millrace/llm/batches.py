"""Arrow batches in and out of the operators that work on whole texts in Python."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType
from pyspark.sql.pandas.types import to_arrow_schema

from millrace.plans.sizing import balanced

# A batch holds so many rows and bytes at most, so that a task's memory does not depend on the table.
BATCH_SETTINGS = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20),
}


def small_batches(spark: SparkSession) -> None:
    for key, value in BATCH_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)


def map_rows(df: DataFrame, columns: Sequence[Column], schema: str,
             rows: Callable[[Iterator[tuple]], Iterable[tuple]], spread: bool = False) -> DataFrame:
    """Rows of ``schema`` that ``rows`` makes of the ``columns``, batch by batch.

    ``rows`` gets an iterator over the tuples of one task. It yields tuples in the order of ``schema``; they
    leave in batches of bounded count. ``spread`` deals rows over the cores when the scan has too few tasks.
    """
    small_batches(df.sparkSession)
    chosen = df.select(*[c.alias(f"_{i}") for i, c in enumerate(columns)])
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def tuples(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*[c.to_pylist() for c in batch.columns])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for row in rows(tuples(batches)):
            held.append(row)
            if len(held) == 1000:
                yield record_batch(held, arrow)
                held = []
        if held:
            yield record_batch(held, arrow)

    return (balanced(chosen) if spread else chosen).mapInArrow(run, schema)


def record_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def blocks_of(rows: Iterable[tuple], size: Callable[[tuple], int], limit: int) -> Iterator[list[tuple]]:
    """Consecutive rows, until their sizes reach ``limit``; a row larger than that is the last of its block."""
    held, total = [], 0
    for row in rows:
        held.append(row)
        total += size(row)
        if total >= limit:
            yield held
            held, total = [], 0
    if held:
        yield held


def ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Positions start, start + 1, ... of each run, one run after the other."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)


def utf8(name: str) -> Column:
    """The bytes of a text, without decoding."""
    return F.col(name).cast("binary")


class TwoGenerations(dict):
    """A mapping that fills itself by ``make`` and holds at most twice ``limit`` entries.

    When the young half is full it becomes the old half; entries that are asked for again move back.
    Frequent keys stay, rare ones go, and those longer than ``longest`` are never held. Only speed depends on it.
    """

    def __init__(self, make: Callable, limit: int, longest: int | None = None):
        super().__init__()
        self.make, self.limit, self.longest, self.old = make, limit, longest, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if self.longest is not None and len(key) > self.longest:
            return value
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value
