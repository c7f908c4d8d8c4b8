"""Approximate distinct counts and frequencies from sketches that merge."""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from millrace.plans.durable import staged


def approx_distinct(df: DataFrame, column: str, lg_k: int = 12) -> DataFrame:
    """Sketched and exact distinct counts and the relative error."""
    both = df.agg(F.hll_sketch_estimate(F.hll_sketch_agg(column, F.lit(lg_k))).alias("estimate"),
                  F.count_distinct(column).alias("exact"))
    return both.withColumn("error", F.col("estimate") / F.col("exact") - 1)


def distinct_sketches(df: DataFrame, group: str, column: str, lg_k: int = 12) -> DataFrame:
    """One mergeable sketch per group."""
    return df.groupBy(group).agg(F.hll_sketch_agg(column, F.lit(lg_k)).alias("sketch"))


def merge_sketches(sketches: DataFrame) -> DataFrame:
    return sketches.agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("estimate"))


@dataclass(frozen=True)
class CountMin:
    """Shape of a count-min sketch: error bound eps * N with probability 1 - delta."""

    eps: float = 0.01
    delta: float = 1e-3
    seed: int = 1

    @property
    def depth(self) -> int:
        return math.ceil(math.log(1 / self.delta))

    @property
    def width(self) -> int:
        return math.ceil(math.e / self.eps)

    def bucket(self, column: Column, row: int) -> Column:
        return F.pmod(F.xxhash64(column, F.lit(self.seed + row)), F.lit(self.width))

    def cells(self, df: DataFrame, column: str, *groups: str) -> DataFrame:
        """The sketch as rows (row, bucket, n). Each task sends at most depth * width rows."""
        places = F.array(*[F.struct(F.lit(r).alias("row"), self.bucket(F.col(column), r).alias("bucket"))
                           for r in range(self.depth)])
        spread = df.select(*groups, F.explode(places).alias("p"))
        return (spread.groupBy(*groups, F.col("p.row").alias("row"), F.col("p.bucket").alias("bucket"))
                .agg(F.count(F.lit(1)).alias("n")))

    def merge(self, cells: DataFrame) -> DataFrame:
        return cells.groupBy("row", "bucket").agg(F.sum("n").alias("n"))

    def estimator(self, cells: DataFrame, column: str) -> tuple[Column, int]:
        """Frequency estimate as an expression, and the total count.

        The sketch has a fixed size (depth * width numbers), so it is carried as constants.
        """
        grid = [[0] * self.width for _ in range(self.depth)]
        for cell in cells.collect():
            grid[cell["row"]][cell["bucket"]] = cell["n"]
        lines = [F.expr("array(" + ", ".join(f"{n}L" for n in line) + ")") for line in grid]
        reads = [F.get(line, self.bucket(F.col(column), r).cast("int")) for r, line in enumerate(lines)]
        return F.least(*reads), sum(grid[0])


def frequency_estimates(df: DataFrame, column: str, sketch: CountMin = CountMin()) -> DataFrame:
    """Estimated and true count of every value."""
    estimate, _ = sketch.estimator(sketch.cells(df, column), column)
    exact = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return exact.select(column, estimate.cast("bigint").alias("estimate"), "n")


def heavy_hitters(df: DataFrame, column: str, share: float = 0.001, k: int = 10,
                  sketch: CountMin = CountMin(), cells: DataFrame | None = None) -> DataFrame:
    """Values whose estimated share reaches ``share``, best k by estimate.

    Rows below the share are dropped in the scan, so only heavy values are shuffled.
    """
    estimate, total = sketch.estimator(cells if cells is not None else sketch.cells(df, column), column)
    heavy = df.select(column, estimate.cast("bigint").alias("estimate")).where(F.col("estimate") >= share * total)
    return heavy.distinct().orderBy(F.desc("estimate"), F.asc(column)).limit(k)


def frequency_counters(df: DataFrame, column: str, capacity: int) -> DataFrame:
    """(value, lower, slack) of each task's most frequent values, at most ``capacity`` of them, in one pass.

    When a task holds more, the count of the first that has no place is taken off all of them, and ``slack`` is the
    sum of what was taken off: a value occurs in the task's rows between lower and lower + slack times, and one without
    a counter at most slack times. Each task adds a row with a null value and its slack. (Agarwal et al., "Mergeable
    summaries", 2012.) Null values are not counted.
    """
    kind = df.schema[column].dataType

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, slack = Counter(), 0
        for batch in batches:
            for entry in pc.value_counts(pc.drop_null(batch.column(0))).to_pylist():
                held[entry["values"]] += entry["counts"]
            if len(held) > 2 * capacity:
                held, taken = _reduced(held, capacity)
                slack += taken
        held, taken = _reduced(held, capacity)
        slack += taken
        yield pa.RecordBatch.from_arrays([pa.array([*held, None], value_type), pa.array([*held.values(), 0], pa.int64()),
                                          pa.array([0] * len(held) + [slack], pa.int64())], names=["value", "lower", "slack"])

    value_type = to_arrow_type(kind)
    return df.select(column).mapInArrow(count, f"value {kind.simpleString()}, lower bigint, slack bigint")


def _reduced(held: Counter, capacity: int) -> tuple[Counter, int]:
    if len(held) <= capacity:
        return held, 0
    taken = heapq.nlargest(capacity + 1, held.values())[-1]
    return Counter({value: n - taken for value, n in held.items() if n > taken}), taken


def merge_counters(counters: DataFrame, column: str, share: float, total: int) -> DataFrame:
    """(column, lower, upper) of every value that may reach ``share`` of the ``total`` rows; no other value can."""
    slack = counters.agg(F.coalesce(F.sum("slack"), F.lit(0))).first()[0]
    merged = counters.where("value IS NOT NULL").groupBy(F.col("value").alias(column)).agg(F.sum("lower").alias("lower"))
    return merged.withColumn("upper", F.col("lower") + F.lit(slack)).where(F.col("upper") >= share * total)


def frequent_values(df: DataFrame, column: str, share: float = 0.001) -> DataFrame:
    """Every value that holds at least ``share`` of the rows, with bounds that contain its exact count.

    A task keeps 2 / share counters, so the bounds are at most half the share apart and no frequent value can be without.
    """
    counters = staged(frequency_counters(df, column, math.ceil(2 / share)), "counters")
    return merge_counters(counters, column, share, df.count())


def exact_heavy_hitters(df: DataFrame, column: str, k: int = 10) -> DataFrame:
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), F.asc(column)).limit(k)
