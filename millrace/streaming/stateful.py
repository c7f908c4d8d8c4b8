"""Stateful stream operators: counts in the state store, sketches and values in tables per batch."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.operators import sketches
from millrace.plans.ordering import running_sums
from millrace.streaming.feed import BatchTable, Replay
from millrace.streaming.keyed import changed_counts, state_store


def running_counts(spark: SparkSession, rows: DataFrame, key: str, order: Sequence[str], initial: Mapping[str, int],
                   slices: int = 3, folder: str | None = None, first: int = 0, expiry: timedelta | None = None,
                   progress: list | None = None) -> DataFrame:
    """One output row per input row: its number within its key, after the seeded count.

    The count of a key lives in the state store: a batch reads and writes the states of its own keys, however many
    there are in all. Rows of a batch are numbered in range blocks and start at their key's count, so a key that
    holds most rows is not handled by one task. A seeded key that never arrives emits nothing; with ``expiry`` a key
    unseen for so long starts anew. ``folder`` and ``first`` resume an earlier run. ``progress`` receives the state
    figures (changed and all rows) of every batch.
    """
    arrived, out = BatchTable(spark, "arrived", folder), BatchTable(spark, "running", folder)

    def build(stream: DataFrame) -> DataFrame:
        changed = changed_counts(spark, stream, key, initial, expiry)
        return stream.withColumn("_row", F.lit(True)).unionByName(
            changed.select(F.col("key").cast(stream.schema[key].dataType).alias(key), F.col("before").alias("_before"), F.lit(False).alias("_row")), True)

    def each(batch: DataFrame, number: int) -> None:
        # Written once: a second pass over the batch itself would run the stateful operator again.
        arrived.write(batch, number)
        mine = arrived.only(number)
        numbered = running_sums(mine.where("_row").drop("_row", "_before"), list(order), {"_inside": F.lit(1)}, keys=[key])
        before = mine.where("NOT _row").select(F.col(key).alias("_key"), "_before")
        joined = numbered.join(before, F.col(key).eqNullSafe(F.col("_key")))
        out.write(joined.withColumn("running", F.col("_inside") + F.col("_before")).drop("_inside", "_before", "_key"), number)

    with state_store(spark):
        Replay(spark, {"rows": rows}, slices=slices, folder=folder, first=first, progress=progress).run(build, each)
    return out.read()


def recoverable_count(spark: SparkSession, words: DataFrame, blocked: Sequence[str], slices: int = 3,
                      folder: str | None = None, first: int = 0) -> DataFrame:
    """Counts per batch without blocked words, and the blocked occurrences dropped so far.

    Every slice restarts the query from its checkpoint. A batch that runs again replaces its
    own output, so totals survive a stop at any point. A new process resumes with the same ``folder``,
    from the ``first`` slice that has not been fed.
    """
    out = BatchTable(spark, "counts", folder)

    def each(batch: DataFrame, number: int) -> None:
        held = F.col("word").isin(list(blocked))
        out.write(batch.groupBy("slice", F.when(held, None).otherwise(F.col("word")).alias("word")).agg(F.count(F.lit(1)).alias("n")), number)

    Replay(spark, {"words": words}, slices=slices, folder=folder, first=first).run(lambda s: s, each)
    return out.read().groupBy("slice", "word").agg(F.sum("n").alias("n"))


def distinct_by_batch(spark: SparkSession, rows: DataFrame, column: str, slices: int = 3, lg_k: int = 12) -> DataFrame:
    """Sketched distinct counts of every batch and of everything so far."""
    table = BatchTable(spark, "sketches")
    Replay(spark, {"rows": rows}, slices=slices).run(
        lambda s: s, lambda df, i: table.write(sketches.distinct_sketches(df, "slice", column, lg_k), i))
    each = table.read().groupBy("slice").agg(F.hll_union_agg("sketch").alias("sketch"))
    upto = each.select(F.explode(F.sequence(F.col("slice"), F.lit(slices - 1))).alias("slice"), "sketch")
    so_far = upto.groupBy("slice").agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("overall"))
    return each.select("slice", F.hll_sketch_estimate("sketch").alias("batch")).join(so_far, "slice")


def heavy_by_batch(spark: SparkSession, rows: DataFrame, column: str, slices: int = 3, k: int = 10,
                   share: float = 0.001, sketch: sketches.CountMin = sketches.CountMin()) -> DataFrame:
    """Estimated heavy values of every batch (slice) and of the whole stream (slice -1).

    Only sketches are kept between batches, plus the values that were heavy in some batch. A value
    that truly holds the share overall holds it in at least one batch, and estimates are never too
    low, so no such value is missed.
    """
    cells, found = BatchTable(spark, "cells"), BatchTable(spark, "heavy")

    def each(batch: DataFrame, number: int) -> None:
        cells.write(sketch.cells(batch, column), number)
        mine = cells.read().where(F.col("batch") == number)
        estimate, total = sketch.estimator(mine, column)
        heavy = batch.select("slice", column, estimate.cast("bigint").alias("estimate"))
        found.write(heavy.where(F.col("estimate") >= share * total).distinct(), number)

    Replay(spark, {"rows": rows}, slices=slices).run(lambda s: s, each)
    estimate, total = sketch.estimator(sketch.merge(cells.read()), column)
    whole = (found.read().select(column).distinct().select(F.lit(-1).alias("slice"), column, estimate.cast("bigint").alias("estimate"))
             .where(F.col("estimate") >= share * total))
    batches = found.read().groupBy("slice", column).agg(F.max("estimate").alias("estimate"))
    ranked = F.row_number().over(_by_estimate(column))
    return batches.unionByName(whole).withColumn("rank", ranked).where(F.col("rank") <= k)


def frequent_by_batch(spark: SparkSession, rows: DataFrame, column: str, slices: int = 3, share: float = 0.001) -> DataFrame:
    """Frequent values of every batch (slice) and of the whole stream (slice -1), with bounds on their counts.

    A batch is read once and leaves a fixed number of counters; the stream's are the sum of those of its batches.
    """
    kept = BatchTable(spark, "counters")

    def each(batch: DataFrame, number: int) -> None:
        counters = sketches.frequency_counters(batch, column, math.ceil(2 / share))
        size = batch.select(F.lit(None).cast(rows.schema[column].dataType).alias("value"), F.lit(0).cast("bigint").alias("lower"),
                            F.lit(0).cast("bigint").alias("slack")).groupBy("value", "lower", "slack").agg(F.count(F.lit(1)).alias("n"))
        kept.write(counters.withColumn("n", F.lit(0).cast("bigint")).unionByName(size), number)

    Replay(spark, {"rows": rows}, slices=slices).run(lambda s: s, each)
    counters, results = kept.read(), []
    for number in [*(r[0] for r in counters.select("batch").distinct().collect()), None]:
        mine = counters if number is None else counters.where(F.col("batch") == number)
        found = sketches.merge_counters(mine, column, share, mine.agg(F.sum("n")).first()[0])
        results.append(found.withColumn("slice", F.lit(-1 if number is None else number)))
    return reduce(DataFrame.unionByName, results)


def exact_by_batch(spark: SparkSession, rows: DataFrame, column: str, slices: int = 3, k: int = 10) -> DataFrame:
    """Exact top values of every batch (slice) and of the whole stream (slice -1)."""
    table = BatchTable(spark, "exact")
    Replay(spark, {"rows": rows}, slices=slices).run(
        lambda s: s, lambda df, i: table.write(df.groupBy("slice", column).agg(F.count(F.lit(1)).alias("estimate")), i))
    both = table.read().select(F.explode(F.array("slice", F.lit(-1))).alias("slice"), column, "estimate")
    counts = both.groupBy("slice", column).agg(F.sum("estimate").alias("estimate"))
    return counts.withColumn("rank", F.row_number().over(_by_estimate(column)).cast("bigint")).where(F.col("rank") <= k)


def _by_estimate(column: str):
    from pyspark.sql import Window

    return Window.partitionBy("slice").orderBy(F.desc("estimate"), F.asc(column))
