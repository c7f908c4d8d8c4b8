"""Row numbers, running sums and carried-forward values without a one-partition window.

A global (or hot-key) window would send everything to one task. Here the rows are range
partitioned on the full sort key into blocks of bounded size, each block is summarised in
one row, the few summaries are accumulated, and every block then works on its own.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from millrace.plans.durable import staged
from millrace.plans.sizing import shuffle_partitions

BLOCK = "_block"
PLACE = "_place"


def range_blocks(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """``df`` sorted into written range partitions, numbered in ``_block``, with the row's place in its block.

    The partition count is left to adaptive execution, unless the input is so big that the
    configured count would make blocks too large for a task. The copy is written, so a lost
    executor cannot change which block a row belongs to.
    """
    wanted = shuffle_partitions(df)
    enough = wanted <= int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(*order) if enough else df.repartitionByRange(wanted, *order)
    # The task that sorts a block numbers its rows too: the low 33 bits of the increasing id.
    numbered = ranged.sortWithinPartitions(*order).withColumn(BLOCK, F.spark_partition_id())
    return staged(numbered.withColumn(PLACE, F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)), "blocks")


def _same(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[k]) for k in keys])


def row_index(df: DataFrame, order: Sequence[str], name: str = "idx") -> DataFrame:
    """Dense 0-based position of each row in ``order`` (which must be a total order).

    One exchange of the rows; the join adds the start of a block, of which there is one row per task.
    """
    blocks = range_blocks(df, order)
    starts = (blocks.groupBy(BLOCK).agg(F.count(F.lit(1)).alias("_n"))
              .select(BLOCK, (F.sum("_n").over(W.orderBy(BLOCK)) - F.col("_n")).alias("_start")))
    return (blocks.join(F.broadcast(starts), BLOCK)
            .withColumn(name, F.col(PLACE) + F.col("_start"))
            .drop(BLOCK, PLACE, "_start"))


def running_sums(df: DataFrame, order: Sequence[str], sums: Mapping[str, Column],
                 keys: Sequence[str] = ()) -> DataFrame:
    """Inclusive running sums, per ``keys`` if given. A key may span many blocks."""
    keys = list(keys)
    values = df.select("*", *[expr.alias(f"_v_{name}") for name, expr in sums.items()])
    blocks = range_blocks(values, [*keys, *order])
    group = [BLOCK, *keys]
    totals = blocks.groupBy(*group).agg(*[F.sum(f"_v_{n}").alias(f"_t_{n}") for n in sums])
    earlier = W.partitionBy(*keys).orderBy(BLOCK).rowsBetween(W.unboundedPreceding, -1)
    before = totals.select(*group, *[
        F.coalesce(F.sum(f"_t_{n}").over(earlier), F.lit(0)).alias(f"_b_{n}") for n in sums])
    joined = blocks.join(before, _same(blocks, before, group))
    inside = (W.partitionBy(*[blocks[g] for g in group]).orderBy(*[blocks[o] for o in order])
              .rowsBetween(W.unboundedPreceding, W.currentRow))
    return joined.select(*[blocks[c] for c in df.columns], *[
        (F.col(f"_b_{n}") + F.sum(f"_v_{n}").over(inside)).alias(n) for n in sums])


def carry_forward(df: DataFrame, order: Sequence[str], columns: Sequence[str],
                  keys: Sequence[str] = ()) -> DataFrame:
    """Fill each column with its last non-null value at or before the row, per ``keys``."""
    keys = list(keys)
    blocks = range_blocks(df, [*keys, *order])
    group = [BLOCK, *keys]
    position = F.struct(*order)
    tails = blocks.groupBy(*group).agg(*[
        F.max_by(c, F.when(F.col(c).isNotNull(), position)).alias(f"_l_{c}") for c in columns])
    earlier = W.partitionBy(*keys).orderBy(BLOCK).rowsBetween(W.unboundedPreceding, -1)
    before = tails.select(*group, *[
        F.last(f"_l_{c}", ignorenulls=True).over(earlier).alias(f"_b_{c}") for c in columns])
    joined = blocks.join(before, _same(blocks, before, group))
    inside = (W.partitionBy(*[blocks[g] for g in group]).orderBy(*[blocks[o] for o in order])
              .rowsBetween(W.unboundedPreceding, W.currentRow))
    kept = [blocks[c] for c in df.columns if c not in columns]
    return joined.select(*kept, *[
        F.coalesce(F.last(blocks[c], ignorenulls=True).over(inside), F.col(f"_b_{c}")).alias(c)
        for c in columns])
