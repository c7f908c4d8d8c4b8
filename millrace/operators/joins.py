"""Join shapes beyond a plain equi-join."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from millrace.plans.ordering import row_index
from millrace.plans.sizing import broadcast_if_small


def left_join_default(left: DataFrame, right: DataFrame, on: Sequence[str], defaults: dict) -> DataFrame:
    """Left outer join whose missing right values become defaults."""
    joined = left.join(right, list(on), "left")
    return joined.select(*[F.coalesce(F.col(c), F.lit(defaults[c])).alias(c) if c in defaults else F.col(c)
                           for c in joined.columns])


def lookup(df: DataFrame, small: DataFrame, on: Sequence[str]) -> DataFrame:
    """Inner join to a lookup table, broadcast when its size allows."""
    return df.join(broadcast_if_small(small), list(on))


def band_pairs(df: DataFrame, order: Sequence[str], columns: Sequence[str], width: int) -> DataFrame:
    """Unordered pairs i0 < i1 of rows at most ``width`` positions apart in ``order``.

    Positions are unique, so the join is on equality, every row meets at most ``width``
    partners and the pairs grow in proportion to the rows.
    """
    numbered = row_index(df, order, "i").select("i", *columns)
    left = numbered.select(F.col("i").alias("i0"), *[F.col(c).alias(f"{c}0") for c in columns],
                           F.explode(F.sequence(F.lit(1), F.lit(width))).alias("_step"))
    right = numbered.select(F.col("i").alias("i1"), *[F.col(c).alias(f"{c}1") for c in columns])
    return left.join(right, F.col("i0") + F.col("_step") == F.col("i1")).drop("_step")
