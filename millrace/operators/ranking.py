"""Sort, top-k and rank operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F


def top_k_by_count(df: DataFrame, key: str, k: int) -> DataFrame:
    """The k most frequent keys; ties go to the smaller key."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), F.asc(key)).limit(k)


def head(df: DataFrame, order: list[str], n: int) -> DataFrame:
    """First n rows of a total order."""
    return df.orderBy(*order).limit(n)


def best_row(df: DataFrame, value: str, score: str) -> DataFrame:
    """The value with the highest score; the smallest such value on ties."""
    best = F.max_by(value, F.struct(F.col(score), -F.col(value)))
    return df.agg(best.alias(value), F.max(score).alias(score))


def top_k_per_group(df: DataFrame, group: str, score: str, tie: str, k: int) -> DataFrame:
    """Rows ranked 1..k inside each group. Spark limits each task to k rows per group first."""
    ranked = W.partitionBy(group).orderBy(F.desc(score), F.asc(tie))
    return df.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)
