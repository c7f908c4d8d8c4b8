"""Relational helpers over any DataFrame."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def format_rows(df: DataFrame, key: str, value: str) -> DataFrame:
    return df.withColumn("line", F.format_string("Key: %s, Value: %s", F.col(key).cast("string"), F.col(value)))


def with_length(df: DataFrame, column: str, name: str) -> DataFrame:
    return df.withColumn(name, F.length(column).cast("bigint"))


def grep(df: DataFrame, column: str, needle: str) -> DataFrame:
    return df.where(F.contains(F.col(column), F.lit(needle)))


def drop_blocked(counts: DataFrame, word: str, total: str, blocked: Sequence[str]) -> DataFrame:
    """Counted words without the blocked ones, and one row with the occurrences dropped."""
    held = F.col(word).isin(list(blocked))
    marked = counts.select(F.when(held, F.lit("(dropped)")).otherwise(F.col(word)).alias(word), total,
                           held.alias("dropped"))
    return marked.groupBy(word, "dropped").agg(F.sum(total).alias(total)).select(word, total, "dropped")


def squared_errors(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Squared errors of the rows that have a prediction."""
    error = df.withColumn("error", F.pow(F.col(actual) - F.col(predicted), 2))
    return error.where(~F.isnan("error") & F.col("error").isNotNull())


def cells_to_json(cells: DataFrame, key: str) -> DataFrame:
    """All cells of a row key as one string of JSON objects, one per line."""
    cell = F.to_json(F.struct(key, "columnFamily", "qualifier", "value"))
    packed = cells.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("qualifier", cell.alias("json")))).alias("c"))
    return packed.select(key, F.array_join(F.transform("c", lambda s: s["json"]), "\n").alias("cells"))


def flat_map(df: DataFrame, items: Column, name: str, *keep: str) -> DataFrame:
    return df.select(*keep, F.posexplode(items).alias("pos", name))


def union_all(*frames: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def set_union(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.unionByName(b).distinct()


def partition_by_rule(df: DataFrame, rule: Column, partitions: int) -> DataFrame:
    """Send each row to the partition numbered by ``rule``."""
    return df.repartitionById(partitions, rule)


def group_with_partitions(df: DataFrame, key: str, partitions: int) -> DataFrame:
    """Count per key with a chosen number of reducers.

    Rows are first counted inside their input partition and group, so that the chosen
    exchange moves counts, not rows, and a hot key stays small.
    """
    local = df.groupBy(key, F.spark_partition_id().alias("_p")).agg(F.count(F.lit(1)).alias("_n"))
    return local.repartition(partitions, key).groupBy(key).agg(F.sum("_n").alias("n"))


def merged_stats(df: DataFrame, key: str, value: str) -> DataFrame:
    """Count, total and range per key; every buffer merges, so it combines before the shuffle."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum(value), 2).alias("total"),
                               F.min(value).alias("low"), F.max(value).alias("high"))
