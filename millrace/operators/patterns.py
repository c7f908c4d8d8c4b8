"""Frequent itemsets, association rules and sequential patterns."""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth, PrefixSpan
from pyspark.sql import DataFrame, functions as F

from millrace.plans.durable import staged


def frequent_itemsets(baskets: DataFrame, items: str, min_support: float) -> DataFrame:
    """(items sorted, freq) of all itemsets with enough support. The baskets are written, because a fit reads them several times."""
    model = FPGrowth(itemsCol=items, minSupport=min_support, minConfidence=0.0).fit(staged(baskets.select(items), "baskets"))
    return model.freqItemsets.select(F.sort_array("items").alias("items"), "freq")


def association_rules(itemsets: DataFrame, min_confidence: float) -> DataFrame:
    """Rules with one item on the right, from a table of itemsets.

    confidence = freq(antecedent and consequent) / freq(antecedent)
    """
    whole = itemsets.where(F.size("items") > 1).select(F.explode("items").alias("consequent"), "items", "freq")
    rules = whole.select(F.sort_array(F.array_remove("items", F.col("consequent"))).alias("antecedent"), "consequent", "freq")
    base = itemsets.select(F.sort_array("items").alias("antecedent"), F.col("freq").alias("_base"))
    return (rules.join(base, "antecedent").select("antecedent", "consequent", (F.col("freq") / F.col("_base")).alias("confidence"))
            .where(F.col("confidence") >= min_confidence))


def sequential_patterns(sequences: DataFrame, column: str, min_support: float, max_length: int) -> DataFrame:
    finder = PrefixSpan(minSupport=min_support, maxPatternLength=max_length, sequenceCol=column)
    return finder.findFrequentSequentialPatterns(sequences)
