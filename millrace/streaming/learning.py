"""Models that learn from every batch of a stream.

The parameters of each batch are written next to the checkpoint, so a restart goes on from the
last finished batch and a repeated batch starts from the same point.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.operators import models
from millrace.streaming.feed import BatchTable, Replay


class _Parameters:
    """A short list of numbers per batch."""

    def __init__(self, spark: SparkSession, start: Sequence[float], folder: str | None = None):
        self.spark, self.start, self.table = spark, [float(x) for x in start], BatchTable(spark, "parameters", folder)

    def before(self, batch: int) -> list[float]:
        earlier = self.table.read(before=batch)
        last = earlier.agg(F.max_by("values", "batch")).first()[0] if earlier is not None else None
        return list(last) if last is not None else list(self.start)

    def save(self, values: Sequence[float], batch: int) -> None:
        self.table.write(self.spark.createDataFrame([([float(v) for v in values],)], "values array<double>"), batch)

    def last(self) -> list[float]:
        return self.before(1 << 30)


def streaming_kmeans(spark: SparkSession, points: DataFrame, vector: str, centres: np.ndarray, decay: float = 1.0,
                     slices: int = 3, folder: str | None = None, first: int = 0) -> np.ndarray:
    """Centres after all batches: c = (c * n * decay + sum) / (n * decay + m) per batch of m points.

    ``folder`` and ``first`` resume an earlier run.
    """
    k, d = centres.shape
    held = _Parameters(spark, [*centres.ravel(), *np.zeros(k)], folder)

    def each(batch: DataFrame, number: int) -> None:
        state = np.array(held.before(number))
        c, n = state[:k * d].reshape(k, d), state[k * d:]
        new, counts = c.copy(), np.zeros(k)
        for r in models.centre_sums(batch, vector, c).collect():
            i, p = r["cluster"], r["pos"]
            counts[i] = r["n"]
            new[i, p] = (c[i, p] * n[i] * decay + r["total"]) / (n[i] * decay + r["n"])
        held.save([*new.ravel(), *(n * decay + counts)], number)

    Replay(spark, {"points": points}, slices=slices, folder=folder, first=first).run(lambda s: s, each)
    return np.array(held.last())[:k * d].reshape(k, d)


def streaming_gradient(spark: SparkSession, points: DataFrame, columns: Sequence[str], label: str, logistic: bool,
                       step: float = 0.1, steps: int = 50, slices: int = 3, folder: str | None = None,
                       first: int = 0) -> list[float]:
    """Weights of a linear or logistic model after some gradient steps on every batch, from zero.

    Step i of a batch moves by step / sqrt(i) along the mean gradient. ``folder`` and ``first`` resume an earlier run.
    """
    held = _Parameters(spark, [0.0] * len(columns), folder)

    def each(batch: DataFrame, number: int) -> None:
        weights = held.before(number)
        data = batch.select(label, *columns).persist()
        for i in range(1, steps + 1):
            score = models.dot(columns, weights)
            error = (1 / (1 + F.exp(-score)) if logistic else score) - F.col(label)
            slope = data.agg(*[F.avg(F.col(c) * error) for c in columns]).first()
            weights = [w - step / math.sqrt(i) * (g or 0.0) for w, g in zip(weights, slope)]
        data.unpersist()
        held.save(weights, number)

    Replay(spark, {"points": points}, slices=slices, folder=folder, first=first).run(lambda s: s, each)
    return held.last()


def welch(groups: DataFrame, group: str) -> DataFrame:
    """t and degrees of freedom of Welch's test from (group, n, mean, variance) rows."""
    side = lambda flag, c: F.max(F.when(F.col(group) == flag, F.col(c)))
    one = groups.agg(*[side(flag, c).alias(f"{c}{i}") for i, flag in enumerate((False, True)) for c in ("n", "mean", "variance")])
    a, b = F.col("variance0") / F.col("n0"), F.col("variance1") / F.col("n1")
    return one.select("n0", "n1", F.try_divide(F.col("mean1") - F.col("mean0"), F.sqrt(a + b)).alias("t"),
                      F.try_divide(F.pow(a + b, 2), F.try_divide(F.pow(a, 2), F.col("n0") - 1) + F.try_divide(F.pow(b, 2), F.col("n1") - 1)).alias("df"))


def p_value(t: float, df: float) -> float:
    """Two-sided p-value of Student's law: the regularised incomplete beta function at df / (df + t^2)."""
    x, a, b = df / (df + t * t), df / 2.0, 0.5
    if x in (0.0, 1.0):
        return x
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x))
    # The continued fraction converges fast below the mean of the law; above it the other tail is taken.
    if x < (a + 1) / (a + b + 2):
        return front * _beta_fraction(x, a, b) / a
    return 1.0 - front * _beta_fraction(1 - x, b, a) / b


def _beta_fraction(x: float, a: float, b: float, least: float = 1e-300) -> float:
    """The continued fraction of the incomplete beta function, by Lentz's method."""
    c, d = 1.0, 1.0 / (1.0 - (a + b) * x / (a + 1) or least)
    value = d
    for m in range(1, 500):
        for numerator in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1.0 / (1.0 + numerator * d or least)
            c = 1.0 + numerator / c or least
            value *= c * d
        if abs(c * d - 1.0) < 1e-15:
            break
    return value
