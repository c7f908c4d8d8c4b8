"""Linear algebra and column statistics on tall, narrow matrices (rows of d numbers)."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.feature import PCA, ElementwiseProduct
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, functions as F

from millrace.plans.durable import staged

MERGED = 16  # triangular factors stacked by one task


def gram_rows(df: DataFrame, array: str) -> DataFrame:
    """Entries (i, j, dot), i <= j, of the matrix of column dot products.

    Each task adds up its own d x d matrix and sends d * (d + 1) / 2 rows, whatever the
    number of its input rows.
    """

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = None
        for batch in batches:
            if len(batch):
                m = np.stack(batch["a"].to_numpy()).astype(float)
                total = m.T @ m if total is None else total + m.T @ m
        if total is not None:
            i, j = np.triu_indices(len(total))
            yield pd.DataFrame({"i": i.astype("int64"), "j": j.astype("int64"), "dot": total[i, j]})

    parts = df.select(F.col(array).cast("array<double>").alias("a")).mapInPandas(partial, "i bigint, j bigint, dot double")
    return parts.groupBy("i", "j").agg(F.sum("dot").alias("dot"))


def column_cosines(df: DataFrame, array: str) -> DataFrame:
    """Cosine similarity of every pair of columns i < j with a non-zero dot product."""
    gram = gram_rows(df, array)
    norm = gram.where("i = j").select(F.col("i").alias("_k"), F.sqrt("dot").alias("_n"))
    left = norm.select(F.col("_k").alias("i"), F.col("_n").alias("_ni"))
    right = norm.select(F.col("_k").alias("j"), F.col("_n").alias("_nj"))
    return (gram.where("i < j and dot <> 0").join(left, "i").join(right, "j")
            .select("i", "j", (F.col("dot") / (F.col("_ni") * F.col("_nj"))).alias("cosine")))


def column_norms(df: DataFrame, array: str) -> np.ndarray:
    """Length of every column; a task sends one number per column."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for m in _matrices(batches, 0):
            total = (m ** 2).sum(axis=0) + (0 if total is None else total)
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], names=["j", "square"])

    squares = _arrays(df, array).mapInArrow(partial, "j bigint, square double").groupBy("j").agg(F.sum("square").alias("square"))
    found = sorted((r["j"], r["square"]) for r in squares.collect())
    return np.sqrt([square for _, square in found])


def _arrays(df: DataFrame, array: str, *more: Column) -> DataFrame:
    """Rows with a vector, as (a, ...)."""
    return df.where(F.col(array).isNotNull()).select(F.col(array).cast("array<double>").alias("a"), *more)


def _matrices(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[np.ndarray]:
    for batch in batches:
        if batch.num_rows:
            lists = batch.column(column)
            yield lists.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(lists), -1)


def _uniform(keys: np.ndarray, width: int, seed: int) -> np.ndarray:
    """A number in [0, 1) for every (key, column), the same on every run: the SplitMix64 finaliser over a counter."""
    steps = np.arange(1, width + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x = keys.view(np.uint64)[:, None] + steps[None, :] + np.uint64(seed * 0xD1342543DE82EF95 % (1 << 64))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (x ^ (x >> np.uint64(31))) / 2.0 ** 64


def sampled_column_cosines(df: DataFrame, array: str, threshold: float, identity: Sequence[str], seed: int = 1) -> DataFrame:
    """Cosine similarities estimated from a sample of the entries; those above the threshold are near.

    A column of length c is sampled with probability sqrt(gamma) / c, gamma = 10 ln(d) / threshold, so the work per
    column does not depend on the number of rows. Whether an entry is taken depends on a hash of the row's
    ``identity`` alone. (Zadeh and Goel, "Dimension independent similarity computation", 2013.)
    """
    norms = column_norms(df, array)
    width = len(norms)
    reach = np.sqrt(10 * np.log(max(width, 2)) / threshold) if threshold > 0 else np.inf
    with np.errstate(divide="ignore"):
        chance = np.where(norms > 0, np.minimum(1.0, reach / norms), 0.0)
    scale = np.minimum(reach, norms)
    scale[scale == 0] = 1.0

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            for m in _matrices([batch], 0):
                taken = np.where(_uniform(batch.column(1).to_numpy(), width, seed) < chance, m, 0.0) / scale
                total += taken.T @ taken
        i, j = np.nonzero(np.triu(total, 1))
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(total[i, j])], names=["i", "j", "cosine"])

    rows = _arrays(df, array, F.xxhash64(*identity).alias("key"))
    return rows.mapInArrow(partial, "i bigint, j bigint, cosine double").groupBy("i", "j").agg(F.sum("cosine").alias("cosine"))


def cosine_error(exact: DataFrame, approximate: DataFrame) -> DataFrame:
    """Mean absolute error of the approximate similarities, a missing one counting as 0."""
    other = approximate.withColumnRenamed("cosine", "_c")
    gap = F.abs(F.col("cosine") - F.coalesce("_c", F.lit(0.0)))
    return exact.join(other, ["i", "j"], "left").agg(F.count(F.lit(1)).alias("pairs"), F.avg(gap).alias("mae"))


def triangular_factor(df: DataFrame, array: str) -> np.ndarray:
    """R of a QR decomposition of the whole matrix: one factor per task, stacked and factored again in groups of ``MERGED``.

    Only factors of d x d numbers move, and no product of columns is formed, so small values keep their digits.
    """

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = None
        for m in _matrices(batches, 0):
            r = np.linalg.qr(m if r is None else np.vstack([r, m]), mode="r")
        if r is not None:
            yield _factor(TaskContext.get().partitionId(), r)

    def merge(factors: pa.Table) -> pa.Table:
        width = factors.column("width")[0].as_py()
        stacked = np.vstack([np.asarray(r, float).reshape(-1, width) for r in factors.column("r").to_pylist()])
        return pa.Table.from_batches([_factor(factors.column("block")[0].as_py(), np.linalg.qr(stacked, mode="r"))])

    schema = "block bigint, width bigint, r array<double>"
    factors = staged(_arrays(df, array).mapInArrow(own, schema), "factors")
    last = factors.agg(F.max("block")).first()[0]
    while last:
        last //= MERGED
        factors = factors.withColumn("block", F.floor(F.col("block") / MERGED)).groupBy("block").applyInArrow(merge, schema)
    found = factors.first()
    return np.zeros((0, 0)) if found is None else np.array(found["r"]).reshape(-1, found["width"])


def _factor(block: int, r: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([r.shape[1]], pa.int64()),
                                       pa.array([r.ravel().tolist()], pa.list_(pa.float64()))], names=["block", "width", "r"])


def singular_values(df: DataFrame, array: str) -> DataFrame:
    """Singular values, greatest first, one per column; zeros where the matrix has fewer rows or a lower rank."""
    r = triangular_factor(df, array)
    values = np.linalg.svd(r, compute_uv=False) if r.size else np.zeros(0)
    values = np.concatenate([values, np.zeros(r.shape[1] - len(values))])
    return df.sparkSession.createDataFrame([(k, float(v)) for k, v in enumerate(values)], "k int, sigma double")


def principal_components(df: DataFrame, array: str, k: int) -> tuple[DataFrame, np.ndarray]:
    """Projected rows and loadings. A component's sign is free; here its largest loading is positive."""
    points = df.withColumn("_v", array_to_vector(array))
    model = PCA(k=k, inputCol="_v", outputCol="projected").fit(points)
    pc = model.pc.toArray()
    signs = np.sign(pc[np.abs(pc).argmax(axis=0), np.arange(pc.shape[1])])
    flipped = ElementwiseProduct(scalingVec=Vectors.dense(signs), inputCol="_p", outputCol="projected")
    projected = flipped.transform(model.transform(points).withColumnRenamed("projected", "_p"))
    return projected.drop("_v", "_p"), pc * signs


def column_summary(df: DataFrame, columns: Sequence[str], *groups: str) -> DataFrame:
    """Count, mean, variance, non-zeros and range of each column, in one pass."""
    stats = F.array(*[F.struct(F.lit(c).alias("name"), F.count(c).alias("n"), F.avg(c).alias("mean"),
                               F.var_samp(c).alias("variance"), F.count_if(F.col(c) != 0).alias("non_zeros"),
                               F.min(c).alias("low"), F.max(c).alias("high")) for c in columns])
    return df.groupBy(*groups).agg(stats.alias("_s")).select(*groups, F.inline("_s"))


def label_correlations(df: DataFrame, label: str, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of the label with each column, in one pass."""
    one = df.agg(F.array(*[F.struct(F.lit(c).alias("name"), F.corr(label, c).alias("corr")) for c in columns]).alias("_s"))
    return one.select(F.inline("_s"))
