"""Importance resampling towards a target corpus, by hashed n-grams counted with Arrow kernels.

A batch of texts is lower-cased, split and flattened into one array of words by Arrow kernels and dictionary
encoded. N-grams are pairs of shifted indices: a run of n words is the number of its first n - 1 words and the index
of the next one, so only distinct pairs get a checksum, continued from that of the shorter run. The checksum's bucket
is taken per position; bucket counts of the documents and of the target give a gain per bucket, and a document's
weight is the mean gain over the segment of its positions. A weight plus seeded Gumbel noise is the score; the
highest scores are drawn without replacement, which resamples in proportion to the exponential of the weights.

Only the bucket counts (one number per bucket) and a coarse histogram of the scores reach the driver. The draw is
exact: rows from the histogram bin that holds the last drawn score upwards are ordered over range partitions.

Defined results: null or empty text, and text without words, has no features, weight 0 and is never drawn unless
``min_words`` is 0; rows that repeat are counted, scored and drawn each (the same id gives the same noise); a null id
has the noise of an empty id and precedes others in ties; an empty table gives no rows, an empty target gives gains
from smoothing alone; texts are never cut; other columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from millrace.llm.batches import small_batches
from millrace.plans.durable import staged
from millrace.plans.ordering import row_index
from millrace.plans.sizing import balanced

BUCKETS = 10_000
NOT_WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BIN = 64
SCORED = "doc_id bigint, n_features bigint, n_words bigint, weight bigint"


def words_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Row and dictionary index of every word of a batch, and the dictionary."""
    parts = pc.split_pattern_regex(pc.ascii_lower(pc.fill_null(texts, "")), pattern=NOT_WORDS)
    words, rows = pc.list_flatten(parts), pc.list_parent_indices(parts)
    filled = pc.greater(pc.binary_length(words), 0)
    encoded = words.filter(filled).dictionary_encode()
    return rows.filter(filled).to_numpy(), encoded.indices.to_numpy().astype(np.int64), encoded.dictionary


def feature_buckets(texts: pa.Array, longest: int, buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each length up to ``longest``: the row of every run of so many words, and its bucket."""
    rows, indices, dictionary = words_of(texts)
    spelled = dictionary.cast(pa.binary()).to_pylist()
    sums = np.fromiter(map(zlib.crc32, spelled), np.uint32, len(spelled))
    runs, at = indices, rows
    yield at, (sums % buckets)[runs] if len(runs) else np.zeros(0, np.uint32)
    for length in range(2, longest + 1):
        following = indices[length - 1:]
        inside = at[:len(following)] == rows[length - 1:]
        # Runs that leave their text stay in the arrays, so that positions keep lining up; they are masked out.
        pairs, runs = np.unique(runs[:len(following)] * max(len(spelled), 1) + following, return_inverse=True)
        before, after = np.divmod(pairs, max(len(spelled), 1))
        sums = np.fromiter((zlib.crc32(b" " + spelled[w], int(sums[b])) for b, w in zip(before.tolist(), after.tolist())), np.uint32, len(pairs))
        at = at[:len(following)]
        yield at[inside], (sums % buckets)[runs[inside]] if len(runs) else np.zeros(0, np.uint32)


def bucket_counts(df: DataFrame, longest: int = 1, buckets: int = BUCKETS, text_column: str = "text") -> np.ndarray:
    """How many features fall in each bucket: added up per task, then over tasks."""
    small_batches(df.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, found in feature_buckets(batch.column(0), longest, buckets):
                total += np.bincount(found, minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["bucket", "n"])

    texts = balanced(df.select(F.col(text_column).cast("string").alias("text")))
    counted = texts.mapInArrow(count, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))
    result = np.zeros(buckets, np.int64)
    for row in counted.collect():
        result[row.bucket] = row.n
    return result


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln(p / q)) of each bucket, p and q smoothed by one."""
    n, s, t = len(source), float(source.sum()), float(target.sum())
    return np.array([math.floor(1000 * math.log((b + 1.0) * (s + n) / ((a + 1.0) * (t + n)))) for a, b in zip(source.tolist(), target.tolist())], np.int64)


def weigh(df: DataFrame, gain: np.ndarray, longest: int = 1, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per document: its features, its words and the floored mean of their gains."""
    small_batches(df.sparkSession)
    buckets = len(gain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = batch.num_rows
            total, n_features, n_words = np.zeros(size, np.int64), np.zeros(size, np.int64), np.zeros(size, np.int64)
            for length, (rows, found) in enumerate(feature_buckets(batch.column(1), longest, buckets), 1):
                # Rows ascend, so each document is one segment.
                starts = np.flatnonzero(np.diff(rows, prepend=-1))
                own = rows[starts]
                counts = np.diff(starts, append=len(rows))
                if len(starts):
                    total[own] += np.add.reduceat(gain[found], starts)
                n_features[own] += counts
                if length == 1:
                    n_words[own] = counts
            weight = np.where(n_features > 0, total // np.maximum(n_features, 1), 0)
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, (n_features, n_words, weight))],
                                             names=["doc_id", "n_features", "n_words", "weight"])

    chosen = df.select(F.col(id_column).cast("bigint").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    return balanced(chosen).mapInArrow(run, SCORED)


def noise(key: Column, seed: int) -> Column:
    """floor(1000 g) of a standard Gumbel value g that depends on the seed and the key alone."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"), 256)
    uniform = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") + 0.5) / F.lit(4294967296.0)
    return F.floor(F.lit(-1000.0) * F.log(-F.log(uniform)))


def draw(scored: DataFrame, percent: int, min_words: int) -> DataFrame:
    """``scored`` with the rank of each drawn row: the highest scores among rows of at least ``min_words`` words."""
    eligible = F.col("n_words") >= min_words
    bins = sorted(((r["bin"], r["n"]) for r in scored.where(eligible).groupBy(F.floor(F.col("score") / BIN).alias("bin"))
                   .agg(F.count(F.lit(1)).alias("n")).collect()), reverse=True)
    wanted = percent * sum(n for _, n in bins) // 100
    edge, above = None, 0
    for number, n in bins:
        if above >= wanted:
            break
        edge, above = number * BIN, above + n
    if edge is None:
        return scored.withColumn("rank", F.lit(None).cast("bigint"))
    high = eligible & (F.col("score") >= edge)
    order = ["_down", "doc_id", "weight", "n_features"]
    ranked = row_index(scored.where(high).withColumn("_down", -F.col("score")), order, "_at").drop("_down")
    drawn = ranked.withColumn("rank", F.when(F.col("_at") < wanted, F.col("_at") + 1).cast("bigint")).drop("_at")
    return drawn.unionByName(scored.where(~high).withColumn("rank", F.lit(None).cast("bigint")))


def resample(docs: DataFrame, target: DataFrame, longest: int = 1, buckets: int = BUCKETS, seed: int = 2024, percent: int = 10,
             min_words: int = 20, id_column: str = "doc_id", text_column: str = "text", target_column: str = "text") -> DataFrame:
    """Every document's ``doc_id``, ``n_features``, ``n_words``, ``weight``, ``score`` and ``rank`` (null: not drawn)."""
    gain = gains(bucket_counts(docs, longest, buckets, text_column), bucket_counts(target, longest, buckets, target_column))
    weighed = weigh(docs, gain, longest, id_column, text_column)
    return draw(staged(weighed.withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed)), "scored"), percent, min_words)
