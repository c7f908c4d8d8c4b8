"""Exact top-k search by inner product, by global histograms of the scores.

Every query is scored against every row. The scores are not kept: a pass counts them per query in equal bins of the
interval that can hold the k-th highest score, the counts of all tasks are added up, and the next pass splits the bin
that the k-th score fell into, until a bin is one score wide and the k-th score is known exactly. A last pass gives the
rows above it and, of those equal to it, the smallest ids that fill up the k places.

A task leaves out bins below the one that holds its own k-th highest score: the global k-th score cannot lie there. So
it sends a few counts per query, whatever the number of rows. Queries are served in slabs of at most ``SLAB``, sent to
the executors as one matrix of that bounded size; a slab costs a few scans, whose work is the multiplication.

Defined results: vectors that are null or hold null or non-finite components, and rows with a null id, take no part;
shorter vectors count as filled with zeros; rows that repeat an id are each a query and a candidate, but never a
candidate of their own id; equal scores go to the smaller id; with fewer than k candidates all are returned; an empty
table, or one without queries, gives no rows; other columns are ignored. Scores must be exact in doubles: where the
greatest squared length reaches 2^53 a ValueError says so.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from millrace.llm.batches import small_batches
from millrace.llm.vectors import matrix, usable, whole
from millrace.plans.durable import fresh_path, staged
from millrace.plans.ordering import row_index
from millrace.plans.sizing import balanced

SLAB = 4096
BIN_BITS = 10
EXACT = 1 << 53
OUT = "query_id bigint, rank int, vec_id bigint, score bigint"


class Slab:
    """Some queries: ids, a matrix, and per query the interval [low, low + 2^bits) that holds the k-th score.

    ``above`` counts the scores beyond the interval. Few candidates (``short``) leave no k-th score: all are taken.
    """

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, longest: int, k: int):
        self.order = np.argsort(ids, kind="stable")
        self.ids, self.sorted, self.vectors, self.k = ids, ids[self.order], vectors.T.astype(np.float64), k
        self.bits = int(2 * longest + 2).bit_length()
        self.low = np.full(len(ids), -longest - 1, np.int64)
        self.above = np.zeros(len(ids), np.int64)
        self.short = np.zeros(len(ids), bool)

    @property
    def shift(self) -> int:
        return max(0, self.bits - BIN_BITS)

    def scores(self, ids: np.ndarray, vectors: np.ndarray) -> np.ndarray:
        """Rows by queries; a query's own rows are below every score."""
        result = vectors.astype(np.float64) @ self.vectors
        first, last = (np.searchsorted(self.sorted, ids, side) for side in ("left", "right"))
        for row in np.flatnonzero(last > first):
            result[row, self.order[first[row]:last[row]]] = -np.inf
        return result

    def narrow(self, found: list[tuple[int, int, int]]) -> None:
        """Go on with the bin of the k-th score: (query, bin or None, scores beyond that bin)."""
        left = np.ones(len(self.ids), bool)
        for query, number, beyond in found:
            left[query] = False
            self.low[query] += number << self.shift
            self.above[query] += beyond
        self.short |= left
        self.bits = self.shift


def histogram(slab: Slab, rows: Iterator[tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[int, int, int]]:
    """(query, bin, scores) of one task, without the bins below its own k-th highest score."""
    shift, n = slab.shift, len(slab.ids)
    bins = 1 << (slab.bits - shift)
    counts = np.zeros((n, bins), np.int64)
    least = np.zeros(n, np.int64)
    need = slab.k - slab.above
    end = slab.low + (1 << slab.bits)
    for ids, vectors in rows:
        scores = slab.scores(ids, vectors)
        row, query = np.nonzero((scores >= (slab.low + (least << shift))[None, :]) & (scores < end[None, :]))
        number = (scores[row, query].astype(np.int64) - slab.low[query]) >> shift
        np.add.at(counts, (query, number), 1)
        touched = np.unique(query)
        least[touched] = _kth_bin(counts[touched], need[touched])
    counts[np.arange(bins)[None, :] < least[:, None]] = 0
    for query, number in zip(*(a.tolist() for a in np.nonzero(counts))):
        yield query, number, int(counts[query, number])


def _kth_bin(table: np.ndarray, need: np.ndarray) -> np.ndarray:
    """The highest bin with at least ``need`` scores in it and beyond, 0 if there is none."""
    beyond = np.cumsum(table[:, ::-1], axis=1)
    reached = beyond >= need[:, None]
    return np.where(reached.any(axis=1), table.shape[1] - 1 - reached.argmax(axis=1), 0)


def winners(slab: Slab, rows: Iterator[tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[int, int, int]]:
    """(query, id, score) above the k-th score, and the smallest ids that equal it: what one task can contribute."""
    limit = np.where(slab.short, -float(EXACT), slab.low)
    ties: dict[int, list[int]] = {}
    for ids, vectors in rows:
        scores = slab.scores(ids, vectors)
        row, query = np.nonzero(scores >= limit[None, :])
        for r, q in zip(row.tolist(), query.tolist()):
            score = int(scores[r, q])
            if slab.short[q] or score > slab.low[q]:
                yield q, int(ids[r]), score
            else:
                ties.setdefault(q, []).append(int(ids[r]))
        for q, held in ties.items():
            if len(held) > slab.k - slab.above[q]:
                ties[q] = sorted(held)[:slab.k - slab.above[q]]
    for q, held in ties.items():
        for key in held:
            yield q, key, int(slab.low[q])


def _scan(rows: DataFrame, width: int, step, slab, schema: str) -> DataFrame:
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = ((b.column(0).to_numpy(), matrix(b.column(1), width)) for b in batches if b.num_rows)
        held: list[tuple] = []
        for row in step(slab.value, read):
            held.append(row)
            if len(held) == 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*held)], names=names)
                held = []
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*held)], names=names)

    return rows.mapInArrow(run, schema)


def _locate(counts: DataFrame, slab: Slab) -> list[tuple[int, int, int]]:
    """Per query the bin of its k-th score and the scores beyond that bin, from the counts of all tasks."""
    spark = counts.sparkSession
    need = spark.createDataFrame([(i, int(slab.k - a)) for i, a in enumerate(slab.above)], "query bigint, need bigint")
    total = counts.groupBy("query", "bin").agg(F.sum("n").alias("n"))
    running = total.withColumn("upto", F.sum("n").over(W.partitionBy("query").orderBy(F.desc("bin"))))
    found = (running.join(F.broadcast(need), "query").where("upto >= need")
             .groupBy("query").agg(F.max_by(F.struct("bin", (F.col("upto") - F.col("n")).alias("beyond")), "bin").alias("at")))
    return [(r["query"], r["at"]["bin"], r["at"]["beyond"]) for r in found.collect()]


def _search(spark: SparkSession, rows: DataFrame, width: int, longest: int, queries: list, k: int) -> DataFrame:
    """Result of one slab of queries, given as (id, components)."""
    vectors = np.zeros((len(queries), width), np.int64)
    for i, (_, components) in enumerate(queries):
        vectors[i, :len(components)] = components
    slab = Slab(np.array([q[0] for q in queries], np.int64), vectors, longest, k)
    while slab.bits > 0:
        shared = spark.sparkContext.broadcast(slab)
        found = _locate(_scan(rows, width, histogram, shared, "query bigint, bin bigint, n bigint"), slab)
        shared.destroy()
        slab.narrow(found)
    # Queries without a k-th score: narrow() left their interval where it was, above counts nothing of theirs.
    shared = spark.sparkContext.broadcast(slab)
    best = _scan(rows, width, winners, shared, "query bigint, vec_id bigint, score bigint")
    place = F.row_number().over(W.partitionBy("query").orderBy(F.desc("score"), "vec_id"))
    ids = F.broadcast(spark.createDataFrame([(i, int(q)) for i, q in enumerate(slab.ids)], "query bigint, query_id bigint"))
    return best.withColumn("rank", place).where(F.col("rank") <= k).join(ids, "query").select("query_id", "rank", "vec_id", "score")


def top_k(df: DataFrame, is_query: Column, k: int = 5, scale: int = 256, id_column: str = "vec_id",
          vector_column: str = "embedding") -> DataFrame:
    """``query_id``, ``rank`` from 1, ``vec_id`` and ``score`` of the k best rows of each row where ``is_query``."""
    spark = df.sparkSession
    small_batches(spark)
    chosen = df.where(usable(F.col(vector_column)) & F.col(id_column).isNotNull())
    rows = staged(chosen.select(F.col(id_column).cast("bigint").alias("vec_id"), whole(F.col(vector_column), scale).alias("v"),
                                F.coalesce(is_query, F.lit(False)).alias("asks")), "vectors")
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    size = rows.agg(F.max(F.size("v")).alias("width"), F.max(square).alias("square"), F.count_if("asks").alias("asks")).first()
    if not size.asks:
        return spark.createDataFrame([], OUT)
    if size.square >= EXACT:
        raise ValueError("scores of 2^53 or more are not exact; use a smaller scale")
    candidates = balanced(rows.select("vec_id", "v"))
    asked = staged(row_index(rows.where("asks").select("vec_id", "v"), ["vec_id", "v"], "at"), "queries")
    path = fresh_path(spark, "best")
    for number, start in enumerate(range(0, size.asks, SLAB)):
        part = asked.where(F.col("at").between(start, start + SLAB - 1)).orderBy("at").select("vec_id", "v").collect()
        found = _search(spark, candidates, size.width, int(size.square) + 1, [tuple(r) for r in part], k)
        found.write.parquet(f"{path}/slab={number}")
    return spark.read.schema(OUT).parquet(path).select("query_id", "rank", "vec_id", "score")
