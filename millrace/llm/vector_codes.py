"""Vector code compression: each part of a vector becomes the number of the nearest entry of the part's codebook.

The nearest entry is found by slicing. Along each dimension the entries' coordinates are sorted, and before each
position a bit mask (64-bit words) says which entries come earlier; the entries between two positions are one mask
without the other. For a point and a radius two searches per dimension give such a mask, and the masks of all
dimensions are ANDed: what is left is exactly the entries in the box of that radius, and only these are compared. When
the nearest of them is no farther than the radius, no entry outside the box can be as near, ties included. Otherwise
the radius grows, to the distance found or, in an empty box, to twice itself, and only new entries are compared.

Codebooks (a fixed number of entries) travel to the tasks; a task sends back one sum and one count per entry and
position. Rows are read from a written table of whole numbers in every round.

Defined results: vectors that are null or hold null or non-finite components are left out; shorter vectors count as
filled with zeros, also up to the next multiple of the number of parts; rows that repeat get a row each, and a null id
starts no codebook entry before other ids do; null labels are one label; with fewer kept rows than entries a codebook
is that much smaller; an empty table gives no rows; other columns are ignored. All arithmetic is in whole numbers; where
components are so large that distances could pass 2^63 a ValueError says so.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from millrace.llm.batches import small_batches
from millrace.llm.vectors import largest, matrix, usable, whole
from millrace.plans.durable import staged
from millrace.plans.sizing import balanced, broadcast_if_small

ENTRIES = 256
PAIRS = 1 << 18
FAR = np.iinfo(np.int64).max


class SlicedCodebook:
    """The entries of one part, sorted along each dimension, with masks of the entries before each position."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        n, width = entries.shape
        order = np.argsort(entries, axis=0, kind="stable")
        self.sorted = np.take_along_axis(entries, order, axis=0).T.copy()
        self.earlier = np.zeros((width, n + 1, -(-n // 64)), np.uint64)
        for i in range(n):
            self.earlier[:, i + 1] = self.earlier[:, i]
            bit = np.uint64(1) << (order[i] % 64).astype(np.uint64)
            self.earlier[np.arange(width), i + 1, order[i] // 64] |= bit
        self.radius = self._typical()

    def _typical(self) -> int:
        """Half the median distance between an entry and its nearest other one: where boxes begin to hold entries."""
        apart = ((self.entries[:, None, :] - self.entries[None, :, :]) ** 2).sum(axis=2)
        apart[np.eye(len(apart), dtype=bool)] = FAR
        nearest = apart.min(axis=1)
        return 1 + math.isqrt(int(np.median(nearest[nearest < FAR]))) // 2 if len(apart) > 1 else 1

    def box(self, points: np.ndarray, radius: np.ndarray) -> np.ndarray:
        """Masks of the entries whose every coordinate is within ``radius`` of the point's."""
        result = np.full((len(points), self.earlier.shape[2]), ~np.uint64(0))
        for d, line in enumerate(self.sorted):
            first = np.searchsorted(line, points[:, d] - radius, "left")
            last = np.searchsorted(line, points[:, d] + radius, "right")
            result &= self.earlier[d, last] & ~self.earlier[d, first]
        return result

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of the nearest entry of each point, ties to the lower, and its squared distance."""
        n, size = len(points), len(self.entries)
        best = np.full(n, FAR)
        seen = np.zeros((n, self.earlier.shape[2]), np.uint64)
        open_, radius = np.arange(n), np.full(n, self.radius, np.int64)
        while len(open_):
            inside = self.box(points[open_], radius[open_])
            fresh = inside & ~seen[open_]
            seen[open_] = inside
            bits = np.unpackbits(fresh.view(np.uint8), axis=1, bitorder="little")
            row, entry = np.nonzero(bits)
            row = open_[row]
            for start in range(0, len(row), PAIRS):
                r, e = row[start:start + PAIRS], entry[start:start + PAIRS]
                apart = points[r] - self.entries[e]
                # Distance first, then the entry's number: the least of these is the nearest, ties to the lower.
                key = np.einsum("ij,ij->i", apart, apart) * size + e
                at = np.flatnonzero(np.diff(r, prepend=-1))
                best[r[at]] = np.minimum(best[r[at]], np.minimum.reduceat(key, at))
            distance = best[open_] // size
            empty = best[open_] == FAR
            done = ~empty & (distance <= radius[open_] ** 2)
            grown = np.where(empty, 2 * radius[open_], np.ceil(np.sqrt(distance.astype(np.float64))).astype(np.int64) + 1)
            radius[open_] = np.where(done, radius[open_], grown)
            open_ = open_[~done]
        return best % size, best // size


def _parts(lists: pa.Array, width: int, n_parts: int) -> list[np.ndarray]:
    return np.split(matrix(lists, width), n_parts, axis=1)


def _sums(rows: DataFrame, books: list[np.ndarray], width: int) -> dict[int, np.ndarray]:
    """Per part an array (entry, position) of sums with the count behind them, over all rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sliced = [SlicedCodebook(b) for b in books]
        total = [np.zeros((len(b), b.shape[1] + 1), np.int64) for b in books]
        for batch in batches:
            for points, book, own in zip(_parts(batch.column(0), width, len(books)), sliced, total):
                code, _ = book.nearest(points)
                order = np.argsort(code, kind="stable")
                at = np.flatnonzero(np.diff(code[order], prepend=-1))
                if len(at):
                    used = code[order][at]
                    own[used, :-1] += np.add.reduceat(points[order], at, axis=0)
                    own[used, -1] += np.diff(at, append=len(code))
        for part, own in enumerate(total):
            entry, position = np.nonzero(np.broadcast_to(own[:, -1:] > 0, own.shape))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(entry), part)), pa.array(entry), pa.array(position), pa.array(own[entry, position])],
                names=["part", "entry", "position", "total"])

    summed = (rows.select("v").mapInArrow(run, "part bigint, entry bigint, position bigint, total bigint")
              .groupBy("part", "entry", "position").agg(F.sum("total").alias("total")))
    result = {part: np.zeros((len(b), b.shape[1] + 1), np.int64) for part, b in enumerate(books)}
    for r in summed.collect():
        result[r.part][r.entry, r.position] = r.total
    return result


def fit(rows: DataFrame, width: int, n_parts: int, rounds: int, entries: int = ENTRIES) -> list[np.ndarray]:
    """Codebooks: they start at the smallest ids and move to the floored means of what is nearest to them."""
    first = rows.orderBy(F.asc_nulls_last("id"), "v").limit(entries).select("v").collect()
    start = matrix(pa.array([r.v for r in first], pa.list_(pa.int64())), width)
    books = np.split(start, n_parts, axis=1)
    for _ in range(rounds):
        for part, total in _sums(rows, books, width).items():
            used = total[:, -1] > 0
            moved = books[part].copy()
            moved[used] = total[used, :-1] // total[used, -1:]
            books[part] = moved
    return books


def assign(rows: DataFrame, books: list[np.ndarray], width: int) -> DataFrame:
    """``id``, ``label``, ``code`` (two hexadecimal digits a part) and ``error`` of every row."""
    key, label = (rows.schema[c].dataType for c in ("id", "label"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sliced = [SlicedCodebook(b) for b in books]
        for batch in batches:
            found = [book.nearest(points) for points, book in zip(_parts(batch.column(2), width, len(books)), sliced)]
            codes = np.stack([code for code, _ in found], axis=1).astype(np.uint8)
            error = sum(distance for _, distance in found)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([c.tobytes().hex() for c in codes], pa.string()),
                                              pa.array(error, pa.int64())], schema=schema)

    schema = pa.schema([("id", to_arrow_type(key)), ("label", to_arrow_type(label)), ("code", pa.string()), ("error", pa.int64())])
    return rows.select("id", "label", "v").mapInArrow(run, f"id {key.simpleString()}, label {label.simpleString()}, code string, error bigint")


def digest(books: list[np.ndarray]) -> str:
    """Checksum of all components in decimal, by part, entry and position."""
    return hashlib.sha256(",".join(str(x) for b in books for x in b.ravel().tolist()).encode()).hexdigest()


def compress(df: DataFrame, n_parts: int = 4, rounds: int = 4, scale: int = 1024, entries: int = ENTRIES, id_column: str = "vec_id",
             vector_column: str = "embedding", label_column: str = "label") -> DataFrame:
    """``vec_id``, ``code``, ``error``, ``label_error`` (sum over equal labels) and ``codebooks_sha256``."""
    if not 0 < entries <= 256:
        raise ValueError("a code has two hexadecimal digits a part: at most 256 entries")
    spark = df.sparkSession
    small_batches(spark)
    kept = df.where(usable(F.col(vector_column))).select(F.col(id_column).alias("id"), F.col(label_column).alias("label"),
                                                         whole(F.col(vector_column), scale).alias("v"))
    rows = staged(kept, "vectors")
    size = rows.agg(F.max(F.size("v")).alias("width"), F.max(largest(F.col("v"))).alias("largest")).first()
    width = max(1, -(-(size.width or 0) // n_parts)) * n_parts
    if 4 * (size.largest or 0) ** 2 * width * 256 >= 2 ** 63:
        raise ValueError("components too large for distances in 63 bits; use a smaller scale")
    spread = balanced(rows)
    books = fit(spread, width, n_parts, rounds, entries) if size.width is not None else []
    if not books:
        return rows.select(F.col("id").alias("vec_id"), F.lit("").alias("code"), F.lit(0).cast("bigint").alias("error"),
                           F.lit(0).cast("bigint").alias("label_error"), F.lit("").alias("codebooks_sha256"))
    coded = staged(assign(spread, books, width), "codes")
    per_label = staged(coded.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error")), "labels")
    joined = coded.join(broadcast_if_small(per_label), F.col("label").eqNullSafe(F.col("_label")))
    return joined.select(F.col("id").alias("vec_id"), "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))
