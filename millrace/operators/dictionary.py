"""A dictionary of terms that never leaves the executors.

Terms are numbered by their place among all terms, most frequent first, with the row numbers of ``plans.ordering``. The
counts of a document are joined to the numbers: the most frequent terms, a fixed number of them, travel to every
task, and only counts of rarer terms are shuffled by term, so no join key is hot. Documents get sparse vectors.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from millrace.plans.durable import fresh_path, staged
from millrace.plans.ordering import row_index

FREQUENT = 20_000


@dataclass(frozen=True)
class Dictionary:
    """``terms`` is (term, pos, n, df): place, occurrences and documents of each term; ``documents`` counts all documents."""

    terms: DataFrame
    size: int
    documents: int


def term_counts(docs: DataFrame, identity: str, words: str) -> DataFrame:
    """(identity, term, n) for every document and distinct term of it; null terms do not count. Written.

    Documents are dealt by their identity once: counting needs no exchange of single words after that.
    """
    dealt = docs.select(identity, words).repartition(identity)
    single = dealt.select(identity, F.explode(words).alias("term")).where(F.col("term").isNotNull())
    return staged(single.groupBy(identity, "term").agg(F.count(F.lit(1)).alias("n")), "counts")


def row_term_counts(docs: DataFrame, identity: str, words: str) -> DataFrame:
    """As ``term_counts`` where no two rows share an identity: the words of a row are counted where it is read. Written."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            codes = lists.flatten().dictionary_encode()
            row = np.repeat(np.arange(batch.num_rows), pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False))
            known = codes.is_valid().to_numpy(zero_copy_only=False)
            code, terms = codes.indices.filter(pa.array(known)).to_numpy(zero_copy_only=False).astype(np.int64), len(codes.dictionary)
            if len(code):
                key, n = np.unique(row[known] * terms + code, return_counts=True)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(key // terms)), codes.dictionary.take(pa.array(key % terms)),
                                                  pa.array(n, pa.int64())], names=[identity, "term", "n"])

    schema = StructType([docs.schema[identity], StructField("term", StringType()), StructField("n", LongType(), False)])
    return staged(docs.select(identity, words).mapInArrow(counted, schema), "counts")


def learn(counts: DataFrame, documents: int, size: int | None = None, min_documents: int = 1) -> Dictionary:
    """All terms, or the ``size`` most frequent, that occur in so many documents; equal counts by the term itself."""
    totals = counts.groupBy("term").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("df")).where(F.col("df") >= min_documents)
    placed = row_index(totals.withColumn("_rarity", -F.col("n")), ["_rarity", "term"], "pos").drop("_rarity")
    terms = staged(placed if size is None else placed.where(F.col("pos") < size), "terms")
    return Dictionary(terms, terms.count(), documents)


def numbered(counts: DataFrame, dictionary: Dictionary) -> DataFrame:
    """``counts`` with the ``pos`` and ``df`` of each term; terms outside the dictionary are left out."""
    known = dictionary.terms.select("term", "pos", "df")
    frequent = F.broadcast(known.where(F.col("pos") < FREQUENT))
    if dictionary.size <= FREQUENT:
        return counts.join(frequent, "term")
    return counts.join(frequent, "term").unionByName(
        counts.join(frequent.select("term"), "term", "left_anti").join(known.where(F.col("pos") >= FREQUENT), "term"))


def idf(dictionary: Dictionary):
    """ln((m + 1) / (df + 1)) of a numbered term, m being the number of documents."""
    return F.log((F.lit(dictionary.documents) + 1) / (F.col("df") + 1))


def sparse_vectors(docs: DataFrame, identity: str, found: DataFrame, dictionary: Dictionary, weight: str = "n",
                   name: str = "features") -> DataFrame:
    """``docs`` with a sparse vector of the ``weight`` of their numbered terms; empty for a document without any.

    The vectors are written in the storage form of the vector type and read as vectors: no row passes through Python.
    """
    entry = F.struct(F.col("pos").cast("int").alias("i"), F.col(weight).cast("double").alias("x"))
    gathered = found.groupBy(F.col(identity).alias("_key")).agg(F.sort_array(F.collect_list(entry)).alias("_e"))
    entries = F.coalesce(F.col("_e"), F.array().cast("array<struct<i:int,x:double>>"))
    vector = F.struct(F.lit(0).cast("tinyint").alias("type"), F.lit(dictionary.size).alias("size"), entries["i"].alias("indices"),
                      entries["x"].alias("values"))
    joined = docs.join(gathered, F.col(identity) == F.col("_key"), "left").withColumn(name, vector).drop("_key", "_e")
    path = fresh_path(docs.sparkSession, "vectors")
    joined.write.parquet(path)
    fields = [f if f.name != name else StructField(name, VectorUDT()) for f in joined.schema.fields]
    return docs.sparkSession.read.schema(StructType(fields)).parquet(path)
