"""Feature operators that are not a single ``pyspark.ml.feature`` class."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.ml import Pipeline
from pyspark.ml.feature import RegexTokenizer, StopWordsRemover, VectorAssembler
from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions.vectors import libsvm_line
from millrace.operators import dictionary
from millrace.plans.durable import staged
from millrace.plans.ordering import row_index


def assemble(df: DataFrame, columns: Sequence[str], name: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(columns), outputCol=name).transform(df)


def _bounds(df: DataFrame, columns: Sequence[str]) -> dict:
    """Least and greatest value of each column, in one pass and one row."""
    return df.agg(*[F.min(c).alias(f"lo_{c}") for c in columns],
                  *[F.max(c).alias(f"hi_{c}") for c in columns]).first().asDict()


def minmax_levels(df: DataFrame, columns: Sequence[str], levels: int = 3) -> DataFrame:
    """int((x - min) / (max - min + 1) * levels) of each column."""
    b = _bounds(df, columns)
    scaled = {c: ((F.col(c) - b[f"lo_{c}"]) / (b[f"hi_{c}"] - b[f"lo_{c}"] + 1) * levels).cast("int") for c in columns}
    return df.withColumns(scaled)


def minmax_unit(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(x - min) / (max - min) of each column; null where a column is constant."""
    b = _bounds(df, columns)
    return df.withColumns({c: F.try_divide(F.col(c) - b[f"lo_{c}"], F.lit(b[f"hi_{c}"] - b[f"lo_{c}"])) for c in columns})


def to_libsvm(df: DataFrame, label: str, columns: Sequence[str]) -> DataFrame:
    return df.select(libsvm_line(F.col(label), F.array(*columns)).alias("value"))


def append_bias(df: DataFrame, vector: str, name: str) -> DataFrame:
    return VectorAssembler(inputCols=[vector, "_one"], outputCol=name).transform(
        df.withColumn("_one", F.lit(1.0))).drop("_one")


def reindex_labels(df: DataFrame, label: str, name: str = "label_index") -> DataFrame:
    """Sorted class labels numbered from 0; labels that are already 0 and 1 are kept."""
    classes = df.select(label).distinct()
    binary = classes.agg(F.bool_and(F.col(label).isin(0, 1))).first()[0]
    if binary:
        return df.withColumn(name, F.col(label).cast("bigint"))
    return df.join(row_index(classes, [label], name), label)


def text_corpus(docs: DataFrame, identity: str, text: str, vocabulary: int | None = None,
                stop_words: Sequence[str] = ()) -> tuple[DataFrame, dictionary.Dictionary]:
    """Number the documents, tokenise, drop stop words and count terms: (identity, row, features) and the dictionary.

    ``vocabulary`` keeps that many of the most frequent terms, None keeps all of them. Rows that repeat an identity
    are documents of their own.
    """
    rows = staged(row_index(docs.select(identity, text), [identity, text], "row"), "rows")
    tokens = Pipeline(stages=[
        RegexTokenizer(inputCol=text, outputCol="raw_tokens", pattern=r"\W"),
        StopWordsRemover(inputCol="raw_tokens", outputCol="tokens", stopWords=list(stop_words))]).fit(rows).transform(
            rows.withColumn(text, F.coalesce(text, F.lit(""))))
    counts = dictionary.row_term_counts(tokens, "row", "tokens")
    learned = dictionary.learn(counts, rows.count(), vocabulary)
    found = dictionary.numbered(counts, learned)
    return dictionary.sparse_vectors(rows.select(identity, "row"), "row", found, learned), learned


def quantile_buckets(df: DataFrame, column: str, order: Sequence[str], buckets: int, name: str) -> DataFrame:
    """Buckets between exact quantiles, read off the positions in ``order`` (a total order that begins with the column).

    Null and NaN values take no part in the quantiles and have a null bucket.
    """
    valid = df.where(F.col(column).isNotNull() & ~F.isnan(column))
    total = valid.count()
    cuts = sorted({-(-total * i // buckets) - 1 for i in range(1, buckets)} - {-1})
    found = row_index(valid.select(*order), order, "_at").where(F.col("_at").isin(cuts)).select(column).distinct()
    bounds = sorted(r[0] for r in found.collect())  # at most one per bucket
    above = [F.when(F.col(column) >= b, 1.0).otherwise(0.0) for b in bounds]
    bucket = reduce(Column.__add__, above, F.lit(0.0))
    return df.withColumn(name, F.when(F.col(column).isNotNull() & ~F.isnan(column), bucket))


def active_entries(vector: str) -> Column:
    """Positions and values of a vector's non-zero entries, without filling in the zeros."""
    raw = F.unwrap_udt(F.col(vector))
    dense = F.transform(raw["values"], lambda x, i: F.struct(i.cast("int").alias("pos"), x.alias("weight")))
    sparse = F.transform(F.arrays_zip(raw["indices"], raw["values"]),
                         lambda s: F.struct(s["indices"].alias("pos"), s["values"].alias("weight")))
    return F.filter(F.when(raw["type"] == 0, sparse).otherwise(dense), lambda s: s["weight"] != 0)


def term_rows(df: DataFrame, vector: str, vocabulary: Sequence[str], *keep: str) -> DataFrame:
    """Non-zero entries of a count vector over a given vocabulary as (term, weight) rows."""
    terms = F.broadcast(df.sparkSession.createDataFrame(list(enumerate(vocabulary)), "pos int, term string"))
    return df.select(*keep, F.inline(active_entries(vector))).join(terms, "pos").select(*keep, "term", "weight")
