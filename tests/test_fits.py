"""What fits read: words counted and hashed once, tasks of bounded size."""

from collections import Counter

import pytest
from pyspark.ml import clustering as cu
from pyspark.sql import functions as F

from millrace.catalog import invariants, learning
from millrace.operators import dictionary
from millrace.operators.features import active_entries


def test_words_of_a_row_are_counted_without_an_exchange(spark, monkeypatch):
    rows = [(1, ["b", "a", "b", None]), (2, []), (3, None), (4, ["ä", "a"])]
    df = spark.createDataFrame(rows, "row bigint, t array<string>")
    plans = []
    monkeypatch.setattr(dictionary, "staged", lambda d, label: plans.append(d._jdf.queryExecution().sparkPlan().toString()) or d)
    found = {(r["row"], r["term"]): r["n"] for r in dictionary.row_term_counts(df, "row", "t").collect()}
    assert found == {(i, w): n for i, t in rows for w, n in Counter(w for w in t or [] if w is not None).items()}
    assert "Exchange" not in plans[0] and "Aggregate" not in plans[0]


def test_grid_points_read_vectors_of_their_size(spark, small):
    points = learning._hashed_texts(spark, small)
    tf, _, stages = learning._text_stages()
    for n in (10, 100, 1000):
        words = stages.getStages()[0].transform(learning._texts(spark, small))
        expected = tf.copy({tf.numFeatures: n}).transform(words).select("doc_id", F.col("features").cast("string").alias("v"))
        assert sorted(map(tuple, expected.collect())) == sorted(
            map(tuple, points.select("doc_id", F.col(f"features{n}").cast("string")).collect()))
    points.unpersist()


def test_perplexity_comes_from_the_likelihood(spark, small, monkeypatch):
    corpus, _ = learning._corpus(spark, small)
    words = corpus.select(F.sum(F.aggregate(active_entries("features"), F.lit(0.0), lambda a, e: a + e["weight"]))).first()[0]

    def again(*_):
        raise AssertionError("topics are inferred again")

    monkeypatch.setattr(cu.DistributedLDAModel, "logPerplexity", again)
    rows = learning.clu6_em(spark, small).collect()
    assert rows and all(r["log_perplexity"] == pytest.approx(-r["log_likelihood"] / words) for r in rows)


def test_a_task_of_a_fit_reads_a_bounded_number_of_points(spark, monkeypatch):
    monkeypatch.setattr(invariants, "POINTS", 50)
    before = spark.conf.get("spark.sql.files.minPartitionNum", None)
    seen = []

    class Estimator:
        def fit(self, points):
            seen.append(points.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0])

    df = spark.range(4000).withColumn("label", F.lit(1.0)).repartition(2)
    _, points = invariants._fitted(Estimator(), df)
    assert points.count() == 4000 and seen[0] <= 100
    assert spark.conf.get("spark.sql.files.minPartitionNum", None) == before
