"""Inputs without negatives, predictions or spread; long spans of time."""

import datetime as dt

from pyspark.sql import functions as F

from millrace.catalog import streams
from millrace.operators.evaluation import regression_metrics, threshold_metrics
from millrace.sources.readers import file_inventory
from millrace.streaming.learning import welch


def test_thresholds_without_negatives(spark):
    counts = spark.createDataFrame([(0.5, 3, 0), (0.2, 4, 0)], "threshold double, tp bigint, fp bigint")
    assert [r.fpr for r in threshold_metrics(counts).collect()] == [None, None]


def test_constant_label(spark):
    df = spark.createDataFrame([(1.0, 1.0), (1.0, 2.0)], "y double, p double")
    row = regression_metrics(df, "y", "p").first()
    assert row.r2 is None and row.mse == 0.5


def test_welch_without_spread(spark):
    df = spark.createDataFrame([(False, 3, 1.0, 0.0), (True, 3, 2.0, 0.0)], "g boolean, n bigint, mean double, variance double")
    assert welch(df, "g").first().t is None


def test_slices_of_two_years_are_in_order(spark):
    start = dt.datetime(2023, 1, 1)
    df = spark.createDataFrame([(start + dt.timedelta(days=d),) for d in range(0, 730, 10)], "ts timestamp_ntz")
    spans = streams._sliced(df).groupBy("slice").agg(F.min("ts").alias("a"), F.max("ts").alias("b")).orderBy("slice").collect()
    assert [r.slice for r in spans] == [0, 1, 2]
    assert spans[0].b < spans[1].a and spans[1].b < spans[2].a


def test_inventory_takes_names_literally(spark, tmp_path):
    for name in ("a[1].txt", "b1.txt"):
        (tmp_path / name).write_text("x")
    names = [r.path.rsplit("/", 1)[1] for r in file_inventory(spark, str(tmp_path), "[1]").collect()]
    assert [n.replace("%5B", "[").replace("%5D", "]") for n in names] == ["a[1].txt"]
