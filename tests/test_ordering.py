"""Row numbers, running sums and carried values against plain Python, with one very hot key."""

import random

import pytest
from pyspark.sql import functions as F

from millrace.operators import sampling
from millrace.plans.ordering import BLOCK, carry_forward, range_blocks, row_index, running_sums
from millrace.plans.sizing import balanced
from millrace.plans.skew import salted_totals


@pytest.fixture
def rows():
    draw = random.Random(4)
    return [(i, "hot" if draw.random() < 0.6 else f"k{draw.randrange(40)}", draw.randrange(9),
             draw.choice([None, None, draw.randrange(100)])) for i in range(900)]


@pytest.fixture
def frame(spark, rows):
    shuffled = rows[:]
    random.Random(5).shuffle(shuffled)
    return spark.createDataFrame(shuffled, "id bigint, k string, v bigint, seen bigint").repartition(5)


def test_blocks_split_the_hot_key(frame, many_blocks):
    assert range_blocks(frame, ["k", "id"]).where("k = 'hot'").select(BLOCK).distinct().count() > 1


def test_row_index(frame, rows, many_blocks):
    order = sorted(rows, key=lambda r: (r[2], r[0]))
    got = {r["id"]: r["idx"] for r in row_index(frame, ["v", "id"]).collect()}
    assert got == {r[0]: i for i, r in enumerate(order)}


@pytest.mark.parametrize("keys", [[], ["k"]])
def test_running_sums(frame, rows, many_blocks, keys):
    totals, expected = {}, {}
    for r in rows:
        key = r[1] if keys else None
        totals[key] = totals.get(key, 0) + r[2]
        expected[r[0]] = totals[key]
    got = running_sums(frame, ["id"], {"s": F.col("v")}, keys=keys)
    assert {r["id"]: r["s"] for r in got.collect()} == expected


@pytest.mark.parametrize("keys", [[], ["k"]])
def test_carry_forward(frame, rows, many_blocks, keys):
    last, expected = {}, {}
    for r in rows:
        key = r[1] if keys else None
        if r[3] is not None:
            last[key] = r[3]
        expected[r[0]] = last.get(key)
    got = carry_forward(frame, ["id"], ["seen"], keys=keys)
    assert {r["id"]: r["seen"] for r in got.collect()} == expected


def test_salted_totals(frame, rows):
    expected = {}
    for r in rows:
        expected[r[1]] = expected.get(r[1], 0) + r[2]
    assert {r["k"]: r["s"] for r in salted_totals(frame, ["k"], {"s": F.col("v")}, salts=7).collect()} == expected


def test_exact_stratified_sample(frame, rows, many_blocks):
    sizes = {}
    for r in rows:
        sizes[r[1]] = sizes.get(r[1], 0) + 1
    kept = sampling.sample_by_key_exact(frame, "k", 0.25, ["id"])
    assert {r["k"]: r["count"] for r in kept.groupBy("k").count().collect()} == {k: -(-n // 4) for k, n in sizes.items()}


def test_samples_have_their_size(frame):
    assert sampling.take_sample(frame, 50, 3).select("id").distinct().count() == 50
    assert sampling.take_sample(frame, 1500, 3, with_replacement=True, order=["id"]).count() == 1500


def test_row_index_moves_rows_once(frame, many_blocks):
    """The written blocks are numbered where they are sorted: only one row per task is exchanged after that."""
    plan = row_index(frame, ["v", "id"])._jdf.queryExecution().executedPlan().toString()
    below_join = plan.split("BroadcastHashJoin")[1]
    assert "BroadcastExchange" in below_join and "Window [row_number" not in plan
    assert "hashpartitioning(_block" not in plan.split("BroadcastExchange")[0]


def test_balanced_starts_no_job(spark, frame):
    """Looking for the number of scan tasks compiles and runs nothing, also above a shuffle."""
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("look", "balanced")
    try:
        spread = balanced(frame.groupBy("k").count().join(spark.range(3), F.col("id") == F.col("count")))
        assert list(tracker.getJobIdsForGroup("look")) == []
    finally:
        spark.sparkContext.setJobGroup("", "")
    assert spread.count() >= 0
    cores = spark.sparkContext.defaultParallelism
    assert balanced(spark.range(10, numPartitions=1)).rdd.getNumPartitions() == cores
    assert balanced(spark.range(10, numPartitions=cores + 2)).rdd.getNumPartitions() == cores + 2
