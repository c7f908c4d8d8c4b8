"""Samples, counters with a guarantee, QR trees and sampled cosines against plain computation."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.operators import linear, sampling, sketches


@pytest.fixture(scope="module")
def strata(spark):
    draw = random.Random(3)
    rows = [(i, draw.choice(["hot"] * 8 + ["a", "b", None])) for i in range(6000)] + [(6000, "single")]
    return spark.createDataFrame(rows, "id int, k string").repartition(5).cache()


@pytest.mark.parametrize("fractions", [0.1, 0.0, 1.0, {"hot": 0.3, "a": 0.005, "single": 0.2}])
def test_stratified_sample_is_exact(strata, many_blocks, fractions):
    sizes = Counter(r.k for r in strata.collect())
    share = lambda k: fractions.get(k, 0.0) if isinstance(fractions, dict) else fractions
    kept = sampling.sample_by_key_exact(strata, "k", fractions, ["id"]).collect()
    assert Counter(r.k for r in kept) == Counter({k: q for k, n in sizes.items() if (q := math.ceil(n * share(k)))})
    assert len({r.id for r in kept}) == len(kept)
    again = sampling.sample_by_key_exact(strata.repartition(3), "k", fractions, ["id"]).collect()
    assert {r.id for r in kept} == {r.id for r in again}


def test_only_waiting_rows_are_sorted(strata):
    accepted, waiting = sampling.accept_and_wait(strata, "k", 0.4, ["id"], bins=500)
    n = strata.count()
    assert 0.35 * n < accepted.count() <= math.ceil(0.4 * n) and waiting.count() < 0.02 * n
    assert "rangepartitioning" not in accepted._jdf.queryExecution().executedPlan().toString()


def test_stratified_draws_with_replacement(strata, many_blocks):
    sizes = Counter(r.k for r in strata.collect())
    kept = sampling.sample_by_key_exact(strata, "k", {"hot": 2.0, "a": 0.5}, ["id"], with_replacement=True).collect()
    assert Counter(r.k for r in kept) == {"hot": 2 * sizes["hot"], "a": math.ceil(sizes["a"] / 2)}
    # Two draws per row on average leave about e^-2 of the rows undrawn.
    assert 0.8 < len({r.id for r in kept if r.k == "hot"}) / sizes["hot"] < 0.93


def test_take_sample_draws_the_same_rows_again(strata):
    one = {r.id for r in sampling.take_sample(strata, 50, 4, order=["id"]).collect()}
    two = {r.id for r in sampling.take_sample(strata.repartition(7), 50, 4, order=["id"]).collect()}
    assert one == two and len(one) == 50 and one != {r.id for r in sampling.take_sample(strata, 50, 5, order=["id"]).collect()}


@pytest.mark.parametrize("share, tasks", [(0.05, 1), (0.02, 6), (0.2, 3)])
def test_counters_contain_the_exact_counts(spark, share, tasks):
    """More distinct values than counters: bounds hold for every reported value, and no frequent value is missing."""
    draw = random.Random(12)
    values = [int(draw.paretovariate(0.6)) for _ in range(9000)] + [None] * 40
    draw.shuffle(values)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "300")
    try:
        frame = spark.createDataFrame([(v,) for v in values], "v bigint").repartition(tasks)
        got = {r.v: (r.lower, r.upper) for r in sketches.frequent_values(frame, "v", share).collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
    exact = Counter(values)
    assert all(low <= exact[v] <= high for v, (low, high) in got.items())
    assert {v for v, n in exact.items() if v is not None and n >= share * len(values)} <= set(got)
    assert all(high - low <= share * len(values) / 2 + 1 for low, high in got.values())
    assert sketches.frequent_values(frame.limit(0), "v", share).count() == 0


def matrix_frame(spark, m, tasks=5):
    return spark.createDataFrame([(i, [float(x) for x in row]) for i, row in enumerate(m)], "id int, v array<double>").repartition(tasks)


def test_small_singular_values_keep_their_digits(spark, monkeypatch):
    """Values 1 and 1e-10 in one matrix: products of columns would lose the second."""
    monkeypatch.setattr(linear, "MERGED", 2)
    draw = np.random.default_rng(1)
    left, _ = np.linalg.qr(draw.normal(size=(400, 4)))
    right, _ = np.linalg.qr(draw.normal(size=(4, 4)))
    wanted = [1.0, 1e-3, 1e-7, 1e-10]
    got = [r.sigma for r in linear.singular_values(matrix_frame(spark, left * wanted @ right.T, 7), "v").orderBy("k").collect()]
    assert got == pytest.approx(wanted, rel=1e-5)


def test_singular_values_of_odd_matrices(spark):
    wide = np.arange(8.0).reshape(2, 4)
    got = [r.sigma for r in linear.singular_values(matrix_frame(spark, wide), "v").orderBy("k").collect()]
    assert got == pytest.approx([*np.linalg.svd(wide, compute_uv=False), 0, 0], abs=1e-12)
    nulls = matrix_frame(spark, wide).unionByName(spark.createDataFrame([(9, None)], "id int, v array<double>"))
    assert [r.sigma for r in linear.singular_values(nulls, "v").orderBy("k").collect()] == pytest.approx(got)
    assert linear.singular_values(nulls.limit(0), "v").count() == 0


def test_sampled_cosines(spark):
    """Near the exact values where entries are really left out, equal on two runs, and without an RDD in the plan."""
    draw = np.random.default_rng(4)
    base = draw.normal(size=(6000, 3))
    m = np.concatenate([base, base + 0.5 * draw.normal(size=(6000, 3)), np.zeros((6000, 1))], axis=1)
    frame = matrix_frame(spark, m)
    runs = [{(r.i, r.j): r.cosine for r in linear.sampled_column_cosines(frame, "v", 0.5, ["id"], seed=seed).collect()} for seed in range(10)]
    got = runs[3]
    norm = np.sqrt((m ** 2).sum(axis=0))
    assert np.sqrt(10 * np.log(7) / 0.5) / norm[0] < 0.15  # most entries are left out
    for i in range(6):
        for j in range(i + 1, 6):
            exact = m[:, i] @ m[:, j] / norm[i] / norm[j]
            estimates = [r.get((i, j), 0.0) for r in runs]
            assert np.mean(estimates) == pytest.approx(exact, abs=0.2) and max(abs(e - exact) for e in estimates) < 0.9
    again = {(r.i, r.j): r.cosine for r in linear.sampled_column_cosines(frame.repartition(3), "v", 0.5, ["id"], seed=3).collect()}
    assert again == pytest.approx(got)
    exact = {(r.i, r.j): r.cosine for r in linear.sampled_column_cosines(frame, "v", 0.0, ["id"]).collect()}
    assert exact[0, 3] == pytest.approx(m[:, 0] @ m[:, 3] / norm[0] / norm[3])
