"""Best items by bounds against the full product."""

import tracemalloc
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest

from millrace.operators import recommend
from millrace.registry import registered


def frame(spark, m, start=0):
    return spark.createDataFrame([(i + start, [float(x) for x in row]) for i, row in enumerate(m)], "id int, features array<float>")


@pytest.mark.parametrize("k, n", [(5, 900), (3, 2)])
def test_top_items_equal_the_full_product(spark, k, n):
    """Few long items end most searches early; ties, copies and rows without factors included."""
    draw = np.random.default_rng(3)
    users = draw.normal(size=(60, 4)).astype(np.float32)
    items = (draw.normal(size=(n, 4)) * draw.pareto(2.0, size=(n, 1))).astype(np.float32)
    items[1] = items[0]
    nulls = spark.createDataFrame([(5000, None), (None, [1.0] * 4)], "id int, features array<float>")
    visited = []
    got = recommend.top_items(frame(spark, users).unionByName(nulls), frame(spark, items, 100).unionByName(nulls), k, visited=visited, first=16).collect()
    full = users.astype(float) @ items.astype(float).T
    want = {(u, r + 1): (100 + int(i), full[u, i]) for u in range(60) for r, i in enumerate(np.lexsort((np.arange(n), -full[u]))[:k])}
    assert {(r.user, r["rank"]): r.item for r in got} == {key: i for key, (i, _) in want.items()}
    assert all(r.score == pytest.approx(want[r.user, r["rank"]][1]) for r in got)
    if n > 100:
        assert visited[0] == 60 and visited[-1] < 20 and sum(visited) < 60 * 6
    assert recommend.top_items(frame(spark, users).limit(0), frame(spark, items), k).count() == 0
    assert recommend.top_items(frame(spark, users), frame(spark, items).limit(0), k).count() == 0


def test_scores_of_a_block_are_never_held_whole():
    """A batch of users and a block of items: 10,000 x 65,536 scores take 5 GB, a task holds a tile of them."""
    draw = np.random.default_rng(4)
    own, matrix = draw.normal(size=(2_000, 10)).astype(np.float32).astype(float), draw.normal(size=(20_000, 10)).astype(np.float32).astype(float)
    batch = pa.RecordBatch.from_arrays([pa.array(range(2_000)), pa.array(own.tolist()), pa.array([1.0] * 2_000), pa.array([[]] * 2_000, pa.list_(pa.int64())),
                                        pa.array([[]] * 2_000, pa.list_(pa.float64()))], names=["user", "f", "length", "items", "scores"])
    held = {}
    context = SimpleNamespace(broadcast=lambda value: SimpleNamespace(value=value))
    frame = SimpleNamespace(sparkSession=SimpleNamespace(sparkContext=context), mapInArrow=lambda run, schema: held.update(run=run))
    frame.select = lambda *columns: frame
    recommend._merged(frame, np.arange(20_000), matrix, 10)
    tracemalloc.start()
    got = next(held["run"](iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 50 << 20
    for u in range(0, 2_000, 250):
        score = own[u] @ matrix.T
        assert got.column(3)[u].as_py() == np.lexsort((np.arange(20_000), -score))[:10].tolist()


def test_every_pair_is_scored_when_not_bounded(spark):
    draw = np.random.default_rng(5)
    users, items = draw.normal(size=(30, 4)).astype(np.float32), draw.normal(size=(500, 4)).astype(np.float32)
    items[200:] *= 0.01
    visited = []
    every = recommend.top_items(frame(spark, users), frame(spark, items), 5, visited=visited, first=16, bounded=False)
    assert sorted(every.collect()) == sorted(recommend.top_items(frame(spark, users), frame(spark, items), 5, first=16).collect())
    assert visited == [30] * 6


def test_recommendations_come_without_a_product_of_tables(spark, small):
    found = registered()["rec3_top_items_for_users"].run(spark, small)
    text = found._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in text and "NestedLoop" not in text
    assert found.dtypes == [("user", "int"), ("rank", "int"), ("item", "int"), ("rating", "float")]
    assert {tuple(r) for r in found.groupBy("user").agg({"rank": "max", "item": "count"}).select("max(rank)", "count(item)").collect()} == {(10, 10)}
