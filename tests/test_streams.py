"""Streams: a stop and a repeated batch change nothing; state equals the batch result."""

import datetime as dt
import math
import subprocess
import sys
import time
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.registry import registered
from millrace.sources import views
from millrace.sources.tables import table
from millrace.streaming import feed, learning, stateful


def numbers(spark, rows=300):
    return spark.range(rows).select("id", (F.col("id") % 7).cast("string").alias("k"), F.floor(F.col("id") * 3 / rows).cast("int").alias("slice"))


def test_restart_continues_and_repeat_replaces(spark):
    out = feed.BatchTable(spark, "repeat")
    replay = feed.Replay(spark, {"n": numbers(spark)})
    seen = []

    def each(df, number):
        seen.append(number)
        out.write(df.groupBy("k").count(), number)
        out.write(df.groupBy("k").count(), number)

    replay.run(lambda s: s, each)
    assert seen == [0, 1, 2]
    assert out.read().agg(F.sum("count")).first()[0] == 300
    # A further run without new files finds nothing to do.
    query = replay.stream("n").writeStream.option("checkpointLocation", f"{replay.root}/checkpoint").trigger(availableNow=True).foreachBatch(each).start()
    query.awaitTermination()
    assert seen == [0, 1, 2]


def test_failed_batch_runs_again(spark):
    out = feed.BatchTable(spark, "failed")
    replay = feed.Replay(spark, {"n": numbers(spark)}, slices=1)

    def broken(df, number):
        out.write(df.groupBy("k").count(), number)
        raise RuntimeError("lost after the write")

    with pytest.raises(Exception):
        replay.run(lambda s: s, broken)
    query = replay.stream("n").writeStream.option("checkpointLocation", f"{replay.root}/checkpoint").trigger(availableNow=True).foreachBatch(
        lambda df, i: out.write(df.groupBy("k").count(), i)).start()
    query.awaitTermination()
    assert out.read().agg(F.sum("count")).first()[0] == 100


def test_updates_equal_batch(spark):
    got = feed.updates(spark, {"n": numbers(spark)}, lambda s: s.groupBy("k").agg(F.count(F.lit(1)).alias("n")), ["k"])
    assert {r["k"]: r["n"] for r in got.collect()} == {r["k"]: r["count"] for r in numbers(spark).groupBy("k").count().collect()}


def test_running_counts_with_seed(spark, many_blocks):
    got = stateful.running_counts(spark, numbers(spark, 90), "k", ["id"], {"3": 5, "never": 9}).collect()
    assert len(got) == 90
    for r in got:
        assert r["running"] == r["id"] // 7 + 1 + (5 if r["k"] == "3" else 0)


def test_streaming_kmeans_forgets(spark):
    draw = np.random.default_rng(1)
    rows = [(i, [float(x) for x in draw.normal(size=2) + (5 if i % 2 else -5)], i * 3 // 60) for i in range(60)]
    frame = spark.createDataFrame(rows, "id int, v array<double>, slice int")
    start = np.array([[-1.0, -1.0], [1.0, 1.0]])
    got = learning.streaming_kmeans(spark, frame, "v", start, decay=0.0)
    last = np.array([r[1] for r in rows if r[2] == 2])
    assert got == pytest.approx(np.array([last[last[:, 0] < 0].mean(axis=0), last[last[:, 0] > 0].mean(axis=0)]))


def test_streaming_linear_regression_learns(spark):
    draw = np.random.default_rng(5)
    x = draw.normal(size=(300, 2))
    rows = [(float(a), float(b), float(2 * a - b), i * 3 // 300) for i, (a, b) in enumerate(x)]
    frame = spark.createDataFrame(rows, "a double, b double, y double, slice int")
    w = learning.streaming_gradient(spark, frame, ["a", "b"], "y", logistic=False, step=0.5, steps=12)
    assert w == pytest.approx([2.0, -1.0], abs=0.1)


def test_p_value():
    assert learning.p_value(2.0, 10.0) == pytest.approx(0.0733880, abs=1e-7)
    assert learning.p_value(0.0, 10.0) == 1.0
    assert learning.p_value(1.0, 1.0) == pytest.approx(0.5, abs=1e-12)  # Cauchy
    for t in (0.3, 1.0, 4.0):
        assert learning.p_value(t, 2.0) == learning.p_value(-t, 2.0) == pytest.approx(1 - t / math.sqrt(2 + t * t), abs=1e-12)
        assert learning.p_value(t, 1e7) == pytest.approx(math.erfc(t / math.sqrt(2)), rel=1e-4)


def test_late_windows_stay_closed(spark, small):
    """State is dropped behind the watermark, and every window still has its final count."""
    e = table(spark, small, "events").select(F.col("ts").cast("timestamp").alias("ts"), F.lit(0).alias("slice"))
    got = feed.updates(spark, {"e": e}, lambda s: feed.windowed(s, "ts", "1 day", None, [], F.count(F.lit(1)).alias("n")), ["start"], slices=1)
    assert got.agg(F.sum("n")).first()[0] == e.count()


def resumed(work, tmp_path):
    """Results of a run in one go and of one that stops after two slices and goes on with new objects."""
    whole = work(str(tmp_path / "whole"), 3, 0)
    work(str(tmp_path / "parts"), 2, 0)
    return whole, work(str(tmp_path / "parts"), 3, 2)


def test_recoverable_count_resumes(spark, tmp_path):
    words = numbers(spark).select(F.col("k").alias("word"), "slice")

    def work(folder, slices, first):
        out = stateful.recoverable_count(spark, words, ("3",), slices, folder, first)
        return sorted(map(str, out.collect()))

    whole, parts = resumed(work, tmp_path)
    assert whole == parts and len(whole) == 21


def test_running_counts_resume(spark, tmp_path):
    def work(folder, slices, first):
        out = stateful.running_counts(spark, numbers(spark, 90), "k", ["id"], {"3": 5}, slices, folder, first)
        return {r["id"]: r["running"] for r in out.collect()}

    whole, parts = resumed(work, tmp_path)
    assert whole == parts == {i: i // 7 + 1 + 5 * (i % 7 == 3) for i in range(90)}


def test_state_grows_with_the_keys_of_a_batch_only(spark):
    """A thousand keys in the store, five in the next batch: five states are written, and a hot key is one of them."""
    first = spark.range(1000).select("id", F.col("id").cast("string").alias("k"), F.lit(0).alias("slice"))
    later = spark.range(1000, 1400).select("id", F.when(F.col("id") < 1300, "7").otherwise((F.col("id") % 5).cast("string")).alias("k"), F.lit(1).alias("slice"))
    nulls = spark.range(1400, 1403).select("id", F.lit(None).cast("string").alias("k"), F.lit(1).alias("slice"))
    progress = []
    out = stateful.running_counts(spark, first.unionByName(later).unionByName(nulls), "k", ["id"], {}, slices=2, progress=progress)
    states = [p["stateOperators"][0] for p in progress]
    assert [s["numRowsUpdated"] for s in states] == [1000, 7] and states[1]["numRowsTotal"] == 1001
    got = {r["id"]: (r["k"], r["running"]) for r in out.collect()}
    assert len(got) == 1403 and got[7] == ("7", 1) and got[1299] == ("7", 301) and got[1402] == (None, 3)
    assert sorted(got[i][1] for i in range(1300, 1400) if got[i][0] == "4") == list(range(2, 22))


def test_unseen_keys_expire(spark, tmp_path):
    rows = spark.createDataFrame([(0, "a", 0), (1, "a", 0), (2, "a", 1)], "id int, k string, slice int")
    for expiry, last in ((dt.timedelta(milliseconds=1), 1), (dt.timedelta(days=1), 3)):
        folder = str(tmp_path / str(last))
        stateful.running_counts(spark, rows, "k", ["id"], {}, 1, folder, 0, expiry)
        time.sleep(0.05)
        out = stateful.running_counts(spark, rows, "k", ["id"], {}, 2, folder, 1, expiry)
        assert {r["id"]: r["running"] for r in out.collect()} == {0: 1, 1: 2, 2: last}


CONTINUED = """
import sys
from pyspark.sql import functions as F
from millrace.session import build_session
from millrace.streaming import stateful
spark = build_session("local[2]", partitions=2, spark__ui__enabled="false")
rows = spark.range(90).select("id", (F.col("id") % 7).cast("string").alias("k"), F.floor(F.col("id") * 3 / 90).cast("int").alias("slice"))
out = stateful.running_counts(spark, rows, "k", ["id"], {"3": 5}, int(sys.argv[2]), sys.argv[1], int(sys.argv[3]))
bad = out.where("running <> floor(id / 7) + 1 + if(k = '3', 5, 0)").count()
print("rows", out.count(), "bad", bad)
"""


def test_running_counts_resume_in_a_new_process(tmp_path):
    root = Path(__file__).resolve().parent.parent
    for slices, first, expected in ((2, 0, "rows 60 bad 0"), (3, 2, "rows 90 bad 0")):
        done = subprocess.run([sys.executable, "-c", CONTINUED, str(tmp_path / "s"), str(slices), str(first)], cwd=root, timeout=300,
                              capture_output=True, text=True)
        assert expected in done.stdout, done.stderr[-2000:]


def test_streaming_weights_resume(spark, tmp_path):
    rows = [(float(i % 5), float(2 * (i % 5)), i * 3 // 60) for i in range(60)]
    points = spark.createDataFrame(rows, "x double, y double, slice int")

    def work(folder, slices, first):
        return learning.streaming_gradient(spark, points, ["x"], "y", False, 0.01, 3, slices, folder, first)

    whole, parts = resumed(work, tmp_path)
    assert whole == pytest.approx(parts) and whole[0] > 0


@pytest.mark.parametrize("name, logistic", [("stm21_streaming_linear_regression", False), ("stm22_streaming_logistic_regression", True)])
def test_streamed_gradients_take_all_steps(spark, small, name, logistic):
    """Fifty steps on each of three batches, against numpy."""
    rows = views.labelled_lines(spark, small).select(F.col("l_orderkey") % 3, "x0", "x2", "x3", "x1").collect()
    data = np.array([[float(v) for v in r] for r in rows])
    w = np.zeros(3)
    for s in range(3):
        own = data[data[:, 0] == s]
        x, y = own[:, 1:4], (own[:, 4] > 0.3) * 1.0 if logistic else own[:, 4]
        for i in range(1, 51):
            score = 1 / (1 + np.exp(-x @ w)) if logistic else x @ w
            w = w - 0.1 / np.sqrt(i) * (x * (score - y)[:, None]).mean(axis=0)
    assert list(registered()[name].run(spark, small).first()) == pytest.approx(w, abs=2e-6)
