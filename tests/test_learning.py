"""Models, neighbours, patterns and measures against numpy or hand-made results."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from millrace.operators import evaluation, linear, models, neighbours, patterns, pivot_tree, sketches
from millrace.operators.custom import UntrainedClassifier
from millrace.operators.features import active_entries, reindex_labels
from millrace.operators.joins import band_pairs


@pytest.fixture(scope="module")
def cloud():
    draw = np.random.default_rng(7)
    base = draw.normal(size=(90, 5))
    base[:30] = base[0]  # a third of the rows are copies
    return base


@pytest.fixture(scope="module")
def cloud_frame(spark, cloud):
    return spark.createDataFrame([(i, [float(x) for x in v], i % 3) for i, v in enumerate(cloud)], "id bigint, v array<double>, label int")


@pytest.mark.parametrize("block, leaf", [(20_000, 2000), (4, 10), (20_000, 3)])
def test_nearest_is_exact(spark, cloud, cloud_frame, monkeypatch, block, leaf):
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", block)
    monkeypatch.setattr(pivot_tree, "BLOCK_ROWS", block)
    train, test = cloud_frame.where("id % 4 <> 0"), cloud_frame.where("id % 4 = 0")
    got = {}
    for r in neighbours.nearest(train, test, "id", "v", "label", k=5, leaf=leaf, fan=3).collect():
        got.setdefault(r["q"], []).append((round(r["dist"], 9), r["t"]))
    ids = [i for i in range(len(cloud)) if i % 4]
    for q in range(0, len(cloud), 4):
        dist = sorted((round(float(np.sqrt(((cloud[t] - cloud[q]) ** 2).sum())), 9), t) for t in ids)[:5]
        assert sorted(got[q]) == dist


def test_comparisons_do_not_grow_with_the_table(spark):
    """Ten times the rows: a query is compared with about as many, and its nearest rows are right."""
    draw = np.random.default_rng(8)
    per_query = []
    for n in (3_000, 30_000):
        points = draw.normal(size=(n, 3))
        frame = spark.createDataFrame([(i, p.tolist(), 0.0) for i, p in enumerate(points)], "id int, v array<double>, label double")
        queries = draw.normal(size=(200, 3))
        asked = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(queries)], "id int, v array<double>")
        compared = []
        got = {}
        for r in neighbours.nearest(frame, asked, "id", "v", "label", k=4, leaf=150, fan=16, compared=compared).collect():
            got.setdefault(r["q"], []).append((r["dist"], r["t"]))
        for q, own in got.items():
            away = np.sqrt(((points - queries[q]) ** 2).sum(axis=1))
            assert [t for _, t in sorted(own)] == list(np.argsort(away, kind="stable")[:4])
        assert len(got) == 200
        per_query.append(compared[0] / 200)
    assert per_query[1] < 2 * per_query[0] and per_query[1] < 1000


def test_equal_queries_share_their_answer(spark, cloud_frame):
    train, test = cloud_frame.where("id >= 30"), cloud_frame.where("id < 30")
    rows = neighbours.nearest(train, test, "id", "v", "label", k=4).collect()
    answers = {}
    for r in rows:
        answers.setdefault(r["q"], set()).add((r["t"], r["dist"]))
    assert set(answers) == set(range(30)) and len({frozenset(a) for a in answers.values()}) == 1


def test_knn_with_fewer_rows_than_k(spark, cloud_frame):
    train, test = cloud_frame.where("id < 3"), cloud_frame.where("id = 50")
    assert neighbours.nearest(train, test, "id", "v", "label", k=6).count() == 3


def test_lloyd(cloud, cloud_frame):
    start = cloud[[0, 40, 80]]
    centres, _ = models.kmeans_lloyd(cloud_frame, "v", start, max_steps=4)
    expected = start.copy()
    for _ in range(4):
        near = ((cloud[:, None] - expected[None]) ** 2).sum(axis=2).argmin(axis=1)
        expected = np.array([cloud[near == c].mean(axis=0) if (near == c).any() else expected[c] for c in range(3)])
    assert centres == pytest.approx(expected)


def test_empty_cluster_keeps_its_centre(cloud, cloud_frame):
    start = np.vstack([cloud[0], np.full(5, 1e6)])
    assert models.kmeans_lloyd(cloud_frame, "v", start, max_steps=1)[0][1] == pytest.approx(start[1])


def test_gradient_descent(spark):
    draw = np.random.default_rng(2)
    x = draw.normal(size=(50, 2)) / 50
    y = np.where(x @ [1.0, -2.0] > 0, 1.0, -1.0)
    frame = spark.createDataFrame([(float(a), float(b), float(c)) for (a, b), c in zip(x, y)], "a double, b double, y double")
    w = np.zeros(2)
    for _ in range(5):
        w = w - ((1 / (1 + np.exp(-y * (x @ w))) - 1) * y) @ x
    assert models.logistic_gradient_descent(frame, ["a", "b"], "y") == pytest.approx(list(w))


def test_singular_values_and_cosines(spark, cloud, cloud_frame):
    got = [r["sigma"] for r in linear.singular_values(cloud_frame, "v").orderBy("k").collect()]
    assert got == pytest.approx(list(np.linalg.svd(cloud, compute_uv=False)))
    norm = cloud / np.sqrt((cloud ** 2).sum(axis=0))
    for r in linear.column_cosines(cloud_frame, "v").collect():
        assert r["cosine"] == pytest.approx(float(norm[:, r["i"]] @ norm[:, r["j"]]))


def test_principal_components(spark, cloud, cloud_frame):
    _, pc = linear.principal_components(cloud_frame.select("id", "v"), "v", 2)
    _, vectors = np.linalg.eigh(np.cov(cloud.T))
    assert np.abs(pc) == pytest.approx(np.abs(vectors[:, ::-1][:, :2]), abs=1e-6)
    assert (pc[np.abs(pc).argmax(axis=0), [0, 1]] > 0).all()


def test_rules(spark):
    sets = spark.createDataFrame([(["tea"], 40), (["milk"], 90), (["tea", "milk"], 36)], "items array<string>, freq bigint")
    assert [(r["antecedent"], r["consequent"], r["confidence"]) for r in patterns.association_rules(sets, 0.85).collect()] == [(["tea"], "milk", 0.9)]


def test_sequences(spark):
    rows = [([["a"], ["b"]],), ([["a", "b"]],), ([["a"], ["c"], ["b"]],)]
    found = patterns.sequential_patterns(spark.createDataFrame(rows, "s array<array<string>>"), "s", 0.6, 3)
    got = {tuple(tuple(i) for i in r["sequence"]): r["freq"] for r in found.collect()}
    assert got == {(("a",),): 3, (("b",),): 3, (("a",), ("b",)): 2}


def test_multilabel(spark):
    rows = [(["0", "1"], ["0", "2"]), ([], ["1"]), (["2"], ["2"])]
    r = evaluation.multilabel_metrics(spark.createDataFrame(rows, "p array<string>, a array<string>"), "p", "a").first()
    assert (r["precision"], r["recall"], r["subset_accuracy"]) == pytest.approx((0.5, 0.5, 1 / 3))
    assert r["hamming_loss"] == pytest.approx(3 / 9)
    assert (r["micro_precision"], r["micro_recall"]) == pytest.approx((2 / 3, 0.5))


def test_curve_areas_match_the_evaluator(spark, many_blocks):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    draw = np.random.default_rng(3)
    rows = [(float(s), float(draw.random() < s)) for s in draw.random(300).round(2)]
    frame = spark.createDataFrame(rows, "score double, label double")
    got = evaluation.curve_areas(evaluation.threshold_metrics(evaluation.threshold_counts(frame, "score", "label"))).first()
    for name, metric in (("area_under_roc", "areaUnderROC"), ("area_under_pr", "areaUnderPR")):
        judge = BinaryClassificationEvaluator(rawPredictionCol="score", metricName=metric, numBins=0)
        assert got[name] == pytest.approx(judge.evaluate(frame))


def test_ranking_metrics(spark, many_blocks):
    ranked = spark.createDataFrame([(1, i, r) for r, i in enumerate([1, 6, 2, 7], 1)] + [(2, 9, 1)], "u int, i int, r int")
    relevant = spark.createDataFrame([(1, 1), (1, 2), (1, 3)], "u int, i int")
    r = evaluation.ranking_metrics(ranked, relevant, "u", "i", "r").first()
    assert r["map"] == pytest.approx((1 + 2 / 3) / 3 / 2)
    assert r["precision_3"] == pytest.approx(2 / 3 / 2)
    ideal = 1 + 1 / np.log2(3) + 0.5
    assert r["ndcg_3"] == pytest.approx((1 + 0.5) / ideal / 2)


def test_custom_estimator(spark):
    frame = spark.createDataFrame([(1.0, Vectors.dense(1.0, 2.0)), (0.0, Vectors.dense(3.0, 4.0))], ["label", "features"])
    model = UntrainedClassifier().setMaxIter(3).fit(frame)
    assert model.getMaxIter() == 3
    assert {r["prediction"] for r in model.transform(frame).collect()} == {0.0}


def test_active_entries(spark):
    frame = spark.createDataFrame([(Vectors.dense(0.0, 2.0),), (Vectors.sparse(9, [3, 7], [1.0, 4.0]),)], ["v"])
    got = [[(e["pos"], e["weight"]) for e in r[0]] for r in frame.select(active_entries("v")).collect()]
    assert got == [[(1, 2.0)], [(3, 1.0), (7, 4.0)]]


def test_labels(spark):
    binary = spark.createDataFrame([(0.0,), (1.0,)], "y double")
    assert sorted(r["label_index"] for r in reindex_labels(binary, "y").collect()) == [0, 1]
    other = spark.createDataFrame([(-1.0,), (7.0,), (3.0,)], "y double")
    assert {r["y"]: r["label_index"] for r in reindex_labels(other, "y").collect()} == {-1.0: 0, 3.0: 1, 7.0: 2}


def test_band_pairs(spark, many_blocks):
    frame = spark.createDataFrame([(i,) for i in range(50)], "x int").repartition(4)
    got = {(r["i0"], r["i1"]) for r in band_pairs(frame, ["x"], ["x"], 3).collect()}
    assert got == {(i, j) for i in range(50) for j in range(i + 1, min(i + 4, 50))}


def test_count_min(spark):
    frame = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 500).alias("v"))
    shape = sketches.CountMin()
    assert (shape.depth, shape.width) == (7, 272)
    rows = sketches.frequency_estimates(frame, "v").collect()
    assert all(r["n"] <= r["estimate"] <= r["n"] + 0.01 * 3000 for r in rows)
    heavy = sketches.heavy_hitters(frame, "v", share=0.2).collect()
    assert [r["v"] for r in heavy] == [0]


def test_approx_distinct(spark):
    r = sketches.approx_distinct(spark.range(20000), "id").first()
    assert r["exact"] == 20000 and abs(r["error"]) < 0.06


def test_baskets_are_made_once_for_a_fit(spark):
    made = spark.sparkContext.accumulator(0)

    @F.udf("array<string>")
    def basket(i):
        made.add(1)
        return ["a", "b"] if i % 2 else ["a"]

    baskets = spark.range(100).select(basket("id").alias("items"))
    found = patterns.frequent_itemsets(baskets, "items", 0.1).collect()
    assert sorted((tuple(r["items"]), r["freq"]) for r in found) == [(("a",), 100), (("a", "b"), 50), (("b",), 50)]
    assert made.value == 100


def test_nearest_rows_of_a_block_are_told_at_once(monkeypatch):
    """Exact distances and ties to the smaller id, for all queries together and few pairs at a time."""
    monkeypatch.setattr(neighbours, "PAIRS", 50)
    draw = np.random.default_rng(5)
    for width, spread in ((2, 2), (8, 100)):
        rows, queries = draw.integers(0, spread, (90, width)).astype(float), draw.integers(0, spread, (300, width)).astype(float)
        ids = draw.permutation(90)
        q, r, dist = neighbours._best(queries, rows, ids, 4)
        away = np.sqrt(((queries[:, None] - rows[None]) ** 2).sum(axis=2))
        wanted = [(i, ids[j], away[i, j]) for i in range(300) for j in np.lexsort((ids, away[i]))[:4]]
        assert [(a, ids[b], c) for a, b, c in zip(q, r, dist)] == wanted
    q, r, _ = neighbours._best(queries, rows[:3], ids[:3], 4)
    assert len(q) == len(r) == 900


def test_neighbours_are_searched_without_shuffle_files_left(spark, monkeypatch):
    key, seen, write = "spark.sql.classic.shuffleDependency.fileCleanup.enabled", [], neighbours.staged
    for module in (neighbours, neighbours.pivot_tree):
        monkeypatch.setattr(module, "staged", lambda df, label: seen.append(df.sparkSession.conf.get(key)) or write(df, label))
    rows = spark.createDataFrame([(i, [float(i), 0.0], 1.0) for i in range(8)], "id bigint, v array<double>, label double")
    found = neighbours.nearest(rows.where("id < 6"), rows.where("id >= 6"), "id", "v", "label", 2)
    assert set(seen) == {"true"} and spark.conf.get(key) == "false"
    assert sorted((r.q, r.t) for r in found.collect()) == [(6, 4), (6, 5), (7, 4), (7, 5)]
