"""Checks of fits and draws that have no SQL form: keys and counts as SQL gives them, and what must hold as true.

The test columns are drawn without a relation between them, so a fit is held to the rows that it has seen.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml import classification as cl
from pyspark.ml import clustering as cu
from pyspark.ml import feature as ft
from pyspark.ml import regression as rg
from pyspark.ml.evaluation import BinaryClassificationEvaluator, RegressionEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder, TrainValidationSplit
from pyspark.sql import functions as F

from millrace.catalog import ctes
from millrace.catalog.learning import X, _binary, _corpus, _points, _priced, _text_stages, _texts
from millrace.functions.numeric import row_count
from millrace.operators import factors, linear, models, sampling, word_vectors
from millrace.operators.features import assemble
from millrace.operators.graph import power_iteration_clusters
from millrace.operators.joins import band_pairs
from millrace.plans.durable import staged
from millrace.plans.sizing import balanced, scans_of_files
from millrace.registry import query
from millrace.sources import views
from millrace.sources.tables import table

LINES = "SELECT count(*) AS n, true AS better FROM lineitem"
VECTORS = "SELECT count(*) AS n, true AS better FROM embeddings"


POINTS = 1_000_000  # in a file, and so in a task of a fit


def _fitted(estimator, points):
    """A fit over the written points, and these. Their columns pack well, so tasks are cut by rows, not by bytes."""
    points = staged(points, "points", POINTS)
    with scans_of_files(points.sparkSession, len(points.inputFiles())):
        return estimator.fit(points), points


def _better(estimator, points):
    """All rows, and whether at least as many of them are told right as by always naming the greatest class."""
    model, points = _fitted(estimator, points)
    told = staged(model.transform(points).select("label", "prediction"), "told")
    right = told.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("label") == F.col("prediction")).alias("right"))
    most = told.groupBy("label").agg(F.count(F.lit(1)).alias("_n")).agg(F.max("_n")).scalar()
    return right.select("n", (F.col("right") >= most).alias("better"))


def _closer(estimator, points):
    """All rows, and whether the squared error is below that of their mean."""
    model, points = _fitted(estimator, points)
    told = model.transform(points)
    return told.agg(F.count(F.lit(1)).alias("n"), (F.avg((F.col("label") - F.col("prediction")) ** 2) < F.var_pop("label")).alias("better"))


def _one(spark, row, schema):
    return spark.createDataFrame([row], schema)


@query("smp1_split_shares", "SELECT count(*) AS n, true AS apart, true AS within FROM orders")
def smp1(spark, folder):
    o = table(spark, folder, "orders").select("o_orderkey")
    train, test = sampling.random_split(o, [0.6, 0.4], 11)
    both = train.select("o_orderkey", F.lit(1).alias("t")).unionByName(test.select("o_orderkey", F.lit(0).alias("t")))
    s = both.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("o_orderkey").alias("d"), F.sum("t").alias("t"))
    return s.select("n", (F.col("n") == F.col("d")).alias("apart"), (F.abs(F.col("t") - 0.6 * F.col("n")) <= 5 * F.sqrt(0.24 * F.col("n"))).alias("within"))


@query("smp2_sample_shares", "SELECT kind, count(*) AS n, true AS within, true AS members FROM orders, (VALUES ('bernoulli'), ('poisson')) AS k(kind) GROUP BY kind")
def smp2(spark, folder):
    o = table(spark, folder, "orders").select("o_orderkey")
    drawn = o.sample(False, 0.1, 7).select(F.lit("bernoulli").alias("kind"), "o_orderkey").unionByName(
        o.sample(True, 0.1, 7).select(F.lit("poisson").alias("kind"), "o_orderkey"))
    n = o.agg(F.count(F.lit(1))).scalar()
    s = drawn.groupBy("kind").agg(F.count(F.lit(1)).alias("_k"), F.count_distinct("o_orderkey").alias("_d"))
    return s.select("kind", n.alias("n"), (F.abs(F.col("_k") - 0.1 * n) <= 5 * F.sqrt(0.1 * n)).alias("within"),
                    ((F.col("kind") == "poisson") | (F.col("_d") == F.col("_k"))).alias("members"))


@query("smp3_take_sample_sizes", "SELECT kind, least(100, count(*)) AS n, true AS members FROM orders, (VALUES ('with'), ('without')) AS k(kind) GROUP BY kind")
def smp3(spark, folder):
    o = table(spark, folder, "orders").select("o_orderkey")
    drawn = sampling.take_sample(o, 100, 5).select(F.lit("without").alias("kind"), "o_orderkey").unionByName(
        sampling.take_sample(o, 100, 5, with_replacement=True, order=["o_orderkey"]).select(F.lit("with").alias("kind"), "o_orderkey"))
    known = drawn.join(o.select("o_orderkey", F.lit(True).alias("_in")), "o_orderkey", "left")
    s = known.groupBy("kind").agg(row_count(), F.count_distinct("o_orderkey").alias("_d"), F.count("_in").alias("_in"))
    return s.select("kind", "n", ((F.col("_in") == F.col("n")) & ((F.col("kind") == "with") | (F.col("_d") == F.col("n")))).alias("members"))


@query("smp4_sample_by_key_shares", "SELECT l_returnflag, count(*) AS n, true AS within FROM lineitem GROUP BY 1")
def smp4(spark, folder):
    l = table(spark, folder, "lineitem").select("l_returnflag")
    fractions = {"A": 0.1, "N": 0.2, "R": 0.3}
    kept = sampling.sample_by_key(l, "l_returnflag", fractions, 3).groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("_k"))
    f = F.coalesce(*[F.when(F.col("l_returnflag") == k, v) for k, v in fractions.items()])
    return l.groupBy("l_returnflag").agg(row_count()).join(kept, "l_returnflag").select(
        "l_returnflag", "n", (F.abs(F.col("_k") - f * F.col("n")) <= 5 * F.sqrt(f * (1 - f) * F.col("n"))).alias("within"))


@query("gen1_normal_moments", "SELECT o_orderstatus, count(*) AS n, true AS moments FROM orders GROUP BY 1")
def gen1(spark, folder):
    drawn = sampling.normal_columns(table(spark, folder, "orders").select("o_orderstatus"), ["x", "y"], 17)
    s = drawn.groupBy("o_orderstatus").agg(row_count(), F.avg("x").alias("m"), F.var_pop("x").alias("v"), F.corr("x", "y").alias("c"))
    slack = 6 / F.sqrt("n")
    return s.select("o_orderstatus", "n", ((F.abs("m") <= slack) & (F.abs(F.col("v") - 1) <= 2 * slack) & (F.abs("c") <= slack)).alias("moments"))


@query("gen2_lognormal_degrees", "SELECT count(*) AS vertices, true AS in_range, true AS near FROM customer")
def gen2(spark, folder):
    """Targets are vertex positions, and the logarithm of the degrees has about the asked-for mean."""
    c = table(spark, folder, "customer").select("c_custkey")
    n = c.agg(F.count(F.lit(1))).scalar()
    edges = sampling.lognormal_edges(c, "c_custkey", n, mu=4.0, sigma=1.3, seed=9)
    degrees = edges.groupBy("src").agg(F.log(F.count(F.lit(1)) + F.lit(0.5)).alias("l"), F.min("dst").alias("lo"), F.max("dst").alias("hi"))
    s = degrees.agg(F.avg("l").alias("l"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    return s.select(n.alias("vertices"), ((F.col("lo") >= 0) & (F.col("hi") < n)).alias("in_range"),
                    (F.abs(F.col("l") - 4) <= 6 * 1.3 / F.sqrt(n) + 0.05).alias("near"))


@query("fea8_word2vec_means", "SELECT doc_id, true AS mean FROM documents")
def fea8(spark, folder):
    """The vector of a document is the mean of the vectors of its words."""
    docs = balanced(table(spark, folder, "documents").select("doc_id", "text"))
    raw = ft.RegexTokenizer(inputCol="text", outputCol="t", pattern=r"\W").transform(docs).select("doc_id", "t")
    model = word_vectors.fit(raw, "t", size=3, seed=1)
    vectors = model.vectors.select("word", F.col("vector").alias("w"))
    words = model.dealt.select("doc_id", F.explode("t").alias("word")).groupBy("doc_id", "word").agg(F.count(F.lit(1)).alias("n")).join(vectors, "word")
    means = words.groupBy("doc_id").agg(F.array(*[F.sum(F.col("n") * F.col("w")[i]) / F.sum("n") for i in range(3)]).alias("m"))
    out = word_vectors.document_vectors(model, "v", "doc_id").join(means, "doc_id", "left")
    apart = F.aggregate(F.zip_with("v", F.coalesce("m", F.array(*[F.lit(0.0)] * 3)), lambda a, b: F.abs(a - b)), F.lit(0.0), lambda a, x: a + x)
    return out.select("doc_id", (apart < 1e-4).alias("mean"))


def _orthonormal(pc):
    return bool(np.abs(pc.T @ pc - np.eye(pc.shape[1])).max() < 1e-6)


@query("fea24_pca_components", "SELECT count(*) AS n, true AS orthonormal, true AS falling FROM part")
def fea24(spark, folder):
    p = table(spark, folder, "part").select(F.array((F.col("p_size") / 49), F.col("p_retailprice") / 1999, (F.col("p_partkey") % 7) / F.lit(6.9)).alias("a"))
    projected, pc = linear.principal_components(p, "a", 3)
    s = projected.select(vector_to_array("projected").alias("x")).agg(F.count(F.lit(1)).alias("n"), *[F.var_pop(F.col("x")[i]).alias(f"v{i}") for i in range(3)])
    return s.select("n", F.lit(_orthonormal(pc)).alias("orthonormal"), ((F.col("v0") >= F.col("v1")) & (F.col("v1") >= F.col("v2"))).alias("falling"))


@query("lin3_orthonormal_components", "SELECT max(len(embedding)) AS n, true AS orthonormal, true AS falling FROM embeddings")
def lin3(spark, folder):
    e = table(spark, folder, "embeddings")
    width = e.agg(F.max(F.size("embedding"))).first()[0]
    projected, pc = linear.principal_components(e, "embedding", width)
    v = projected.select(vector_to_array("projected").alias("x")).agg(*[F.var_pop(F.col("x")[i]) for i in range(width)]).first()
    return _one(spark, (width, _orthonormal(pc), all(a >= b - 1e-9 for a, b in zip(v, v[1:]))), "n int, orthonormal boolean, falling boolean")


@query("cls2_logistic_better", LINES)
def cls2(spark, folder):
    return _better(cl.LogisticRegression(maxIter=100, regParam=0.01, elasticNetParam=0.5, tol=1e-6), _binary(spark, folder))


@query("cls3_raw_scores_order", "SELECT count(*) AS n, true AS ordered FROM lineitem")
def cls3(spark, folder):
    """The raw scores of dear rows lie above those of cheap ones on average, and their sign is the prediction."""
    points = staged(_binary(spark, folder), "points")
    told = cl.LogisticRegression(maxIter=100, regParam=0.1, fitIntercept=True).fit(points).transform(points)
    score = vector_to_array("rawPrediction")[1]
    s = told.agg(F.count(F.lit(1)).alias("n"), F.avg(F.when(F.col("label") == 1, score)).alias("up"), F.avg(F.when(F.col("label") == 0, score)).alias("down"),
                 F.bool_and((score > 0) == (F.col("prediction") == 1)).alias("sign"))
    return s.select("n", ((F.col("up") > F.col("down")) & F.col("sign")).alias("ordered"))


@query("cls4_summary_holds", "SELECT count(*) AS n, true AS falling, true AS rising, true AS better FROM lineitem")
def cls4(spark, folder):
    """The objective falls, the rates of the curve rise to one, and its area beats chance."""
    p = _binary(spark, folder)
    summary = cl.LogisticRegression(maxIter=10, regParam=0.01).fit(p).summary
    history = list(summary.objectiveHistory)
    rates = summary.roc.agg(F.min("FPR"), F.max("FPR"), F.min("TPR"), F.max("TPR")).first()
    return p.agg(F.count(F.lit(1)).alias("n")).select(
        "n", F.lit(all(b <= a + 1e-12 for a, b in zip(history, history[1:]))).alias("falling"), F.lit(tuple(rates) == (0.0, 1.0, 0.0, 1.0)).alias("rising"),
        F.lit(bool(summary.areaUnderROC > 0.5)).alias("better"))


@query("cls5_linear_svm_better", LINES)
def cls5(spark, folder):
    return _better(cl.LinearSVC(maxIter=100, regParam=0.01), _binary(spark, folder))


@query("cls7_decision_tree_better", VECTORS)
def cls7(spark, folder):
    return _better(cl.DecisionTreeClassifier(maxDepth=5, maxBins=32, impurity="gini", seed=1), _points(spark, folder))


@query("cls8_random_forest_better", VECTORS)
def cls8(spark, folder):
    return _better(cl.RandomForestClassifier(numTrees=10, maxDepth=5, featureSubsetStrategy="auto", seed=1), _points(spark, folder))


@query("cls9_gradient_boosted_better", LINES)
def cls9(spark, folder):
    return _better(cl.GBTClassifier(maxIter=10, maxDepth=5, seed=1), _binary(spark, folder))


@query("cls10_perceptron_loss", "SELECT count(*) AS n, true AS sums, true AS better FROM lineitem")
def cls10(spark, folder):
    """Probabilities add up to one, and their loss is not above that of equal chances."""
    l = assemble(balanced(views.labelled_lines(spark, folder)), X)
    told = cl.MultilayerPerceptronClassifier(layers=[4, 5, 4, 3], blockSize=128, seed=1234, maxIter=100).fit(l).transform(l)
    p = vector_to_array("probability")
    s = told.agg(F.count(F.lit(1)).alias("n"), F.avg(-F.log(F.get(p, F.col("label").cast("int")))).alias("loss"),
                 F.bool_and(F.abs(p[0] + p[1] + p[2] - 1) < 1e-9).alias("sums"))
    return s.select("n", "sums", (F.col("loss") <= float(np.log(3)) + 0.01).alias("better"))


@query("cls11_one_vs_rest_better", VECTORS)
def cls11(spark, folder):
    return _better(cl.OneVsRest(classifier=cl.LogisticRegression(maxIter=100, tol=1e-6), parallelism=4), _points(spark, folder))


@query("reg2_decision_tree_closer", LINES)
def reg2(spark, folder):
    return _closer(rg.DecisionTreeRegressor(maxDepth=5, seed=1), _priced(spark, folder))


@query("reg3_random_forest_closer", LINES)
def reg3(spark, folder):
    return _closer(rg.RandomForestRegressor(numTrees=10, maxDepth=5, seed=1), _priced(spark, folder))


@query("reg4_gradient_boosted_closer", LINES)
def reg4(spark, folder):
    return _closer(rg.GBTRegressor(maxIter=10, maxDepth=5, seed=1), _priced(spark, folder))


@query("reg6_aft_quantiles", "SELECT CASE WHEN l_returnflag <> 'A' THEN 1.0 ELSE 0.0 END::DOUBLE AS censor, count(*) AS n, true AS rising FROM lineitem GROUP BY 1")
def reg6(spark, folder):
    """The asked-for quantiles of the survival time are positive and rise with the probability."""
    l = assemble(table(spark, folder, "lineitem").select(
        F.col("l_quantity").alias("label"), (F.col("l_returnflag") != "A").cast("double").alias("censor"),
        (F.col("l_discount") * 10).alias("a"), (F.col("l_tax") * 10).alias("b")), ["a", "b"])
    q = vector_to_array("q")
    told = rg.AFTSurvivalRegression(quantileProbabilities=[0.3, 0.6], quantilesCol="q", maxIter=10).fit(l).transform(l)
    return told.groupBy("censor").agg(row_count(), F.bool_and((q[0] > 0) & (q[1] > q[0])).alias("rising"))


_RATED = f"WITH {ctes.RATINGS} SELECT count(*) AS n, true AS better FROM ratings"


@query("rec1_als_error", _RATED)
def rec1(spark, folder):
    """The factors explain their own ratings better than the mean does."""
    r = staged(views.ratings(spark, folder), "ratings")
    told = factors.alternate(r, "user", "item", "rating", rank=10, rounds=10, reg=0.1, seed=1).predict(r)
    return told.agg(F.count(F.lit(1)).alias("n"), (F.avg((F.col("rating") - F.col("prediction")) ** 2) < F.var_pop("rating")).alias("better"))


@query("rec2_als_implicit_order", _RATED)
def rec2(spark, folder):
    """What was liked gets a higher preference than what was not, on average."""
    r = staged(views.ratings(spark, folder).withColumn("conf", F.col("rating") - 2.5), "ratings")
    told = factors.alternate(r, "user", "item", "conf", rank=10, rounds=20, reg=1.0, alpha=1.0, seed=1).predict(r)
    mean = lambda liked: F.avg(F.when(liked, F.col("prediction")))
    return told.agg(F.count(F.lit(1)).alias("n"), (mean(F.col("conf") > 0) > mean(F.col("conf") <= 0)).alias("better"))


@query("clu2_kmeans_cost", "SELECT count(*) AS n, true AS cost, true AS nearest FROM embeddings")
def clu2(spark, folder):
    """Each row lies with its nearest centre, and the final centres cost no more than those of the last round."""
    p = _points(spark, folder)
    model = cu.KMeans(k=10, initMode="k-means||", maxIter=10, seed=1).fit(p)
    nearest = models.nearest_centre(np.array(model.clusterCenters()))
    told = model.transform(p).select("prediction", nearest(vector_to_array("features")).alias("c"))
    s = told.agg(F.count(F.lit(1)).alias("n"), F.sum("c.cost").alias("c"), F.bool_and(F.col("c.cluster") == F.col("prediction")).alias("nearest"))
    return s.select("n", (F.col("c") <= model.summary.trainingCost * (1 + 1e-9)).alias("cost"), "nearest")


@query("clu3_bisecting_cost", "SELECT count(*) AS n, 6 AS clusters, true AS better FROM embeddings")
def clu3(spark, folder):
    """Six clusters whose cost is below that of one."""
    p = _points(spark, folder)
    model = cu.BisectingKMeans(k=6, maxIter=20, seed=1).fit(p)
    x = vector_to_array("features")
    width = p.select(x.alias("x")).agg(F.max(F.size("x"))).first()[0]
    s = model.transform(p).agg(F.count(F.lit(1)).alias("n"), F.count_distinct("prediction").cast("int").alias("clusters"),
                               sum((F.var_pop(x[i]) for i in range(width)), F.lit(0.0)).alias("v"))
    return s.select("n", "clusters", (F.lit(model.summary.trainingCost) < F.col("n") * F.col("v")).alias("better"))


@query("clu4_mixture_holds", "SELECT count(*) AS n, true AS weights, true AS positive, true AS sums FROM lineitem")
def clu4(spark, folder):
    """Weights and memberships add up to one; covariances are symmetric and not negative."""
    l = assemble(balanced(views.labelled_lines(spark, folder)), X)
    model = cu.GaussianMixture(k=3, maxIter=100, seed=1).fit(l)
    covariances = [g.cov.toArray() for g in model.gaussians]
    positive = all(np.allclose(c, c.T) and np.linalg.eigvalsh(c).min() > -1e-9 for c in covariances)
    total = F.aggregate(vector_to_array("probability"), F.lit(0.0), lambda a, v: a + v)
    return model.transform(l).agg(F.count(F.lit(1)).alias("n"), F.lit(bool(abs(sum(model.weights) - 1) < 1e-9)).alias("weights"),
                                  F.lit(bool(positive)).alias("positive"), F.bool_and(F.abs(total - 1) < 1e-9).alias("sums"))


@query("clu5_power_iteration_members", "SELECT count(*) AS n, 2 AS clusters FROM events")
def clu5(spark, folder):
    """Every event with a neighbour is in one of two clusters."""
    e = table(spark, folder, "events").select("event_id", "value")
    pairs = band_pairs(e, ["value", "event_id"], ["event_id", "value"], 3)
    weight = F.exp(-(F.col("value0") - F.col("value1")) ** 2 / 2) + F.lit(1e-9)
    graph = pairs.select(F.col("event_id0").alias("src"), F.col("event_id1").alias("dst"), weight.alias("weight"))
    found = power_iteration_clusters(graph, k=2, iterations=15)
    return found.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("cluster").cast("int").alias("clusters"))


@query("clu6_lda_distributions", "SELECT count(*) AS n, 20 AS topics, true AS sums, true AS falling FROM documents")
def clu6(spark, folder):
    """Every document is a mixture of all topics, and the terms of a topic come by falling weight."""
    corpus, _ = _corpus(spark, folder)
    model = cu.LDA(k=20, maxIter=10, optimizer="online", seed=1).fit(corpus)
    topics = model.describeTopics(5).agg(F.count(F.lit(1)).cast("int").alias("topics"),
                                         F.bool_and(F.reverse(F.array_sort("termWeights")) == F.col("termWeights")).alias("falling")).first()
    total = F.aggregate(vector_to_array("topicDistribution"), F.lit(0.0), lambda a, v: a + v)
    empty = F.size(F.unwrap_udt("features")["indices"]) == 0
    s = model.transform(corpus).agg(F.count(F.lit(1)).alias("n"), F.bool_and(empty | (F.abs(total - 1) < 1e-6)).alias("sums"))
    return s.select("n", F.lit(topics["topics"]).alias("topics"), "sums", F.lit(topics["falling"]).alias("falling"))


_LABELLED = "SELECT count(*) AS n FROM documents JOIN labels USING (doc_id)"


@query("tun1_text_classifier_better", "SELECT count(*) AS n, true AS better FROM documents JOIN labels USING (doc_id)")
def tun1(spark, folder):
    """The fitted stages tell their own rows at least as well as the majority."""
    texts = _texts(spark, folder)
    told = _text_stages()[2].fit(texts).transform(texts)
    s = told.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("label") == F.col("prediction")).alias("right"), F.sum("label").alias("ones"))
    return s.select("n", (F.col("right") >= F.greatest("ones", F.col("n") - F.col("ones"))).alias("better"))


@query("tun2_cross_validation_best", f"""SELECT features, reg, n, true AS valid, true AS better FROM (VALUES (10), (100), (1000)) AS f(features),
  (VALUES (0.1::DOUBLE), (0.01::DOUBLE)) AS r(reg), ({_LABELLED})""")
def tun2(spark, folder):
    """Every setting has an area between 0 and 1, and the best beats chance."""
    tf, lr, stages = _text_stages()
    grid = ParamGridBuilder().addGrid(tf.numFeatures, [10, 100, 1000]).addGrid(lr.regParam, [0.1, 0.01]).build()
    texts = _texts(spark, folder)
    model = CrossValidator(estimator=stages, estimatorParamMaps=grid, evaluator=BinaryClassificationEvaluator(), numFolds=2, parallelism=4, seed=1).fit(texts)
    best = max(model.avgMetrics)
    rows = [(int(g[tf.numFeatures]), float(g[lr.regParam]), texts.count(), 0.0 <= float(m) <= 1.0, bool(best > 0.5)) for g, m in zip(grid, model.avgMetrics)]
    return spark.createDataFrame(rows, "features int, reg double, n bigint, valid boolean, better boolean")


@query("tun3_validation_best", """SELECT reg, intercept, elastic, n, true AS better FROM (VALUES (0.1::DOUBLE), (0.01::DOUBLE)) AS r(reg), (VALUES (false), (true)) AS i(intercept),
  (VALUES (0.0::DOUBLE), (0.5::DOUBLE), (1.0::DOUBLE)) AS e(elastic), (SELECT count(*) AS n FROM lineitem)""")
def tun3(spark, folder):
    """The best of all settings has a smaller error than the mean."""
    lr, p = rg.LinearRegression(maxIter=10), _priced(spark, folder)
    grid = (ParamGridBuilder().addGrid(lr.regParam, [0.1, 0.01]).addGrid(lr.fitIntercept, [False, True])
            .addGrid(lr.elasticNetParam, [0.0, 0.5, 1.0]).build())
    model = TrainValidationSplit(estimator=lr, estimatorParamMaps=grid, evaluator=RegressionEvaluator(), trainRatio=0.8, parallelism=4, seed=1).fit(p)
    spread, n = p.agg(F.stddev_pop("label"), F.count(F.lit(1))).first()
    rows = [(float(g[lr.regParam]), bool(g[lr.fitIntercept]), float(g[lr.elasticNetParam]), n, bool(min(model.validationMetrics) < spread)) for g in grid]
    return spark.createDataFrame(rows, "reg double, intercept boolean, elastic double, n bigint, better boolean")


@query("tun4_parameters_hold", "SELECT count(*) AS n, true AS given, true AS own, true AS cut FROM lineitem")
def tun4(spark, folder):
    """Settings given at the fit hold for that model only: its threshold decides, and the first keeps its own columns."""
    p = _binary(spark, folder)
    lr = cl.LogisticRegression(maxIter=10, regParam=0.01)
    first, second = lr.fit(p), lr.fit(p, {lr.maxIter: 20, lr.regParam: 0.1, lr.threshold: 0.55, lr.probabilityCol: "chance"})
    cut = (vector_to_array("chance")[1] > 0.55) == (F.col("prediction") == 1.0)
    return second.transform(p).agg(F.count(F.lit(1)).alias("n"), F.lit(second.getThreshold() == 0.55 and second.getRegParam() == 0.1).alias("given"),
                                   F.lit(first.getThreshold() == 0.5 and "probability" in first.transform(p).columns).alias("own"), F.bool_and(cut).alias("cut"))
