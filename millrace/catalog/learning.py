"""Classification, regression, recommendation, clustering, patterns and tuning."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.ml import Pipeline
from pyspark.ml import classification as cl
from pyspark.ml import clustering as cu
from pyspark.ml import regression as rg
from pyspark.ml.evaluation import BinaryClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import HashingTF, Tokenizer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder, TrainValidationSplit
from pyspark.sql import functions as F

from millrace.catalog import ctes
from millrace.functions import numeric
from millrace.functions.numeric import row_count
from millrace.operators import evaluation as ev
from millrace.operators import factors, models, neighbours, patterns, recommend, sampling
from millrace.operators.custom import UntrainedClassifier
from millrace.operators.features import active_entries, assemble, text_corpus, to_libsvm
from millrace.operators.graph import power_iteration_clusters
from millrace.operators.joins import band_pairs
from millrace.operators.ranking import top_k_per_group
from millrace.plans.durable import fresh_path, staged
from millrace.plans.sizing import balanced
from millrace.registry import query
from millrace.sources import views
from millrace.sources.readers import read_libsvm
from millrace.sources.tables import table

X = ["x0", "x1", "x2", "x3"]


def _points(spark, folder):
    return balanced(table(spark, folder, "embeddings")).select(
        "vec_id", F.col("label").cast("double").alias("label"), array_to_vector("embedding").alias("features"))


def _binary(spark, folder):
    """Line items with a price above the middle, from quantity, discount and tax."""
    l = balanced(views.labelled_lines(spark, folder)).withColumn("label", (F.col("x1") > 0.3).cast("double"))
    return assemble(l, ["x0", "x2", "x3"])


def _priced(spark, folder):
    return assemble(balanced(views.labelled_lines(spark, folder)).withColumn("label", F.col("x1")), ["x0", "x2", "x3"])


_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def _scored(model, test):
    return ev.confusion(model.transform(test), "label", "prediction")


def _fit_score(estimator, points, key):
    train, test = sampling.hash_split(points, key, 70)
    return _scored(estimator.fit(train), test)


def _regress(estimator, points, key):
    train, test = sampling.hash_split(points, key, 70)
    return ev.regression_metrics(estimator.fit(train).transform(test), "label", "prediction")


_GD_COLS = ["x0", "x2", "x3"]
_GD = ", ".join(f"w{i} AS MATERIALIZED (SELECT " + ", ".join(
    f"any_value(w.a{j}) - sum(c.{x} * (1 / (1 + exp(-c.y * (w.a0 * c.x0 + w.a1 * c.x2 + w.a2 * c.x3))) - 1) * c.y) AS a{j}" for j, x in enumerate(_GD_COLS))
    + f" FROM p c, w{i - 1} w)" for i in range(1, 6))


@query("cls1_logistic_gradient_descent", f"""WITH {ctes.LABELLED}, p AS (SELECT (x0 - 0.5) / 1000 AS x0, (x2 - 0.5) / 1000 AS x2, (x3 - 0.4) / 1000 AS x3,
  CASE WHEN x1 > 0.3 THEN 1.0::DOUBLE ELSE -1.0::DOUBLE END AS y FROM labelled), w0 AS (SELECT 0.0::DOUBLE AS a0, 0.0::DOUBLE AS a1, 0.0::DOUBLE AS a2), {_GD}
  SELECT round(a0, 5) AS w0, round(a1, 5) AS w1, round(a2, 5) AS w2 FROM w5""")
def cls1(spark, folder):
    p = views.labelled_lines(spark, folder).select(
        ((F.col("x0") - 0.5) / 1000).alias("x0"), ((F.col("x2") - 0.5) / 1000).alias("x2"), ((F.col("x3") - 0.4) / 1000).alias("x3"),
        F.when(F.col("x1") > 0.3, 1.0).otherwise(-1.0).alias("y"))
    w = models.logistic_gradient_descent(p, _GD_COLS, "y", iterations=5)
    return spark.createDataFrame([tuple(round(x, 5) for x in w)], "w0 double, w1 double, w2 double")


@query("cls2_logistic_regression")
def cls2(spark, folder):
    return _fit_score(cl.LogisticRegression(maxIter=100, regParam=0.01, elasticNetParam=0.5, tol=1e-6), _binary(spark, folder), _KEY)


@query("cls2_multinomial")
def cls2_multi(spark, folder):
    return _fit_score(cl.LogisticRegression(maxIter=100, regParam=0.01, family="multinomial"), _points(spark, folder), ["vec_id"])


@query("cls3_logistic_raw_scores")
def cls3(spark, folder):
    train, test = sampling.hash_split(_binary(spark, folder), _KEY, 70)
    model = cl.LogisticRegression(maxIter=100, regParam=0.1, elasticNetParam=0.0, fitIntercept=True).fit(train)
    raw = model.transform(test).select(F.round(vector_to_array("rawPrediction")[1], 6).alias("score"), "label")
    return ev.curve_areas(ev.threshold_metrics(ev.threshold_counts(raw, "score", "label")))


@query("cls4_training_summary")
def cls4(spark, folder):
    model = cl.LogisticRegression(maxIter=10, regParam=0.01).fit(_binary(spark, folder))
    best = model.summary.fMeasureByThreshold.agg(F.max_by("threshold", "F-Measure").alias("threshold"), F.max("F-Measure").alias("f")).first()
    model.setThreshold(best["threshold"])
    history = [(i, float(v)) for i, v in enumerate(model.summary.objectiveHistory)]
    return spark.createDataFrame(history, "step int, objective double").withColumn(
        "auc", F.lit(model.summary.areaUnderROC)).withColumn("threshold", F.lit(best["threshold"])).withColumn("best_f", F.lit(best["f"]))


@query("cls4_roc")
def cls4_roc(spark, folder):
    """False and true positive rate at each threshold of a fitted model."""
    summary = cl.LogisticRegression(maxIter=10, regParam=0.01).fit(_binary(spark, folder)).summary
    return summary.roc.select(F.col("FPR").alias("fpr"), F.col("TPR").alias("tpr"))


@query("cls5_linear_svm")
def cls5(spark, folder):
    return _fit_score(cl.LinearSVC(maxIter=100, regParam=0.01), _binary(spark, folder), _KEY)


@query("cls6_naive_bayes", f"WITH {ctes.NAIVE_BAYES} SELECT label, round(prior, 6) AS prior, round(t0, 6) AS t0, round(t1, 6) AS t1, round(t2, 6) AS t2, round(t3, 6) AS t3 FROM t")
def cls6(spark, folder):
    """Fitted log priors and log likelihoods."""
    model = cl.NaiveBayes(smoothing=1.0, modelType="multinomial").fit(assemble(views.labelled_lines(spark, folder), X))
    theta = model.theta.toArray()
    rows = [(float(k), *[round(float(v), 6) for v in (model.pi[k], *theta[k])]) for k in range(theta.shape[0])]
    return spark.createDataFrame(rows, "label double, prior double, t0 double, t1 double, t2 double, t3 double")


@query("cls6_sparse_naive_bayes", f"WITH {ctes.NAIVE_BAYES} SELECT label, round(prior, 6) AS prior, round(t0, 6) AS t0, round(t1, 6) AS t1, round(t2, 6) AS t2, round(t3, 6) AS t3 FROM t")
def cls6_sparse(spark, folder):
    """The same model from sparse vectors in a LIBSVM file."""
    path = fresh_path(spark, "sparse")
    to_libsvm(views.labelled_lines(spark, folder), "label", X).write.text(path)
    model = cl.NaiveBayes(smoothing=1.0, modelType="multinomial").fit(read_libsvm(spark, path, len(X)))
    theta = model.theta.toArray()
    rows = [(float(k), *[round(float(v), 6) for v in (model.pi[k], *theta[k])]) for k in range(theta.shape[0])]
    return spark.createDataFrame(rows, "label double, prior double, t0 double, t1 double, t2 double, t3 double")


@query("cls6_naive_bayes_predictions", f"""WITH {ctes.NAIVE_BAYES}, p AS (SELECT l.label, arg_max(t.label, prior + l.x0 * t0 + l.x1 * t1 + l.x2 * t2 + l.x3 * t3) AS prediction
  FROM (SELECT *, row_number() OVER () AS rid FROM labelled) l, t GROUP BY l.rid, l.label) SELECT label, prediction, count(*) AS n FROM p GROUP BY 1, 2""")
def cls6_predict(spark, folder):
    l = views.labelled_lines(spark, folder)
    tables = models.naive_bayes_tables(l, X, "label")
    return ev.confusion(l.withColumn("prediction", models.naive_bayes_predict(l, X, tables)), "label", "prediction")


@query("cls7_decision_tree")
def cls7(spark, folder):
    return _fit_score(cl.DecisionTreeClassifier(maxDepth=5, maxBins=32, impurity="gini", seed=1), _points(spark, folder), ["vec_id"])


@query("cls8_random_forest")
def cls8(spark, folder):
    return _fit_score(cl.RandomForestClassifier(numTrees=10, maxDepth=5, featureSubsetStrategy="auto", seed=1), _points(spark, folder), ["vec_id"])


@query("cls9_gradient_boosted_trees")
def cls9(spark, folder):
    return _fit_score(cl.GBTClassifier(maxIter=10, maxDepth=5, seed=1), _binary(spark, folder), _KEY)


@query("cls10_multilayer_perceptron")
def cls10(spark, folder):
    l = assemble(balanced(views.labelled_lines(spark, folder)), X)
    return _fit_score(cl.MultilayerPerceptronClassifier(layers=[4, 5, 4, 3], blockSize=128, seed=1234, maxIter=100), l, _KEY)


@query("cls11_one_vs_rest")
def cls11(spark, folder):
    train, test = sampling.hash_split(_points(spark, folder), ["vec_id"], 80)
    model = cl.OneVsRest(classifier=cl.LogisticRegression(maxIter=100, tol=1e-6), parallelism=4).fit(train)
    return ev.class_metrics(ev.confusion(model.transform(test), "label", "prediction"))


_KNN = """s AS (SELECT vec_id, label, embedding, row_number() OVER (ORDER BY vec_id) - 1 < floor(0.7 * (SELECT count(*) FROM embeddings)) AS train FROM embeddings),
  d AS (SELECT q.vec_id AS q, t.vec_id AS t, t.label, sqrt(list_sum(list_transform(list_zip(q.embedding, t.embedding), lambda z: pow(CAST(z[1] AS DOUBLE) - CAST(z[2] AS DOUBLE), 2)))) AS dist
    FROM s q JOIN s t ON NOT q.train AND t.train), r AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY dist, t) AS r FROM d),
  v AS (SELECT q, label, count(*) AS n FROM r WHERE r <= 6 GROUP BY 1, 2),
  w AS (SELECT q, label, row_number() OVER (PARTITION BY q ORDER BY n DESC, label) AS r FROM v)"""


@query("cls12_knn", f"WITH {_KNN} SELECT q AS vec_id, CAST(label AS DOUBLE) AS prediction FROM w WHERE r = 1")
def cls12(spark, folder):
    e = table(spark, folder, "embeddings")
    train, test = sampling.positional_split(e, ["vec_id"], 0.7)
    return neighbours.knn_classify(train, test, "vec_id", "embedding", "label", k=6)


@query("reg1_linear_regression", f"""WITH {ctes.LABELLED} SELECT round(regr_slope(x1, x0), 4) AS slope, round(regr_intercept(x1, x0), 4) AS intercept,
  round(regr_r2(x1, x0), 4) AS r2, count(*) AS n FROM labelled""")
def reg1(spark, folder):
    l = assemble(views.labelled_lines(spark, folder).withColumn("label", F.col("x1")), ["x0"])
    model = rg.LinearRegression(regParam=0.0, solver="normal").fit(l)
    s = model.summary
    return spark.createDataFrame([(round(float(model.coefficients[0]), 4), round(model.intercept, 4), round(s.r2, 4), s.numInstances)],
                                 "slope double, intercept double, r2 double, n bigint")


@query("reg1_two_features", f"""WITH {ctes.LABELLED}, c AS (SELECT covar_pop(x0, x0) AS s11, covar_pop(x2, x2) AS s22, covar_pop(x0, x2) AS s12,
  covar_pop(x0, x1) AS s1y, covar_pop(x2, x1) AS s2y FROM labelled) SELECT round((s22 * s1y - s12 * s2y) / (s11 * s22 - s12 * s12), 5) AS b0,
  round((s11 * s2y - s12 * s1y) / (s11 * s22 - s12 * s12), 5) AS b1 FROM c""")
def reg1_two(spark, folder):
    l = assemble(views.labelled_lines(spark, folder).withColumn("label", F.col("x1")), ["x0", "x2"])
    b = rg.LinearRegression(solver="normal").fit(l).coefficients
    return spark.createDataFrame([(round(float(b[0]), 5), round(float(b[1]), 5))], "b0 double, b1 double")


@query("reg1_elastic_net")
def reg1_elastic(spark, folder):
    return _regress(rg.LinearRegression(maxIter=100, regParam=0.01, elasticNetParam=0.8, tol=1e-6), _priced(spark, folder), _KEY)


@query("reg2_decision_tree")
def reg2(spark, folder):
    return _regress(rg.DecisionTreeRegressor(maxDepth=5, seed=1), _priced(spark, folder), _KEY)


@query("reg3_random_forest")
def reg3(spark, folder):
    return _regress(rg.RandomForestRegressor(numTrees=10, maxDepth=5, seed=1), _priced(spark, folder), _KEY)


@query("reg4_gradient_boosted_trees")
def reg4(spark, folder):
    return _regress(rg.GBTRegressor(maxIter=10, maxDepth=5, seed=1), _priced(spark, folder), _KEY)


@query("reg5_isotonic", f"""WITH g AS (SELECT l_quantity AS x, avg(l_discount * 10) AS m, count(*) AS w FROM lineitem GROUP BY 1),
  c AS (SELECT x, sum(m * w) OVER (ORDER BY x) AS cs, sum(w) OVER (ORDER BY x) AS cw, m * w AS t, w FROM g),
  a AS (SELECT lo.x AS lo, hi.x AS hi, (hi.cs - lo.cs + lo.t) / (hi.cw - lo.cw + lo.w) AS mean FROM c lo JOIN c hi ON lo.x <= hi.x),
  f AS (SELECT g.x, a.lo, min(a.mean) AS low FROM g JOIN a ON a.lo <= g.x AND a.hi >= g.x GROUP BY 1, 2)
  SELECT x AS quantity, round(max(low), 5) AS fit FROM f GROUP BY x""")
def reg5(spark, folder):
    """Rows are first averaged per feature value, with their number as weight."""
    points = table(spark, folder, "lineitem").groupBy(F.col("l_quantity").alias("quantity")).agg(
        F.avg(F.col("l_discount") * 10).alias("label"), F.count(F.lit(1)).cast("double").alias("weight"))
    points = assemble(points, ["quantity"])
    model = rg.IsotonicRegression(weightCol="weight").fit(points)
    return model.transform(points).select("quantity", F.round("prediction", 5).alias("fit"))


@query("reg6_aft_survival")
def reg6(spark, folder):
    l = assemble(table(spark, folder, "lineitem").select(
        F.col("l_quantity").alias("label"), (F.col("l_returnflag") != "A").cast("double").alias("censor"),
        (F.col("l_discount") * 10).alias("a"), (F.col("l_tax") * 10).alias("b")), ["a", "b"])
    model = rg.AFTSurvivalRegression(quantileProbabilities=[0.3, 0.6], quantilesCol="q", maxIter=10).fit(l)
    q = vector_to_array("q")
    return model.transform(l).groupBy("censor").agg(row_count(), F.avg("prediction").alias("mean_prediction"), F.avg(q[0]).alias("q30"), F.avg(q[1]).alias("q60"))


@query("rec1_als_explicit")
def rec1(spark, folder):
    train, test = sampling.hash_split(views.ratings(spark, folder), ["user", "item"], 80)
    model = factors.alternate(train, "user", "item", "rating", rank=10, rounds=10, reg=0.1, seed=1)
    return ev.regression_metrics(model.predict(test, drop=True), "rating", "prediction")


@query("rec2_als_implicit")
def rec2(spark, folder):
    shifted = views.ratings(spark, folder).withColumn("conf", F.col("rating") - 2.5)
    train, test = sampling.hash_split(shifted, ["user", "item"], 80)
    model = factors.alternate(train, "user", "item", "conf", rank=10, rounds=20, reg=1.0, alpha=1.0, seed=1, user_blocks=8)
    truth = model.predict(test, drop=True).select(numeric.binarise(F.col("conf")).alias("label"), numeric.clamp(F.col("prediction").cast("double")).alias("prediction"))
    return ev.regression_metrics(truth, "label", "prediction")


@query("rec3_top_items_for_users")
def rec3(spark, folder):
    model = factors.alternate(views.ratings(spark, folder), "user", "item", "rating", rank=10, rounds=10, reg=0.1, seed=1)
    found = recommend.top_items(model.users, model.items, 10).select(F.col("user").cast("int").alias("user"), F.col("item").cast("int").alias("item"))
    # Ratings and ranks as the model tells them, in single precision.
    rated = model.predict(found).select("user", "item", F.col("prediction").alias("rating"))
    return top_k_per_group(rated, "user", "rating", "item", 10).select("user", "rank", "item", "rating")


@query("rec3_exact_top_items", f"""WITH {ctes.RATINGS}, i AS (SELECT least(10, count(DISTINCT item)) AS k FROM ratings)
  SELECT DISTINCT user, k AS n, true AS equal FROM ratings, i""")
def rec3_exact(spark, folder):
    """The ten best items of each user by bounds: rank for rank the scores of the product of all users and items."""
    model = factors.alternate(views.ratings(spark, folder), "user", "item", "rating", rank=10, rounds=10, reg=0.1, seed=1)
    found = recommend.top_items(model.users, model.items, 10)
    every = recommend.top_items(model.users, model.items, 10, bounded=False).select("user", "rank", F.col("score").alias("_score"))
    both = found.join(every, ["user", "rank"], "full")
    return both.groupBy("user").agg(row_count(), F.bool_and(F.coalesce(F.abs(F.col("score") - F.col("_score")) < 1e-4, F.lit(False))).alias("equal"))


@query("rec4_false_positives", f"""WITH {ctes.RATINGS}, p AS (SELECT item, max(rating) AS prediction FROM ratings GROUP BY item)
  SELECT r.user, r.item, p_name AS title, round(r.rating, 4) AS rating, round(prediction, 4) AS prediction FROM ratings r JOIN p ON p.item = r.item
  JOIN part ON p_partkey = r.item WHERE r.rating <= 1 AND prediction >= 4""")
def rec4(spark, folder):
    r = views.ratings(spark, folder)
    p = r.groupBy("item").agg(F.max("rating").alias("prediction"))
    titles = table(spark, folder, "part").select(F.col("p_partkey").alias("item"), F.col("p_name").alias("title"))
    return r.join(p, "item").where((F.col("rating") <= 1) & (F.col("prediction") >= 4)).join(titles, "item").select(
        F.col("user").cast("bigint").alias("user"), F.col("item").cast("bigint").alias("item"), "title", F.round("rating", 4).alias("rating"), F.round("prediction", 4).alias("prediction"))


def _lloyd_sql(steps: int) -> str:
    parts = ["u AS MATERIALIZED (SELECT vec_id, unnest(range(0, 64)) AS p, CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings)",
             "k0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id) - 1 AS c, vec_id FROM (SELECT vec_id FROM embeddings ORDER BY vec_id LIMIT 5))",
             "c0 AS MATERIALIZED (SELECT k0.c, u.p, u.v FROM k0 JOIN u USING (vec_id))"]
    for i in range(1, steps + 1):
        parts.append(f"a{i} AS MATERIALIZED (SELECT vec_id, arg_min(c, d) AS c FROM (SELECT u.vec_id, c.c, sum((u.v - c.v) * (u.v - c.v)) AS d FROM u JOIN c{i-1} c ON u.p = c.p GROUP BY 1, 2) GROUP BY 1)")
        parts.append(f"m{i} AS MATERIALIZED (SELECT a.c, u.p, avg(u.v) AS v FROM a{i} a JOIN u USING (vec_id) GROUP BY 1, 2)")
        parts.append(f"c{i} AS MATERIALIZED (SELECT o.c, o.p, coalesce(m.v, o.v) AS v FROM c{i-1} o LEFT JOIN m{i} m ON m.c = o.c AND m.p = o.p)")
    return "WITH " + ", ".join(parts) + f" SELECT c AS cluster, p AS pos, round(v, 5) AS centre FROM c{steps}"


@query("clu1_kmeans_lloyd", _lloyd_sql(20))
def clu1(spark, folder):
    """Centres at rest; on the test data that takes fewer rounds than the SQL form has."""
    e = table(spark, folder, "embeddings")
    centres, _ = models.kmeans_lloyd(e, "embedding", models.first_points(e, "embedding", "vec_id", 5))
    rows = [(int(c), int(p), round(float(centres[c, p]), 5)) for c in range(centres.shape[0]) for p in range(centres.shape[1])]
    return spark.createDataFrame(rows, "cluster bigint, pos bigint, centre double")


@query("clu2_kmeans")
def clu2(spark, folder):
    p = _points(spark, folder)
    model = cu.KMeans(k=10, initMode="k-means||", maxIter=10, seed=1).fit(p)
    return model.transform(p).groupBy("prediction").agg(row_count()).withColumn("cost", F.lit(model.summary.trainingCost))


@query("clu2_kmeans_random_start")
def clu2_random(spark, folder):
    """Centres, sizes and cost from a random start."""
    model = cu.KMeans(k=10, initMode="random", maxIter=10, seed=1).fit(_points(spark, folder))
    rows = [(i, int(n), [float(v) for v in c]) for i, (n, c) in enumerate(zip(model.summary.clusterSizes, model.clusterCenters()))]
    return spark.createDataFrame(rows, "cluster int, n bigint, centre array<double>").withColumn("cost", F.lit(model.summary.trainingCost))


@query("clu3_bisecting_kmeans")
def clu3(spark, folder):
    p = _points(spark, folder)
    model = cu.BisectingKMeans(k=6, maxIter=20, seed=1).fit(p)
    rows = [(i, [float(v) for v in c]) for i, c in enumerate(model.clusterCenters())]
    centres = spark.createDataFrame(rows, "prediction int, centre array<double>")
    sizes = model.transform(p).groupBy("prediction").agg(row_count())
    return sizes.join(centres, "prediction").withColumn("cost", F.lit(model.summary.trainingCost))


@query("clu4_gaussian_mixture")
def clu4(spark, folder):
    l = assemble(balanced(views.labelled_lines(spark, folder)), X)
    model = cu.GaussianMixture(k=3, maxIter=100, seed=1).fit(l)
    return model.transform(l).groupBy("prediction").agg(row_count(), F.avg(F.array_max(vector_to_array("probability"))).alias("sureness"))


@query("clu4_mixture_parameters")
def clu4_parameters(spark, folder):
    """Weight, mean and covariance of each component."""
    model = cu.GaussianMixture(k=3, maxIter=100, seed=1).fit(assemble(balanced(views.labelled_lines(spark, folder)), X))
    rows = [(i, float(w), [float(v) for v in g.mean.toArray()], [[float(v) for v in row] for row in g.cov.toArray()])
            for i, (w, g) in enumerate(zip(model.weights, model.gaussians))]
    return spark.createDataFrame(rows, "component int, weight double, mean array<double>, covariance array<array<double>>")


@query("clu5_power_iteration")
def clu5(spark, folder):
    """Two groups of events from the Gaussian similarity of neighbours in value order."""
    e = table(spark, folder, "events").select("event_id", "value", (F.col("user_id") / 50).alias("u"))
    pairs = band_pairs(e, ["value", "event_id"], ["event_id", "value", "u"], 3)
    s = numeric.gaussian_similarity(F.col("value0"), F.col("u0"), F.col("value1"), F.col("u1"))
    graph = pairs.select(F.col("event_id0").alias("src"), F.col("event_id1").alias("dst"), (s + F.lit(1e-9)).alias("weight"))
    return power_iteration_clusters(graph, k=2, iterations=15).groupBy("cluster").agg(row_count())


def _corpus(spark, folder):
    """Counted terms, written once because every round of a fit reads them."""
    docs = balanced(table(spark, folder, "documents").select("doc_id", "text"))
    corpus, learned = text_corpus(docs, "doc_id", "text", 10_000, ["the", "of", "and", "is", "de", "la"])
    return balanced(corpus), learned.terms


@query("clu6_lda_online")
def clu6(spark, folder):
    corpus, terms = _corpus(spark, folder)
    model = cu.LDA(k=20, maxIter=10, optimizer="online", seed=1).fit(corpus)
    weights = F.inline(F.arrays_zip("termIndices", "termWeights"))
    topics = model.describeTopics(5).select("topic", weights).withColumnsRenamed({"termIndices": "pos", "termWeights": "weight"})
    return topics.join(terms, "pos").select("topic", "term", "weight")


@query("clu6_lda_em")
def clu6_em(spark, folder):
    corpus, _ = _corpus(spark, folder)
    model = cu.LDA(k=20, maxIter=10, optimizer="em", seed=1).fit(corpus)
    # logPerplexity would infer the topics of all documents again for the same likelihood.
    likelihood = model.logLikelihood(corpus)
    tokens = corpus.agg(F.sum(F.aggregate(active_entries("features"), F.lit(0.0), lambda a, e: a + e["weight"]))).first()[0]
    best = F.array_position(vector_to_array("topicDistribution"), F.array_max(vector_to_array("topicDistribution"))) - 1
    return model.transform(corpus).groupBy(best.alias("topic")).agg(row_count()).withColumn("log_likelihood", F.lit(likelihood)).withColumn(
        "log_perplexity", F.lit(-likelihood / tokens if tokens else float("nan")))


_SUPPORT = 0.02
_SETS = f"""{ctes.BASKETS}, m AS (SELECT ceil({_SUPPORT} * count(DISTINCT l_orderkey)) AS least FROM baskets),
  sets AS (SELECT item AS items, count(*) AS freq FROM baskets GROUP BY 1 UNION ALL
  SELECT a.item || ',' || b.item, count(*) FROM baskets a JOIN baskets b ON a.l_orderkey = b.l_orderkey AND a.item < b.item GROUP BY 1)"""


@query("fpm1_frequent_itemsets", f"WITH {_SETS} SELECT items, freq FROM sets, m WHERE freq >= least")
def fpm1(spark, folder):
    found = patterns.frequent_itemsets(views.baskets(spark, folder), "items", _SUPPORT)
    return found.select(F.array_join("items", ",").alias("items"), "freq")


@query("fpm2_association_rules", f"""WITH {_SETS}, f AS (SELECT items, freq FROM sets, m WHERE freq >= least),
  r AS (SELECT string_split(items, ',')[1] AS a, string_split(items, ',')[2] AS c, freq FROM f WHERE contains(items, ',')
  UNION ALL SELECT string_split(items, ',')[2], string_split(items, ',')[1], freq FROM f WHERE contains(items, ','))
  SELECT a AS antecedent, c AS consequent, round(r.freq / f.freq, 6) AS confidence FROM r JOIN f ON f.items = r.a WHERE r.freq / f.freq >= 0.1""")
def fpm2(spark, folder):
    rules = patterns.association_rules(patterns.frequent_itemsets(views.baskets(spark, folder), "items", _SUPPORT), 0.1)
    return rules.select(F.array_join("antecedent", ",").alias("antecedent"), "consequent", F.round("confidence", 6).alias("confidence"))


@query("fpm3_sequential_patterns", f"""WITH RECURSIVE {ctes.PRIORITY_YEARS}, m AS (SELECT ceil(0.5 * count(DISTINCT o_custkey)) AS least FROM py),
  r AS (SELECT o_custkey AS k, yr, item, item AS sequence, 1 AS length FROM py UNION
  SELECT r.k, py.yr, py.item, r.sequence || CASE WHEN py.yr = r.yr THEN '+' ELSE '>' END || py.item, r.length + 1
    FROM r JOIN py ON py.o_custkey = r.k AND (py.yr > r.yr OR py.yr = r.yr AND py.item > r.item) WHERE r.length < 5)
  SELECT sequence, count(DISTINCT k) AS freq FROM r GROUP BY sequence HAVING count(DISTINCT k) >= (SELECT least FROM m)""")
def fpm3(spark, folder):
    found = patterns.sequential_patterns(views.priority_years(spark, folder), "sequence", 0.5, 5)
    return found.select(F.array_join(F.transform("sequence", lambda s: F.array_join(s, "+")), ">").alias("sequence"), "freq")


def _texts(spark, folder):
    d = table(spark, folder, "documents").select("doc_id", "text")
    joined = d.join(table(spark, folder, "labels"), "doc_id")
    return balanced(staged(joined.select("doc_id", "text", F.col("toxic").cast("double").alias("label")), "texts"))


def _text_stages():
    tokens = Tokenizer(inputCol="text", outputCol="words")
    tf = HashingTF(inputCol="words", outputCol="features", numFeatures=1000)
    lr = cl.LogisticRegression(maxIter=10, regParam=0.001)
    return tf, lr, Pipeline(stages=[tokens, tf, lr])


def _hashed_texts(spark, folder, sizes=(10, 100, 1000)):
    """Label and, per size, the hashed counts of the words of a text; kept, as folds read them many times."""
    words = Tokenizer(inputCol="text", outputCol="words").transform(_texts(spark, folder))
    for n in sizes:
        words = HashingTF(inputCol="words", outputCol=f"features{n}", numFeatures=n).transform(words)
    return words.select("doc_id", "label", *[f"features{n}" for n in sizes]).persist(StorageLevel.MEMORY_AND_DISK)


@query("tun1_text_classifier_stages")
def tun1(spark, folder):
    return _fit_score(_text_stages()[2], _texts(spark, folder), ["doc_id"])


@query("tun2_cross_validation")
def tun2(spark, folder):
    """The texts are tokenised and hashed once for each size; the fits of all grid points and folds read the vectors."""
    lr, sizes, points = _text_stages()[1], [10, 100, 1000], _hashed_texts(spark, folder)
    grid = ParamGridBuilder().addGrid(lr.featuresCol, [f"features{n}" for n in sizes]).addGrid(lr.regParam, [0.1, 0.01]).build()
    model = CrossValidator(estimator=lr, estimatorParamMaps=grid, evaluator=BinaryClassificationEvaluator(), numFolds=2, parallelism=4, seed=1).fit(points)
    points.unpersist()
    rows = [(int(g[lr.featuresCol].removeprefix("features")), float(g[lr.regParam]), float(m)) for g, m in zip(grid, model.avgMetrics)]
    return spark.createDataFrame(rows, "features int, reg double, auc double")


@query("tun3_train_validation_split")
def tun3(spark, folder):
    lr = rg.LinearRegression(maxIter=10)
    grid = (ParamGridBuilder().addGrid(lr.regParam, [0.1, 0.01]).addGrid(lr.fitIntercept, [False, True])
            .addGrid(lr.elasticNetParam, [0.0, 0.5, 1.0]).build())
    model = TrainValidationSplit(estimator=lr, estimatorParamMaps=grid, evaluator=RegressionEvaluator(), trainRatio=0.8, parallelism=4, seed=1).fit(
        _priced(spark, folder))
    rows = [(float(g[lr.regParam]), bool(g[lr.fitIntercept]), float(g[lr.elasticNetParam]), float(m)) for g, m in zip(grid, model.validationMetrics)]
    return spark.createDataFrame(rows, "reg double, intercept boolean, elastic double, rmse double")


@query("tun4_parameter_maps")
def tun4(spark, folder):
    """The same estimator with its own settings and with settings given at fit time."""
    p = _binary(spark, folder)
    lr = cl.LogisticRegression(maxIter=10, regParam=0.01)
    given = {lr.maxIter: 20, lr.regParam: 0.1, lr.threshold: 0.55, lr.probabilityCol: "chance"}
    first, second = lr.fit(p), lr.fit(p, given)
    out = first.transform(p).withColumnRenamed("prediction", "first").drop("rawPrediction", "probability")
    return second.transform(out).groupBy("first", F.col("prediction").alias("second")).agg(row_count(), F.avg(vector_to_array("chance")[1]).alias("chance"))


@query("udf4_custom_estimator", "SELECT label, 0.0::DOUBLE AS prediction, 0.0::DOUBLE AS raw, count(*) AS n FROM embeddings GROUP BY label")
def udf4(spark, folder):
    p = _points(spark, folder).withColumn("label", F.col("label").cast("int"))
    out = UntrainedClassifier(maxIter=5).fit(p).transform(p)
    raw = F.abs(vector_to_array("rawPrediction")[1])
    return out.groupBy("label", "prediction", raw.alias("raw")).agg(row_count())
