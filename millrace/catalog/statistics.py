"""Linear algebra, statistics and evaluation."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.catalog import ctes
from millrace.operators import evaluation as ev
from millrace.operators import linear
from millrace.operators.ranking import top_k_per_group
from millrace.registry import query
from millrace.sources import views
from millrace.sources.tables import table

MEASURES = ("x0", "x1", "x2", "x3")


def _rounded(df, digits=5):
    return df.select(*[F.round(c, digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


_COSINE = """u AS (SELECT vec_id, unnest(range(0, 64)) AS p, CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings),
  g AS (SELECT a.p AS i, b.p AS j, sum(a.v * b.v) AS dot FROM u a JOIN u b ON a.vec_id = b.vec_id AND a.p <= b.p GROUP BY 1, 2),
  c AS (SELECT g.i, g.j, g.dot / sqrt(x.dot * y.dot) AS cosine FROM g JOIN g x ON x.i = g.i AND x.j = g.i JOIN g y ON y.i = g.j AND y.j = g.j WHERE g.i < g.j)"""


@query("lin1_column_cosines", f"WITH {_COSINE} SELECT i, j, round(cosine, 5) AS cosine FROM c")
def lin1(spark, folder):
    return linear.column_cosines(table(spark, folder, "embeddings"), "embedding").select("i", "j", F.round("cosine", 5).alias("cosine"))


@query("lin1_sampled_cosines_error")
def lin1_sampled(spark, folder):
    e = table(spark, folder, "embeddings")
    return linear.cosine_error(linear.column_cosines(e, "embedding"), linear.sampled_column_cosines(e, "embedding", 0.1, ["vec_id"]))


@query("lin2_singular_values")
def lin2(spark, folder):
    return linear.singular_values(table(spark, folder, "embeddings"), "embedding")


@query("lin2_squared_norm", """WITH u AS (SELECT unnest(embedding) AS x FROM embeddings)
  SELECT (SELECT max(len(embedding)) FROM embeddings) AS n, round(sum(CAST(x AS DOUBLE) * x), 4) AS squared_norm, true AS descending FROM u""")
def lin2_norm(spark, folder):
    """The squares of all singular values add up to the squared entries of the matrix."""
    values = linear.singular_values(table(spark, folder, "embeddings"), "embedding")
    falling = F.array_agg(F.col("sigma")).alias("s")
    return values.orderBy("k").agg(F.count(F.lit(1)).cast("int").alias("n"), F.round(F.sum(F.col("sigma") * F.col("sigma")), 4).alias("squared_norm"), falling).select(
        F.col("n").cast("bigint").alias("n"), "squared_norm", (F.reverse(F.array_sort("s")) == F.col("s")).alias("descending"))


@query("lin1_sampled_bounds", f"""WITH {_COSINE} SELECT i, j, round(cosine, 5) AS cosine, true AS near FROM c""")
def lin1_bounds(spark, folder):
    """Every pair of columns: its cosine, and whether the sampled estimate lies within 0.2 of it."""
    e = table(spark, folder, "embeddings")
    sampled = linear.sampled_column_cosines(e, "embedding", 0.1, ["vec_id"]).withColumnRenamed("cosine", "_c")
    near = F.abs(F.col("cosine") - F.coalesce("_c", F.lit(0.0))) <= 0.2
    return linear.column_cosines(e, "embedding").join(sampled, ["i", "j"], "left").select("i", "j", F.round("cosine", 5).alias("cosine"), near.alias("near"))


@query("lin3_principal_components")
def lin3(spark, folder):
    """Loadings of all components; each is given the sign that makes its largest loading positive."""
    e = table(spark, folder, "embeddings")
    width = e.agg(F.max(F.size("embedding"))).first()[0]
    _, pc = linear.principal_components(e, "embedding", width)
    rows = [(int(d), int(k), float(pc[d, k])) for d in range(pc.shape[0]) for k in range(pc.shape[1])]
    return spark.createDataFrame(rows, "dimension int, component int, loading double")


@query("sta1_describe", """SELECT unnest(['count', 'mean', 'stddev', 'min', 'max']) AS summary,
  unnest([CAST(count(*) AS DOUBLE), round(avg(l_quantity), 5), round(stddev_samp(l_quantity), 5), min(l_quantity), max(l_quantity)]) AS value FROM lineitem""")
def sta1(spark, folder):
    d = table(spark, folder, "lineitem").select("l_quantity").describe()
    return d.select("summary", F.round(F.col("l_quantity").cast("double"), 5).alias("value"))


@query("sta2_column_summary", f"""WITH {ctes.LABELLED}, u AS (SELECT label, unnest(['x0', 'x1', 'x2', 'x3']) AS name, unnest([x0, x1, x2, x3]) AS v FROM labelled)
  SELECT label, name, count(*) AS n, round(avg(v), 5) AS mean, round(var_samp(v), 5) AS variance, count(*) FILTER (v <> 0) AS non_zeros,
  round(min(v), 5) AS low, round(max(v), 5) AS high FROM u GROUP BY 1, 2""")
def sta2(spark, folder):
    return _rounded(linear.column_summary(views.labelled_lines(spark, folder), MEASURES, "label")).withColumn("label", F.col("label"))


@query("sta3_label_correlations", f"""WITH {ctes.LABELLED} SELECT unnest(['x0', 'x1', 'x2', 'x3']) AS name,
  unnest([round(corr(label, x0), 5), round(corr(label, x1), 5), round(corr(label, x2), 5), round(corr(label, x3), 5)]) AS corr FROM labelled""")
def sta3(spark, folder):
    return _rounded(linear.label_correlations(views.labelled_lines(spark, folder), "label", MEASURES))


def _scored(spark, folder):
    return table(spark, folder, "events").select(F.floor("value").cast("double").alias("score"),
                                                 (F.col("event_type") == "purchase").cast("int").alias("label"))


_SCORED = """s AS (SELECT floor(value) AS threshold, count(*) AS n, count(*) FILTER (event_type = 'purchase') AS p FROM events GROUP BY 1),
  c AS (SELECT threshold, sum(p) OVER (ORDER BY threshold DESC) AS tp, sum(n - p) OVER (ORDER BY threshold DESC) AS fp FROM s),
  m AS (SELECT threshold, tp, fp, tp / (tp + fp) AS precision, tp / max(tp) OVER () AS recall, fp / max(fp) OVER () AS fpr FROM c)"""


@query("eva1_threshold_metrics", f"""WITH {_SCORED} SELECT threshold, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, round(precision, 5) AS precision,
  round(recall, 5) AS recall, round(fpr, 5) AS fpr, round(CASE WHEN precision + recall = 0 THEN 0 ELSE 2 * precision * recall / (precision + recall) END, 5) AS f1,
  round(CASE WHEN precision + recall = 0 THEN 0 ELSE 1.25 * precision * recall / (0.25 * precision + recall) END, 5) AS f05 FROM m""")
def eva1(spark, folder):
    return _rounded(ev.threshold_metrics(ev.threshold_counts(_scored(spark, folder), "score", "label"))).withColumn(
        "threshold", F.col("threshold"))


@query("eva1_curve_areas", f"""WITH {_SCORED}, n AS (SELECT *, lag(fpr) OVER w AS f0, lag(recall) OVER w AS r0, lag(precision) OVER w AS p0 FROM m
  WINDOW w AS (ORDER BY threshold DESC)) SELECT round(sum((fpr - coalesce(f0, 0)) * (recall + coalesce(r0, 0)) / 2), 5) AS area_under_roc,
  round(sum((recall - coalesce(r0, 0)) * (precision + coalesce(p0, precision)) / 2), 5) AS area_under_pr FROM n""")
def eva1_areas(spark, folder):
    return _rounded(ev.curve_areas(ev.threshold_metrics(ev.threshold_counts(_scored(spark, folder), "score", "label"))))


def _guessed(spark, folder):
    guess = F.when(F.col("l_quantity") < 15, 0.0).when(F.col("l_discount") > 0.05, 1.0).otherwise(2.0)
    label = F.when(F.col("l_returnflag") == "A", 0.0).when(F.col("l_returnflag") == "N", 1.0).otherwise(2.0)
    return table(spark, folder, "lineitem").select(label.alias("label"), guess.alias("prediction"))


_GUESSED = """g AS (SELECT CASE l_returnflag WHEN 'A' THEN 0.0::DOUBLE WHEN 'N' THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS label,
  CASE WHEN l_quantity < 15 THEN 0.0::DOUBLE WHEN l_discount > 0.05 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS prediction FROM lineitem),
  k AS (SELECT DISTINCT label AS cls FROM g), per AS (SELECT cls, (SELECT count(*) FROM g WHERE label = cls AND prediction = cls) AS tp,
  (SELECT count(*) FROM g WHERE label = cls) AS actual, (SELECT count(*) FROM g WHERE prediction = cls) AS predicted,
  (SELECT count(*) FROM g) AS t FROM k), cm AS (SELECT *, tp / predicted AS precision, tp / actual AS recall, 2 * tp / (predicted + actual) AS f1,
  (predicted - tp) / (t - actual) AS fpr FROM per)"""


@query("eva2_confusion_matrix", f"WITH {_GUESSED} SELECT label, prediction, count(*) AS n FROM g GROUP BY 1, 2")
def eva2(spark, folder):
    return ev.confusion(_guessed(spark, folder), "label", "prediction")


@query("eva2_class_metrics", f"""WITH {_GUESSED} SELECT cls, tp, actual, predicted, round(precision, 5) AS precision, round(recall, 5) AS recall,
  round(f1, 5) AS f1, round(fpr, 5) AS fpr FROM cm""")
def eva2_classes(spark, folder):
    return _rounded(ev.class_metrics(ev.confusion(_guessed(spark, folder), "label", "prediction")))


@query("eva2_weighted_metrics", f"""WITH {_GUESSED} SELECT round(sum(tp) / max(t), 5) AS accuracy, round(sum(precision * actual) / max(t), 5) AS weighted_precision,
  round(sum(recall * actual) / max(t), 5) AS weighted_recall, round(sum(f1 * actual) / max(t), 5) AS weighted_f1, round(sum(fpr * actual) / max(t), 5) AS weighted_fpr FROM cm""")
def eva2_weighted(spark, folder):
    return _rounded(ev.weighted_metrics(ev.class_metrics(ev.confusion(_guessed(spark, folder), "label", "prediction"))))


def _brand_sets(spark, folder):
    """Brands returned (truth) and brands with a high discount (guess) in each order."""
    p = table(spark, folder, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    l = table(spark, folder, "lineitem").select("l_orderkey", "l_partkey", "l_returnflag", "l_discount").join(p, "l_partkey")
    return l.groupBy("l_orderkey").agg(
        F.collect_set(F.when(F.col("l_discount") >= 0.05, F.col("p_brand"))).alias("predicted"),
        F.collect_set(F.when(F.col("l_returnflag") == "R", F.col("p_brand"))).alias("actual"))


_SETS = """b AS (SELECT l_orderkey AS k, p_brand, bool_or(l_discount >= 0.05) AS p, bool_or(l_returnflag = 'R') AS a
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2),
  d AS (SELECT k, count(*) FILTER (p AND a) AS b, count(*) FILTER (p) AS p, count(*) FILTER (a) AS l FROM b GROUP BY k)"""


@query("eva3_multilabel_metrics", f"""WITH {_SETS} SELECT count(*) AS n, round(avg(CASE WHEN p = 0 THEN 0 ELSE b / p END), 5) AS precision,
  round(avg(CASE WHEN l = 0 THEN 0 ELSE b / l END), 5) AS recall, round(avg(CASE WHEN p + l = 0 THEN 0 ELSE 2 * b / (p + l) END), 5) AS f1,
  round(avg(CASE WHEN p + l - b = 0 THEN 0 ELSE b / (p + l - b) END), 5) AS accuracy, round(avg(CASE WHEN b = p AND b = l THEN 1.0 ELSE 0.0 END), 5) AS subset_accuracy,
  round(sum(b) / sum(p), 5) AS micro_precision, round(sum(b) / sum(l), 5) AS micro_recall, round(2 * sum(b) / sum(p + l), 5) AS micro_f1,
  round(sum(p + l - 2 * b) / (count(*) * (SELECT count(DISTINCT p_brand) FROM b WHERE a)), 5) AS hamming_loss FROM d""")
def eva3(spark, folder):
    return _rounded(ev.multilabel_metrics(_brand_sets(spark, folder), "predicted", "actual"))


@query("eva3_label_metrics", f"""WITH {_SETS}, c AS (SELECT p_brand AS cls, count(*) FILTER (p AND a) AS tp, count(*) FILTER (p) AS pp, count(*) FILTER (a) AS aa
  FROM b WHERE p OR a GROUP BY 1) SELECT cls, round(tp / pp, 5) AS precision, round(tp / aa, 5) AS recall, round(2 * tp / (pp + aa), 5) AS f1 FROM c""")
def eva3_labels(spark, folder):
    return _rounded(ev.label_metrics(_brand_sets(spark, folder), "predicted", "actual"))


_RANKED = f"""{ctes.RATINGS}, rk AS (SELECT user, item, row_number() OVER (PARTITION BY user ORDER BY rating DESC, item) AS rank FROM ratings),
  top AS (SELECT * FROM rk WHERE rank <= 10), rel AS (SELECT DISTINCT o_custkey AS user, l_partkey AS item FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  WHERE l_discount <= 0.05), sz AS (SELECT user, count(*) AS m FROM rel GROUP BY 1),
  h AS (SELECT t.user, t.rank, CASE WHEN r.item IS NULL THEN 0 ELSE 1 END AS hit FROM top t LEFT JOIN rel r ON r.user = t.user AND r.item = t.item),
  hh AS (SELECT *, sum(hit) OVER (PARTITION BY user ORDER BY rank) AS hits FROM h),
  pu AS (SELECT user, sum(CASE WHEN hit = 1 THEN hits / rank ELSE 0 END) AS ap""" + "".join(
    f", sum(hit) FILTER (rank <= {k}) AS h{k}, coalesce(sum(1 / log2(rank + 1)) FILTER (rank <= {k} AND hit = 1), 0) AS d{k}" for k in (1, 3, 5)) + """
  FROM hh GROUP BY user), j AS (SELECT pu.*, coalesce(m, 0) AS m FROM pu LEFT JOIN sz USING (user))"""


@query("eva4_ranking_metrics", f"WITH {_RANKED} SELECT round(avg(CASE WHEN m = 0 THEN 0 ELSE ap / m END), 5) AS map" + "".join(
    f", round(avg(h{k} / {k}), 5) AS precision_{k}, round(avg(CASE WHEN m = 0 THEN 0 ELSE d{k} / list_sum(list_transform(range(1, least({k}, m) + 1), "
    f"lambda i: 1 / log2(i + 1))) END), 5) AS ndcg_{k}" for k in (1, 3, 5)) + " FROM j")
def eva4(spark, folder):
    top = top_k_per_group(views.ratings(spark, folder), "user", "rating", "item", 10)
    o = table(spark, folder, "orders").select("o_orderkey", F.col("o_custkey").cast("int").alias("user"))
    l = table(spark, folder, "lineitem").where(F.col("l_discount") <= 0.05).select("l_orderkey", F.col("l_partkey").cast("int").alias("item"))
    relevant = l.join(o, l.l_orderkey == o.o_orderkey).select("user", "item")
    return _rounded(ev.ranking_metrics(top, relevant, "user", "item", "rank"))


@query("eva5_regression_metrics", """WITH r AS (SELECT event_type, value AS y, value * 0.8 + user_id / 50 AS p FROM events), m AS (SELECT event_type, avg(y) AS my FROM r GROUP BY 1)
  SELECT event_type, count(*) AS n, round(avg(pow(y - p, 2)), 5) AS mse, round(sqrt(avg(pow(y - p, 2))), 5) AS rmse, round(avg(abs(y - p)), 5) AS mae,
  round(1 - sum(pow(y - p, 2)) / sum(pow(y - my, 2)), 5) AS r2, round(avg(pow(p - my, 2)), 5) AS explained_variance FROM r JOIN m USING (event_type) GROUP BY 1""")
def eva5(spark, folder):
    e = table(spark, folder, "events").select("event_type", F.col("value").alias("y"), (F.col("value") * 0.8 + F.col("user_id") / 50).alias("p"))
    return _rounded(ev.regression_metrics(e, "y", "p", "event_type"))


@query("eva6_accuracy", f"""WITH {_GUESSED} SELECT count(*) AS n, round(avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END), 6) AS accuracy,
  round(avg(CASE WHEN label = prediction THEN 0.0 ELSE 1.0 END), 6) AS error FROM g""")
def eva6(spark, folder):
    return _rounded(ev.accuracy(_guessed(spark, folder), "label", "prediction"), 6)
