"""Feature transformers over documents, parts, line items and events."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml import feature as ft
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import ChiSquareTest
from pyspark.sql import functions as F

from millrace.catalog import ctes
from millrace.functions.numeric import row_count
from millrace.functions.vectors import spread
from millrace.operators import dictionary, features, linear, word_vectors
from millrace.plans.durable import staged
from millrace.plans.sizing import balanced
from millrace.registry import query
from millrace.sources import views
from millrace.sources.tables import table

XYZ = ("x", "y", "z")
PARTS = "parts AS (SELECT p_partkey, p_size / 49 AS x, p_retailprice / 1999 AS y, (p_partkey % 7) / 6.9::DOUBLE - 0.5::DOUBLE AS z FROM part)"


def _docs(spark, folder):
    return balanced(table(spark, folder, "documents").select("doc_id", "text"))


def _parts(spark, folder):
    p = table(spark, folder, "part").select(
        "p_partkey", (F.col("p_size") / 49).alias("x"), (F.col("p_retailprice") / 1999).alias("y"),
        ((F.col("p_partkey") % 7) / F.lit(6.9) - 0.5).alias("z"))
    return features.assemble(p, XYZ)


_TOKENS = r"tok AS (SELECT doc_id, string_split_regex(regexp_replace(lower(text), '\s+$', ''), '\s') AS t FROM documents)"
_GAPS = r"tok AS (SELECT doc_id, list_filter(string_split_regex(lower(text), '\W'), lambda w: w <> '') AS t FROM documents)"


@query("fea1_tokenizer", f"""WITH {_TOKENS} SELECT doc_id, len(t) AS tokens, len(list_distinct(t)) AS kinds, t[1] AS head FROM tok""")
def fea1(spark, folder):
    out = ft.Tokenizer(inputCol="text", outputCol="t").transform(_docs(spark, folder))
    return out.select("doc_id", F.size("t").cast("bigint").alias("tokens"),
                      F.size(F.array_distinct("t")).cast("bigint").alias("kinds"), F.col("t")[0].alias("head"))


@query("fea2_regex_tokenizer", f"WITH {_GAPS} SELECT w AS word, count(*) AS n FROM (SELECT unnest(t) AS w FROM tok) GROUP BY w")
def fea2(spark, folder):
    out = ft.RegexTokenizer(inputCol="text", outputCol="t", pattern=r"\W").transform(_docs(spark, folder))
    return out.select(F.explode("t").alias("word")).groupBy("word").agg(row_count())


STOP = ["the", "of", "and", "is", "de", "la"]


@query("fea3_stop_words_remover", f"""WITH {_GAPS} SELECT doc_id, len(list_filter(t, lambda w: w NOT IN ('the','of','and','is','de','la'))) AS kept FROM tok""")
def fea3(spark, folder):
    raw = ft.RegexTokenizer(inputCol="text", outputCol="t", pattern=r"\W").transform(_docs(spark, folder))
    out = ft.StopWordsRemover(inputCol="t", outputCol="k", stopWords=STOP).transform(raw)
    return out.select("doc_id", F.size("k").cast("bigint").alias("kept"))


@query("fea4_ngram", f"""WITH {_GAPS}, w AS (SELECT doc_id, unnest(t) AS w, generate_subscripts(t, 1) AS i FROM tok),
  g AS (SELECT doc_id, w || ' ' || lead(w) OVER (PARTITION BY doc_id ORDER BY i) AS g FROM w)
  SELECT doc_id, count(*) AS grams, count(DISTINCT g) AS kinds, min(g) AS low FROM g WHERE g IS NOT NULL GROUP BY doc_id""")
def fea4(spark, folder):
    raw = ft.RegexTokenizer(inputCol="text", outputCol="t", pattern=r"\W").transform(_docs(spark, folder))
    out = ft.NGram(n=2, inputCol="t", outputCol="g").transform(raw).where(F.size("g") > 0)
    return out.select("doc_id", F.size("g").cast("bigint").alias("grams"),
                      F.size(F.array_distinct("g")).cast("bigint").alias("kinds"), F.array_min("g").alias("low"))


@query("fea5_hashing_tf", f"WITH {_TOKENS} SELECT doc_id, CAST(len(t) AS DOUBLE) AS total FROM tok")
def fea5(spark, folder):
    raw = ft.Tokenizer(inputCol="text", outputCol="t").transform(_docs(spark, folder))
    out = ft.HashingTF(inputCol="t", outputCol="f", numFeatures=64).transform(raw)
    total = F.aggregate(features.active_entries("f"), F.lit(0.0), lambda a, e: a + e["weight"])
    return out.select("doc_id", total.alias("total"))


@query("fea6_idf", f"""WITH {ctes.BASKETS}, m AS (SELECT count(DISTINCT l_orderkey) AS m FROM baskets),
  df AS (SELECT item AS term, count(*) AS df FROM baskets GROUP BY item)
  SELECT term, df AS n, round(ln((m + 1) / (df + 1)), 6) AS idf, round(df * ln((m + 1) / (df + 1)), 2) AS total FROM df, m""")
def fea6(spark, folder):
    b = staged(views.baskets(spark, folder), "baskets")
    counts = dictionary.term_counts(b, "l_orderkey", "items")
    learned = dictionary.learn(counts, b.count())
    weight = dictionary.numbered(counts, learned).withColumn("idf", dictionary.idf(learned))
    return weight.groupBy("term").agg(row_count(), F.round(F.max("idf"), 6).alias("idf"), F.round(F.sum(F.col("n") * F.col("idf")), 2).alias("total"))


@query("fea7_count_vectorizer", f"""WITH {_TOKENS}, w AS (SELECT doc_id, unnest(t) AS term FROM tok)
  SELECT doc_id, term, CAST(count(*) AS DOUBLE) AS weight FROM w WHERE term IN ('the', 'of', 'de', 'and', 'on') GROUP BY 1, 2""")
def fea7(spark, folder):
    """Counts over a vocabulary that is given."""
    vocabulary = ["the", "of", "de", "and", "on"]
    raw = ft.Tokenizer(inputCol="text", outputCol="t").transform(_docs(spark, folder))
    model = ft.CountVectorizerModel.from_vocabulary(vocabulary, inputCol="t", outputCol="f")
    return features.term_rows(model.transform(raw), "f", vocabulary, "doc_id")


@query("fea7_learned_vocabulary", f"""WITH {ctes.BASKETS} SELECT item AS term, count(*) AS n FROM baskets GROUP BY item HAVING count(*) >= 2""")
def fea7_learned(spark, folder):
    b = staged(views.baskets(spark, folder), "baskets")
    counts = dictionary.term_counts(b, "l_orderkey", "items")
    return dictionary.numbered(counts, dictionary.learn(counts, b.count(), min_documents=2)).groupBy("term").agg(row_count())


@query("fea8_word2vec")
def fea8(spark, folder):
    raw = ft.RegexTokenizer(inputCol="text", outputCol="t", pattern=r"\W").transform(_docs(spark, folder))
    found = word_vectors.document_vectors(word_vectors.fit(raw.select("doc_id", "t"), "t", size=3, seed=1), "v", "doc_id")
    return found.select("doc_id", *[F.round(F.col("v")[i], 6).alias(f"v{i}") for i in range(3)])


@query("fea9_binarizer", "SELECT event_id, CASE WHEN value > 20 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS high FROM events")
def fea9(spark, folder):
    return ft.Binarizer(threshold=20.0, inputCol="value", outputCol="high").transform(
        table(spark, folder, "events")).select("event_id", "high")


@query("fea10_bucketizer", """SELECT event_id, CASE WHEN value < 5 THEN 0.0::DOUBLE WHEN value < 10 THEN 1.0::DOUBLE
  WHEN value < 50 THEN 2.0::DOUBLE ELSE 3.0::DOUBLE END AS bucket FROM events""")
def fea10(spark, folder):
    inf = float("inf")
    return ft.Bucketizer(splits=[-inf, 5.0, 10.0, 50.0, inf], inputCol="value", outputCol="bucket").transform(
        table(spark, folder, "events")).select("event_id", "bucket")


@query("fea11_quantile_discretizer", """WITH q AS (SELECT quantile_disc(c_acctbal, [0.25, 0.5, 0.75]) AS q FROM customer)
  SELECT c_custkey, CAST((c_acctbal >= q[1])::INT + (c_acctbal >= q[2])::INT + (c_acctbal >= q[3])::INT AS DOUBLE) AS bucket FROM customer, q""")
def fea11(spark, folder):
    c = table(spark, folder, "customer").select("c_custkey", "c_acctbal")
    return features.quantile_buckets(c, "c_acctbal", ["c_acctbal", "c_custkey"], 4, "bucket").select("c_custkey", "bucket")


_INDEX = """ix AS (SELECT p_brand, CAST(row_number() OVER (ORDER BY count(*) DESC, p_brand) - 1 AS DOUBLE) AS idx FROM part GROUP BY p_brand)"""


def _indexed(spark, folder):
    p = table(spark, folder, "part").select("p_partkey", "p_brand")
    model = ft.StringIndexer(inputCol="p_brand", outputCol="idx").fit(p)
    return model, model.transform(p)


@query("fea12_string_indexer", f"WITH {_INDEX} SELECT p_partkey, idx FROM part JOIN ix USING (p_brand)")
def fea12(spark, folder):
    return _indexed(spark, folder)[1].select("p_partkey", "idx")


@query("fea13_index_to_string", "SELECT p_partkey, p_brand AS brand FROM part")
def fea13(spark, folder):
    model, p = _indexed(spark, folder)
    return ft.IndexToString(inputCol="idx", outputCol="brand", labels=model.labels).transform(p).select("p_partkey", "brand")


@query("fea14_one_hot_encoder", f"""WITH {_INDEX} SELECT p_partkey, CASE WHEN idx < (SELECT max(idx) FROM ix) THEN CAST(idx AS BIGINT) END AS hot
  FROM part JOIN ix USING (p_brand)""")
def fea14(spark, folder):
    p = _indexed(spark, folder)[1]
    out = ft.OneHotEncoder(inputCols=["idx"], outputCols=["v"]).fit(p).transform(p)
    at = F.array_position(vector_to_array("v"), 1.0)
    return out.select("p_partkey", F.when(at > 0, at - 1).alias("hot"))


@query("fea15_vector_indexer", """SELECT p_partkey, CAST(dense_rank() OVER (ORDER BY p_size) - 1 AS DOUBLE) AS size_index,
  p_retailprice AS price FROM part""")
def fea15(spark, folder):
    p = features.assemble(table(spark, folder, "part"), ["p_size", "p_retailprice"])
    model = ft.VectorIndexer(maxCategories=60, inputCol="features", outputCol="v").fit(p)
    return spread(model.transform(p), "v", ["size_index", "price"], "p_partkey")


@query("fea16_vector_assembler", """SELECT c_custkey, CAST(c_nationkey AS DOUBLE) AS a0, c_acctbal AS a1, round(c_acctbal / 2, 6) AS a2 FROM customer""")
def fea16(spark, folder):
    c = table(spark, folder, "customer").withColumn("v", array_to_vector(F.array("c_acctbal", F.col("c_acctbal") / 2)))
    return spread(features.assemble(c, ["c_nationkey", "v"]), "features", ["a0", "a1", "a2"], "c_custkey")


@query("fea17_vector_slicer", f"WITH {PARTS} SELECT p_partkey, round(y, 6) AS s0, round(z, 6) AS s1 FROM parts")
def fea17(spark, folder):
    out = ft.VectorSlicer(inputCol="features", outputCol="s", indices=[1], names=["z"]).transform(_parts(spark, folder))
    return spread(out, "s", ["s0", "s1"], "p_partkey")


@query("fea18_elementwise_product", f"WITH {PARTS} SELECT p_partkey, 0.0::DOUBLE AS w0, round(y, 6) AS w1, round(2 * z, 6) AS w2 FROM parts")
def fea18(spark, folder):
    from pyspark.ml.linalg import Vectors

    out = ft.ElementwiseProduct(scalingVec=Vectors.dense([0.0, 1.0, 2.0]), inputCol="features", outputCol="w").transform(
        _parts(spark, folder))
    return spread(out, "w", ["w0", "w1", "w2"], "p_partkey")


@query("fea19_polynomial_expansion", f"""WITH {PARTS} SELECT p_partkey, round(x, 5) AS p0, round(x*x, 5) AS p1, round(x*x*x, 5) AS p2,
  round(y, 5) AS p3, round(x*y, 5) AS p4, round(x*x*y, 5) AS p5, round(y*y, 5) AS p6, round(x*y*y, 5) AS p7, round(y*y*y, 5) AS p8 FROM parts""")
def fea19(spark, folder):
    p = features.assemble(_parts(spark, folder).drop("features"), ["x", "y"])
    out = ft.PolynomialExpansion(degree=3, inputCol="features", outputCol="e").transform(p)
    return spread(out, "e", [f"p{i}" for i in range(9)], "p_partkey", digits=5)


@query("fea20_normalizer", f"""WITH {PARTS}, n AS (SELECT *, abs(x) + abs(y) + abs(z) AS l1, greatest(abs(x), abs(y), abs(z)) AS li FROM parts)
  SELECT p_partkey, round(x / l1, 6) AS x, round(y / l1, 6) AS y, round(z / l1, 6) AS z, round(x / li, 6) AS xi FROM n""")
def fea20(spark, folder):
    norm = ft.Normalizer(p=1.0, inputCol="features", outputCol="u")
    p = _parts(spark, folder).select("p_partkey", "features")
    one = norm.transform(p)
    both = norm.transform(one, {norm.p: float("inf"), norm.outputCol: "ui"})
    return both.select("p_partkey", *[F.round(vector_to_array("u")[i], 6).alias(c) for i, c in enumerate(XYZ)],
                       F.round(vector_to_array("ui")[0], 6).alias("xi"))


@query("fea21_standard_scaler", f"""WITH {PARTS} SELECT p_partkey, round(x / (SELECT stddev_samp(x) FROM parts), 5) AS x,
  round(y / (SELECT stddev_samp(y) FROM parts), 5) AS y, round(z / (SELECT stddev_samp(z) FROM parts), 5) AS z FROM parts""")
def fea21(spark, folder):
    p = _parts(spark, folder).select("p_partkey", "features")
    return spread(ft.StandardScaler(inputCol="features", outputCol="s").fit(p).transform(p), "s", XYZ, "p_partkey", digits=5)


@query("fea22_min_max_scaler", f"""WITH {PARTS}, b AS (SELECT min(x) AS lx, max(x) AS hx, min(y) AS ly, max(y) AS hy, min(z) AS lz, max(z) AS hz FROM parts)
  SELECT p_partkey, round((x - lx) / (hx - lx), 5) AS x, round((y - ly) / (hy - ly), 5) AS y, round((z - lz) / (hz - lz), 5) AS z FROM parts, b""")
def fea22(spark, folder):
    p = _parts(spark, folder).select("p_partkey", "features")
    return spread(ft.MinMaxScaler(inputCol="features", outputCol="s").fit(p).transform(p), "s", XYZ, "p_partkey", digits=5)


@query("fea23_dct", f"""WITH {PARTS} SELECT p_partkey, round((x + y + z) / sqrt(3), 5) AS d0,
  round(sqrt(2 / 3) * (x * cos(pi() / 6) + y * cos(pi() * 3 / 6) + z * cos(pi() * 5 / 6)), 5) AS d1,
  round(sqrt(2 / 3) * (x * cos(pi() * 2 / 6) + y * cos(pi()) + z * cos(pi() * 10 / 6)), 5) AS d2 FROM parts""")
def fea23(spark, folder):
    out = ft.DCT(inverse=False, inputCol="features", outputCol="d").transform(_parts(spark, folder))
    return spread(out, "d", ["d0", "d1", "d2"], "p_partkey", digits=5)


@query("fea24_pca")
def fea24(spark, folder):
    """Coordinates; a component's largest loading is positive."""
    projected, _ = linear.principal_components(table(spark, folder, "embeddings").select("vec_id", "embedding"), "embedding", 3)
    a = vector_to_array("projected")
    return projected.select("vec_id", *[F.round(a[i], 4).alias(f"c{i}") for i in range(3)])


@query("fea25_chi_square_selector", """WITH f AS (SELECT l_returnflag AS lab, unnest(['l_linenumber', 'l_quantity', 'l_tax']) AS name,
  unnest([CAST(l_linenumber AS DOUBLE), l_quantity, l_tax]) AS v FROM lineitem),
  o AS (SELECT name, v, lab, count(*) AS o FROM f GROUP BY 1, 2, 3), rv AS (SELECT name, v, sum(o) AS r FROM o GROUP BY 1, 2),
  cl AS (SELECT name, lab, sum(o) AS c FROM o GROUP BY 1, 2), t AS (SELECT count(*) AS t FROM lineitem),
  s AS (SELECT rv.name, sum(pow(coalesce(o.o, 0) - r * c / t, 2) / (r * c / t)) AS s FROM rv JOIN cl ON rv.name = cl.name
    CROSS JOIN t LEFT JOIN o ON o.name = rv.name AND o.v = rv.v AND o.lab = cl.lab GROUP BY rv.name)
  SELECT name, round(s, 4) AS statistic FROM s""")
def fea25(spark, folder):
    columns = ["l_linenumber", "l_quantity", "l_tax"]
    l = table(spark, folder, "lineitem").withColumn("lab", F.ascii("l_returnflag").cast("double"))
    scores = ChiSquareTest.test(features.assemble(l, columns), "features", "lab", flatten=True)
    return scores.select(F.get(F.lit(columns), F.col("featureIndex")).alias("name"), F.round("statistic", 4).alias("statistic"))


@query("fea25_select_top_features")
def fea25_select(spark, folder):
    columns = ["l_linenumber", "l_quantity", "l_tax"]
    l = table(spark, folder, "lineitem").withColumn("lab", F.ascii("l_returnflag").cast("double"))
    points = features.assemble(l, columns)
    chooser = ft.UnivariateFeatureSelector(featuresCol="features", labelCol="lab", outputCol="s", selectionMode="numTopFeatures")
    chooser.setFeatureType("categorical").setLabelType("categorical").setSelectionThreshold(1)
    chosen = chooser.fit(points)
    return spread(chosen.transform(points), "s", ["kept"], "lab").groupBy("lab", "kept").agg(row_count())


@query("fea26_r_formula", """WITH ix AS (SELECT lang, row_number() OVER (ORDER BY count(*) DESC, lang) - 1 AS i FROM documents JOIN labels USING (doc_id) GROUP BY lang)
  SELECT doc_id, CAST(toxic AS DOUBLE) AS label, CASE WHEN i < (SELECT max(i) FROM ix) THEN i ELSE -1 END AS hot, CAST(n_chars AS DOUBLE) AS chars
  FROM documents JOIN labels USING (doc_id) JOIN ix USING (lang)""")
def fea26(spark, folder):
    d = table(spark, folder, "documents").select("doc_id", "lang", "n_chars").join(table(spark, folder, "labels"), "doc_id")
    out = ft.RFormula(formula="toxic ~ lang + n_chars").fit(d).transform(d)
    a = vector_to_array("features")
    dummies = F.slice(a, F.lit(1), F.size(a) - 1)
    return out.select("doc_id", "label", (F.array_position(dummies, 1.0) - 1).alias("hot"), F.element_at(a, -1).alias("chars"))


@query("fea28_minmax_levels", """WITH b AS (SELECT min(l_quantity) AS lq, max(l_quantity) AS hq, min(l_extendedprice) AS lp, max(l_extendedprice) AS hp FROM lineitem)
  SELECT l_returnflag, CAST(trunc((l_quantity - lq) / (hq - lq + 1) * 3) AS INT) AS q, CAST(trunc((l_extendedprice - lp) / (hp - lp + 1) * 3) AS INT) AS p,
  count(*) AS n FROM lineitem, b GROUP BY ALL""")
def fea28(spark, folder):
    out = features.minmax_levels(table(spark, folder, "lineitem"), ["l_quantity", "l_extendedprice"])
    return out.groupBy("l_returnflag", F.col("l_quantity").alias("q"), F.col("l_extendedprice").alias("p")).agg(row_count())


@query("fea29_minmax_unit", f"""WITH {PARTS}, b AS (SELECT min(x) AS lx, max(x) AS hx, min(y) AS ly, max(y) AS hy FROM parts)
  SELECT p_partkey, round((x - lx) / (hx - lx), 5) AS x, round((y - ly) / (hy - ly), 5) AS y FROM parts, b""")
def fea29(spark, folder):
    out = features.minmax_unit(_parts(spark, folder).drop("features"), ["x", "y"])
    return out.select("p_partkey", F.round("x", 5).alias("x"), F.round("y", 5).alias("y"))


@query("fea30_to_libsvm", """SELECT l_linenumber || ' 1:' || CAST(l_quantity AS BIGINT) || ' 2:' || l_suppkey AS value, count(*) AS n FROM lineitem GROUP BY 1""")
def fea30(spark, folder):
    l = table(spark, folder, "lineitem").withColumn("q", F.col("l_quantity").cast("bigint"))
    return features.to_libsvm(l, "l_linenumber", ["q", "l_suppkey"]).groupBy("value").agg(row_count())


@query("fea31_append_bias", f"WITH {PARTS} SELECT p_partkey, round(x, 6) AS x, round(y, 6) AS y, round(z, 6) AS z, 1.0::DOUBLE AS bias FROM parts")
def fea31(spark, folder):
    return spread(features.append_bias(_parts(spark, folder), "features", "b"), "b", [*XYZ, "bias"], "p_partkey")


@query("fea32_reindex_labels", """SELECT p_size, dense_rank() OVER (ORDER BY p_size) - 1 AS label_index, count(*) AS n FROM part GROUP BY p_size""")
def fea32(spark, folder):
    out = features.reindex_labels(table(spark, folder, "part").select("p_size"), "p_size")
    return out.groupBy("p_size", "label_index").agg(row_count())


@query("fea33_text_corpus", f"""WITH {_GAPS} SELECT row_number() OVER (ORDER BY doc_id) - 1 AS row, doc_id,
  len(list_distinct(list_filter(t, lambda w: w NOT IN ('the','of','and','is','de','la')))) AS terms FROM tok""")
def fea33(spark, folder):
    corpus, _ = features.text_corpus(_docs(spark, folder), "doc_id", "text", None, STOP)
    return corpus.select("row", "doc_id", F.size(features.active_entries("features")).cast("bigint").alias("terms"))
