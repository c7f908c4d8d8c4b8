"""Joins, aggregates, ranking, sketches and sampling."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.catalog import ctes
from millrace.functions import numeric, weblog
from millrace.functions.numeric import row_count
from millrace.operators import joins, ranking, sampling, sketches
from millrace.plans.ordering import carry_forward, row_index
from millrace.plans.skew import salted_totals
from millrace.registry import query
from millrace.sources import views
from millrace.sources.tables import table



@query("join1_inner_equi", """SELECT n_name, count(*) AS n, round(sum(c_acctbal), 2) AS total FROM customer
  JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name""")
def join1(spark, folder):
    table(spark, folder, "customer").createOrReplaceTempView("millrace_customer")
    table(spark, folder, "nation").createOrReplaceTempView("millrace_nation")
    return spark.sql("SELECT n_name, count(*) AS n, round(sum(c_acctbal), 2) AS total FROM millrace_customer "
                     "JOIN millrace_nation ON c_nationkey = n_nationkey GROUP BY n_name")


@query("join2_composite_key", f"""WITH {ctes.RATINGS}, m AS (SELECT o_custkey AS user, l_partkey AS item, max(l_quantity) AS best
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2)
  SELECT r.user, r.item, round(r.rating, 4) AS rating, m.best FROM ratings r JOIN m ON r.user = m.user AND r.item = m.item""")
def join2(spark, folder):
    o = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    l = table(spark, folder, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    best = (l.join(o, l.l_orderkey == o.o_orderkey)
            .groupBy(F.col("o_custkey").alias("user"), F.col("l_partkey").alias("item"))
            .agg(F.max("l_quantity").alias("best")))
    return views.ratings(spark, folder).join(best, ["user", "item"]).select(
        F.col("user").cast("bigint").alias("user"), F.col("item").cast("bigint").alias("item"), F.round("rating", 4).alias("rating"), "best")


@query("join3_left_default", """SELECT p_partkey, coalesce(q, 0.0) AS quantity FROM part LEFT JOIN
  (SELECT l_partkey, sum(l_quantity) AS q FROM lineitem WHERE l_discount > 0.09 GROUP BY 1) ON l_partkey = p_partkey""")
def join3(spark, folder):
    sold = (table(spark, folder, "lineitem").where(F.col("l_discount") > 0.09)
            .groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.sum("l_quantity").alias("quantity")))
    return joins.left_join_default(table(spark, folder, "part").select("p_partkey"), sold, ["p_partkey"],
                                   {"quantity": 0.0})


@query("join4_vertices_degrees", f"""WITH {ctes.PART_LINKS}, v AS (SELECT src AS id FROM links UNION SELECT dst FROM links),
  d AS (SELECT dst AS id, count(*) AS degree FROM (SELECT DISTINCT src, dst FROM links) GROUP BY 1)
  SELECT v.id, coalesce(degree, 0) AS degree FROM v LEFT JOIN d ON v.id = d.id""")
def join4(spark, folder):
    e = views.part_links(spark, folder).distinct()
    vertices = e.select(F.explode(F.array("src", "dst")).alias("id")).distinct()
    degrees = e.groupBy(F.col("dst").alias("id")).agg(F.count(F.lit(1)).alias("degree"))
    return joins.left_join_default(vertices, degrees, ["id"], {"degree": 0})


@query("join5_theta_band_pairs", """WITH p AS (SELECT event_id, value, user_id,
  row_number() OVER (ORDER BY value, event_id) - 1 AS i FROM events)
  SELECT a.i AS i0, b.i AS i1, a.event_id AS event_id0, b.event_id AS event_id1,
  round(exp(-(pow(a.value - b.value, 2) + pow(a.user_id / 50 - b.user_id / 50, 2)) / 2), 5) AS similarity
  FROM p a JOIN p b ON a.i < b.i AND b.i <= a.i + 2""")
def join5(spark, folder):
    e = table(spark, folder, "events").select("event_id", "value", (F.col("user_id") / 50).alias("u"))
    pairs = joins.band_pairs(e, ["value", "event_id"], ["event_id", "value", "u"], 2)
    s = numeric.gaussian_similarity(F.col("value0"), F.col("u0"), F.col("value1"), F.col("u1"))
    return pairs.select("i0", "i1", "event_id0", "event_id1", F.round(s, 5).alias("similarity"))


@query("join6_where_equality", """SELECT o_orderpriority, count(*) AS n FROM orders, lineitem WHERE o_orderkey = l_orderkey
  AND l_returnflag = 'R' GROUP BY 1""")
def join6(spark, folder):
    """Written as a product with an equality afterwards; the optimizer makes it an equi-join."""
    table(spark, folder, "orders").createOrReplaceTempView("millrace_orders")
    table(spark, folder, "lineitem").createOrReplaceTempView("millrace_lineitem")
    return spark.sql("SELECT o_orderpriority, count(*) AS n FROM millrace_orders, millrace_lineitem "
                     "WHERE o_orderkey = l_orderkey AND l_returnflag = 'R' GROUP BY o_orderpriority")


@query("join8_lookup", """SELECT r_name, n_name, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2""")
def join8(spark, folder):
    """Two lookups at once."""
    n = table(spark, folder, "nation").withColumnRenamed("n_nationkey", "c_nationkey")
    r = table(spark, folder, "region").withColumnRenamed("r_regionkey", "n_regionkey")
    c = table(spark, folder, "customer").groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("c"))
    return (joins.lookup(joins.lookup(c, n, ["c_nationkey"]), r, ["n_regionkey"])
            .groupBy("r_name", "n_name").agg(F.sum("c").alias("n")))


@query("join10_two_aggregates", """WITH a AS (SELECT l_suppkey, count(*) AS all_n, round(sum(l_quantity), 2) AS all_q FROM lineitem GROUP BY 1),
  r AS (SELECT l_suppkey, count(*) AS ret_n, round(sum(l_quantity), 2) AS ret_q FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1)
  SELECT a.l_suppkey, all_n, all_q, ret_n, ret_q FROM a JOIN r ON a.l_suppkey = r.l_suppkey""")
def join10(spark, folder):
    """Totals next to filtered totals on the same key: one pass, one shuffle."""
    returned = F.col("l_returnflag") == "R"
    both = table(spark, folder, "lineitem").groupBy("l_suppkey").agg(
        F.count(F.lit(1)).alias("all_n"), F.round(F.sum("l_quantity"), 2).alias("all_q"),
        F.count_if(returned).alias("ret_n"), F.round(F.sum(F.when(returned, F.col("l_quantity"))), 2).alias("ret_q"))
    return both.where(F.col("ret_n") > 0)


@query("agg1_count_rows", "SELECT count(*) AS n FROM lineitem")
def agg1(spark, folder):
    return table(spark, folder, "lineitem").agg(row_count())


@query("agg2_word_count", f"WITH {ctes.WORDS} SELECT word, count(*) AS n FROM words GROUP BY word")
def agg2(spark, folder):
    return views.words(spark, folder).groupBy("word").agg(row_count())


@query("agg3_word_count_sql", f"WITH {ctes.WORDS} SELECT word, count(*) AS total FROM words GROUP BY word")
def agg3(spark, folder):
    views.words(spark, folder).createOrReplaceTempView("millrace_words")
    return spark.sql("SELECT word, count(*) AS total FROM millrace_words GROUP BY word")


@query("agg4_sum_by_key", "SELECT l_partkey AS prod_id, CAST(sum(l_quantity) AS BIGINT) AS sale_count FROM lineitem GROUP BY 1")
def agg4(spark, folder):
    return (table(spark, folder, "lineitem").groupBy(F.col("l_partkey").alias("prod_id"))
            .agg(F.sum("l_quantity").cast("bigint").alias("sale_count")))


@query("agg5_log_rollup", f"""WITH {ctes.WEBLOG}, f AS (SELECT regexp_extract(line, '{weblog.ACCESS_LOG}',
  ['ip','identity','who','at','request','status','bytes','referer','agent']) AS f, regexp_matches(line, '{weblog.ACCESS_LOG}') AS hit FROM weblog),
  k AS (SELECT CASE WHEN hit AND f.who <> '"-"' THEN f END AS k, coalesce(TRY_CAST(f.bytes AS BIGINT), 0) AS sent FROM f)
  SELECT k.ip AS ip, k.who AS user, k.request AS request, count(*) AS n, CAST(sum(sent) AS BIGINT) AS bytes FROM k GROUP BY 1, 2, 3""")
def agg5(spark, folder):
    return log_rollup(views.weblog(spark, folder))


def log_rollup(lines):
    """Hits and bytes per (ip, user, request); unknown users and broken lines share a null key."""
    entry = lines.select(weblog.access_log(F.col("line")).alias("e"))
    hits = entry.select(*weblog.visit_key(F.col("e")), weblog.visit_bytes(F.col("e")))
    return hits.groupBy("ip", "user", "request").agg(row_count(), F.sum("bytes").alias("bytes"))


@query("agg6_group_arithmetic", f"""WITH {ctes.PAGEVIEWS} SELECT zip, count(*) AS n,
  round(count(*) FILTER (status <> 200) / count(*), 5) AS error_rate FROM pageviews GROUP BY zip""")
def agg6(spark, folder):
    return views.page_views(spark, folder).groupBy("zip").agg(
        row_count(), F.round(F.count_if(F.col("status") != 200) / F.count(F.lit(1)), 5).alias("error_rate"))


@query("agg7_count_distinct_keys", "SELECT count(DISTINCT l_partkey) AS keys FROM lineitem")
def agg7(spark, folder):
    return table(spark, folder, "lineitem").select("l_partkey").distinct().agg(F.count(F.lit(1)).alias("keys"))


@query("agg8_skewed_group_by", """SELECT CASE WHEN l_orderkey % 3 = 0 THEN 0 ELSE l_suppkey END AS k, count(*) AS n,
  CAST(sum(l_quantity) AS BIGINT) AS quantity FROM lineitem GROUP BY 1""")
def agg8(spark, folder):
    skewed = table(spark, folder, "lineitem").select(
        F.when(F.col("l_orderkey") % 3 == 0, 0).otherwise(F.col("l_suppkey")).alias("k"), "l_quantity")
    return salted_totals(skewed, ["k"], {"n": F.lit(1), "quantity": F.col("l_quantity").cast("bigint")})


@query("agg9_count_by_value", "SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def agg9(spark, folder):
    return table(spark, folder, "events").groupBy("event_type").agg(row_count())


@query("agg10_class_shares", """SELECT l_returnflag, count(*) AS n, round(count(*) / (SELECT count(*) FROM lineitem), 6) AS share
  FROM lineitem GROUP BY 1""")
def agg10(spark, folder):
    l = table(spark, folder, "lineitem")
    counts = l.groupBy("l_returnflag").agg(row_count())
    return counts.withColumn("share", F.round(F.col("n") / l.agg(F.count(F.lit(1))).scalar(), 6))


@query("agg11_distinct_counts", f"""SELECT count(DISTINCT o_custkey) AS users, count(DISTINCT o_orderpriority) AS items FROM orders""")
def agg11(spark, folder):
    return table(spark, folder, "orders").agg(F.count_distinct("o_custkey").alias("users"),
                                              F.count_distinct("o_orderpriority").alias("items"))


@query("agg12_first_last_seen", """SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS first_seen,
  strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS last_seen, min(event_id) AS low, max(event_id) AS high FROM events GROUP BY 1""")
def agg12(spark, folder):
    shown = "yyyy-MM-dd HH:mm:ss"
    return table(spark, folder, "events").groupBy("user_id").agg(
        F.date_format(F.min("ts"), shown).alias("first_seen"), F.date_format(F.max("ts"), shown).alias("last_seen"),
        F.min("event_id").alias("low"), F.max("event_id").alias("high"))


@query("agg13_scalar_folds", """SELECT round(sum(l_extendedprice), 1) AS total, round(avg(l_quantity), 5) AS mean, max(l_tax) AS top
  FROM lineitem""")
def agg13(spark, folder):
    return table(spark, folder, "lineitem").agg(
        F.round(F.sum("l_extendedprice"), 1).alias("total"), F.round(F.avg("l_quantity"), 5).alias("mean"),
        F.max("l_tax").alias("top"))


@query("agg14_any", "SELECT event_type, bool_or(value < 0.05) AS hit FROM events GROUP BY 1")
def agg14(spark, folder):
    return table(spark, folder, "events").groupBy("event_type").agg(F.bool_or(F.col("value") < 0.05).alias("hit"))


@query("agg15_vector_sum_per_key", """SELECT label, i - 1 AS pos, round(sum(CAST(embedding[i] AS DOUBLE)), 4) AS total, count(*) AS n
  FROM (SELECT label, embedding, unnest(range(1, 65)) AS i FROM embeddings) GROUP BY 1, 2""")
def agg15(spark, folder):
    e = table(spark, folder, "embeddings")
    sums = e.groupBy("label").agg(row_count(), F.array(*[F.sum(F.col("embedding")[i].cast("double")) for i in range(64)]).alias("s"))
    return sums.select("label", "n", F.posexplode("s").alias("p", "t")).select(
        "label", F.col("p").cast("bigint").alias("pos"), F.round("t", 4).alias("total"), "n")


@query("agg16_approx_distinct")
def agg16(spark, folder):
    return sketches.approx_distinct(table(spark, folder, "lineitem"), "l_partkey")


@query("agg16_exact_branch", "SELECT event_type, count(DISTINCT user_id) AS exact FROM events GROUP BY 1")
def agg16_exact(spark, folder):
    return table(spark, folder, "events").groupBy("event_type").agg(F.count_distinct("user_id").alias("exact"))


@query("agg17_count_min_sketch")
def agg17(spark, folder):
    return sketches.frequency_estimates(table(spark, folder, "lineitem"), "l_suppkey")


@query("agg17_estimate_bounds", "SELECT l_suppkey, count(*) AS n, true AS never_below, true AS within FROM lineitem GROUP BY l_suppkey")
def agg17_bounds(spark, folder):
    """Estimates against true counts: never below, and above by at most eps * N."""
    l = table(spark, folder, "lineitem")
    e = sketches.frequency_estimates(l, "l_suppkey")
    slack = sketches.CountMin().eps * l.agg(F.count(F.lit(1))).scalar()
    return e.select("l_suppkey", "n", (F.col("estimate") >= F.col("n")).alias("never_below"),
                    (F.col("estimate") <= F.col("n") + slack).alias("within"))


@query("agg18_heavy_hitters")
def agg18(spark, folder):
    return sketches.heavy_hitters(table(spark, folder, "lineitem"), "l_suppkey")


@query("agg18_frequent_bounds", """SELECT l_suppkey, count(*) AS n, true AS found, true AS contained FROM lineitem GROUP BY 1
  HAVING count(*) >= 0.001 * (SELECT count(*) FROM lineitem)""")
def agg18_bounds(spark, folder):
    """Every value that holds a thousandth of the rows has counters, and their bounds contain its exact count."""
    l = table(spark, folder, "lineitem")
    exact = l.groupBy("l_suppkey").agg(row_count())
    heavy = exact.where(F.col("n") >= 0.001 * l.agg(F.count(F.lit(1))).scalar())
    joined = heavy.join(sketches.frequent_values(l, "l_suppkey", 0.001), "l_suppkey", "left")
    return joined.select("l_suppkey", "n", F.col("lower").isNotNull().alias("found"), F.col("n").between(F.col("lower"), F.col("upper")).alias("contained"))


@query("agg19_exact_heavy_hitters", "SELECT l_suppkey, count(*) AS n FROM lineitem GROUP BY 1 ORDER BY n DESC, l_suppkey LIMIT 10")
def agg19(spark, folder):
    return sketches.exact_heavy_hitters(table(spark, folder, "lineitem"), "l_suppkey")


@query("srt1_order_by", "SELECT c_custkey, c_acctbal FROM customer ORDER BY c_acctbal, c_custkey")
def srt1(spark, folder):
    return table(spark, folder, "customer").select("c_custkey", "c_acctbal").orderBy("c_acctbal", "c_custkey")


@query("srt2_top_k_by_count", f"""WITH {ctes.WORDS} SELECT word, count(*) AS n FROM words GROUP BY word ORDER BY n DESC, word LIMIT 10""")
def srt2(spark, folder):
    return ranking.top_k_by_count(views.words(spark, folder), "word", 10)


@query("srt3_take_n", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 100")
def srt3(spark, folder):
    return ranking.head(table(spark, folder, "orders").select("o_orderkey", "o_totalprice"),
                        ["o_totalprice", "o_orderkey"], 100)


@query("srt4_zip_with_index", "SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS idx FROM orders")
def srt4(spark, folder):
    o = table(spark, folder, "orders").select("o_orderkey", "o_orderdate")
    return row_index(o, ["o_orderdate", "o_orderkey"]).select("o_orderkey", "idx")


@query("srt5_arg_max", """SELECT user_id AS threshold, score FROM (SELECT user_id, count(*) FILTER (event_type = 'error') AS score
  FROM events GROUP BY 1) ORDER BY score DESC, threshold LIMIT 1""")
def srt5(spark, folder):
    f = table(spark, folder, "events").groupBy(F.col("user_id").alias("threshold")).agg(
        F.count_if(F.col("event_type") == "error").alias("score"))
    return ranking.best_row(f, "threshold", "score")


@query("srt6_top_k_per_group", f"""WITH {ctes.RATINGS} SELECT user, item, round(rating, 4) AS rating, rank FROM
  (SELECT *, row_number() OVER (PARTITION BY user ORDER BY rating DESC, item) AS rank FROM ratings) WHERE rank <= 10""")
def srt6(spark, folder):
    top = ranking.top_k_per_group(views.ratings(spark, folder), "user", "rating", "item", 10)
    return top.select(F.col("user").cast("bigint").alias("user"), F.col("item").cast("bigint").alias("item"),
                      F.round("rating", 4).alias("rating"), F.col("rank").cast("bigint").alias("rank"))


@query("srt7_carry_forward", """SELECT event_id, last_value(CASE WHEN event_type = 'signup' THEN event_id END IGNORE NULLS)
  OVER (PARTITION BY user_id % 3 ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS last_signup FROM events""")
def srt7(spark, folder):
    e = table(spark, folder, "events").select(
        "event_id", "ts", (F.col("user_id") % 3).alias("g"),
        F.when(F.col("event_type") == "signup", F.col("event_id")).alias("last_signup"))
    return carry_forward(e, ["ts", "event_id"], ["last_signup"], keys=["g"]).select("event_id", "last_signup")


@query("smp1_random_split")
def smp1(spark, folder):
    parts = sampling.random_split(table(spark, folder, "orders"), [0.6, 0.4], 11)
    return parts[0].select(F.lit("train").alias("part")).unionByName(parts[1].select(F.lit("test").alias("part"))) \
        .groupBy("part").agg(row_count())


@query("smp2_sample")
def smp2(spark, folder):
    o = table(spark, folder, "orders")
    return (o.sample(False, 0.1, 7).select(F.lit("bernoulli").alias("kind"), "o_orderkey")
            .unionByName(o.sample(True, 0.1, 7).select(F.lit("poisson").alias("kind"), "o_orderkey")))


@query("smp3_take_sample")
def smp3(spark, folder):
    o = table(spark, folder, "orders").select("o_orderkey")
    one = sampling.take_sample(o, 100, 5)
    two = sampling.take_sample(o, 100, 5, with_replacement=True, order=["o_orderkey"])
    return one.select(F.lit("without").alias("kind"), "o_orderkey").unionByName(
        two.select(F.lit("with").alias("kind"), "o_orderkey"))


@query("smp4_sample_by_key")
def smp4(spark, folder):
    kept = sampling.sample_by_key(table(spark, folder, "lineitem").select("l_returnflag"), "l_returnflag",
                                  {"A": 0.1, "N": 0.2, "R": 0.3}, 3)
    return kept.groupBy("l_returnflag").agg(row_count())


@query("smp5_sample_by_key_exact", """WITH c AS (SELECT event_type, count(*) AS n FROM events GROUP BY 1)
  SELECT event_type, CAST(ceil(n * 0.1) AS BIGINT) AS n, round(ceil(n * 0.1) / (SELECT sum(ceil(n * 0.1)) FROM c), 6) AS share,
  round(n / (SELECT sum(n) FROM c), 6) AS original FROM c""")
def smp5(spark, folder):
    e = table(spark, folder, "events").select("event_id", "event_type")
    kept = sampling.sample_by_key_exact(e, "event_type", 0.1, ["event_id"]).groupBy("event_type").agg(row_count())
    whole = e.groupBy("event_type").agg(F.count(F.lit(1)).alias("m"))
    shares = kept.select("event_type", "n", F.round(F.col("n") / kept.agg(F.sum("n")).scalar(), 6).alias("share"))
    total = e.agg(F.count(F.lit(1))).scalar()
    return shares.join(whole, "event_type").select("event_type", "n", "share", F.round(F.col("m") / total, 6).alias("original"))


@query("smp5_by_key_with_replacement", """WITH f AS (SELECT event_type, count(*) AS m, CASE event_type WHEN 'click' THEN 0.5 WHEN 'view' THEN 0.25 WHEN 'error' THEN 2 ELSE 0 END AS f
  FROM events GROUP BY 1) SELECT event_type, CAST(ceil(m * f) AS BIGINT) AS n, true AS within FROM f WHERE f > 0""")
def smp5_replaced(spark, folder):
    """Draws with replacement, a fraction per type; more draws than rows repeat some, and all are rows of the table."""
    e = table(spark, folder, "events").select("event_id", "event_type")
    kept = sampling.sample_by_key_exact(e, "event_type", {"click": 0.5, "view": 0.25, "error": 2.0}, ["event_id"], with_replacement=True)
    sizes = e.groupBy("event_type").agg(F.count(F.lit(1)).alias("_m"))
    drawn = kept.groupBy("event_type").agg(row_count(), F.count_distinct("event_id").alias("_d"))
    return drawn.join(sizes, "event_type").select("event_type", "n", ((F.col("_d") <= F.col("_m")) & (F.col("_d") < F.col("n"))).alias("within"))


@query("smp6_positional_split", """WITH p AS (SELECT vec_id, label, row_number() OVER (ORDER BY vec_id) - 1 AS i,
  floor(0.7 * (SELECT count(*) FROM embeddings)) AS cut FROM embeddings)
  SELECT CASE WHEN i < cut THEN 'train' ELSE 'test' END AS part, label, count(*) AS n FROM p GROUP BY 1, 2""")
def smp6(spark, folder):
    e = table(spark, folder, "embeddings").select("vec_id", "label")
    train, test = sampling.positional_split(e, ["vec_id"], 0.7)
    return train.select(F.lit("train").alias("part"), "label").unionByName(
        test.select(F.lit("test").alias("part"), "label")).groupBy("part", "label").agg(row_count())


@query("gen1_normal_table")
def gen1(spark, folder):
    """Normal draws for each order, and their moments per status."""
    drawn = sampling.normal_columns(table(spark, folder, "orders").select("o_orderstatus"), ["x", "y"], 17)
    return drawn.groupBy("o_orderstatus").agg(row_count(), F.avg("x").alias("mean_x"), F.stddev("x").alias("std_x"),
                                              F.corr("x", "y").alias("corr_xy"))


@query("gen2_lognormal_graph")
def gen2(spark, folder):
    """A log-normal graph over the customers; vertices per out-degree."""
    c = table(spark, folder, "customer")
    edges = sampling.lognormal_edges(c, "c_custkey", c.agg(F.count(F.lit(1))).scalar(), mu=4.0, sigma=1.3, seed=9)
    return (edges.groupBy("src").agg(F.count(F.lit(1)).alias("degree"))
            .groupBy("degree").agg(row_count()))
