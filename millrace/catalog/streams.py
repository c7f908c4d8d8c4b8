"""Streaming queries. Inputs are slices of the given tables; the SQL form is the batch query."""

from __future__ import annotations

from pyspark.sql import Window as W, functions as F

from millrace.catalog import ctes
from millrace.functions.numeric import row_count
from millrace.functions.text import words_of
from millrace.operators import models
from millrace.operators.relational import grep
from millrace.plans.sizing import broadcast_if_small
from millrace.registry import query
from millrace.sources import views
from millrace.sources.tables import table
from millrace.streaming import feed, learning, stateful

SHOWN = "yyyy-MM-dd HH:mm:ss"


def _sliced(df):
    """Thirds of the whole span of time, in order, however long it is: no slice holds rows older than the one before."""
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    span = df.agg(F.min(at).alias("low"), F.max(at).alias("high")).first()
    low, high = span["low"] or 0, span["high"] or 0
    return df.withColumn("slice", F.floor((at - F.lit(low)) * 3 / F.lit(high - low + 1)).cast("int"))


EVENTS = """ev AS (SELECT events.*, CAST(floor((epoch_us(ts) - low) * 3 / (high - low + 1)) AS INT) AS slice
    FROM events, (SELECT min(epoch_us(ts)) AS low, max(epoch_us(ts)) AS high FROM events) AS span)"""


def _events(spark, folder):
    """Events with a time Spark accepts as event time, and their slice."""
    e = _sliced(table(spark, folder, "events"))
    return e.withColumn("ts", F.col("ts").cast("timestamp"))


def _views(spark, folder):
    v = _sliced(views.page_views(spark, folder))
    return v.withColumn("ts", F.col("ts").cast("timestamp"))


def _third(key):
    """Slice of a row by its key: null and negative keys have one, too."""
    return F.coalesce(F.pmod(F.col(key), F.lit(3)), F.lit(0)).cast("int")


def _lines(spark, folder):
    return views.lines(spark, folder).withColumn("slice", _third("doc_id"))


def _stamp(*columns):
    return [F.date_format(c, SHOWN).alias(c) for c in columns]


def _hops(source: str, hours: int, cte: str = "w") -> str:
    """Windows of some hours that start every hour, as SQL."""
    return (f"{cte} AS (SELECT *, date_trunc('hour', ts) - to_hours(CAST(h AS INTEGER)) AS st FROM "
            f"(SELECT *, unnest(range(0, {hours})) AS h FROM {source}))")


_START = "strftime(st, '%Y-%m-%d %H:%M:%S') AS start"


@query("stm1_file_stream", "SELECT event_type, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY 1")
def stm1(spark, folder):
    out = feed.BatchTable(spark, "events")
    feed.Replay(spark, {"events": _events(spark, folder)}).run(lambda s: s.select("event_type", "value"), out.write)
    return out.read().groupBy("event_type").agg(row_count(), F.round(F.sum("value"), 2).alias("total"))


@query("stm2_batch_queue", f"WITH {EVENTS} SELECT slice, event_id % 10 AS key, count(*) AS n FROM ev GROUP BY 1, 2")
def stm2(spark, folder):
    work = lambda df: df.groupBy("slice", (F.col("event_id") % 10).alias("key")).agg(row_count())
    return feed.per_batch(spark, {"events": _events(spark, folder)}, work).groupBy("slice", "key").agg(F.sum("n").alias("n"))


@query("stm3_word_count_per_batch", f"WITH {ctes.WORDS} SELECT CAST(doc_id % 3 AS INT) AS slice, word, count(*) AS n FROM words GROUP BY 1, 2")
def stm3(spark, folder):
    work = lambda df: words_of(df, "line", "slice").groupBy("slice", "word").agg(row_count())
    return feed.per_batch(spark, {"lines": _lines(spark, folder)}, work).groupBy("slice", "word").agg(F.sum("n").alias("n"))


@query("stm4_event_count_messages", f"""WITH {EVENTS} SELECT s AS slice, 'Received ' || (SELECT count(*) FROM ev WHERE slice = s) || ' events.' AS message
  FROM (SELECT unnest(range(0, 4)) AS s)""")
def stm4(spark, folder):
    """The fourth slice is empty and is reported as well."""
    counts = feed.per_batch(spark, {"events": _events(spark, folder)}, lambda df: df.groupBy("slice").agg(row_count()), slices=4)
    totals = counts.groupBy("slice").agg(F.sum("n").alias("n"))
    return spark.range(4).select(F.col("id").alias("slice")).join(totals, "slice", "left").select(
        "slice", F.format_string("Received %d events.", F.coalesce("n", F.lit(0))).alias("message"))


@query("stm5_union_word_count", f"""WITH {ctes.WORDS}, s AS (SELECT doc_id % 3 AS s, word FROM words)
  SELECT pair, word, count(*) AS n FROM (SELECT unnest(CASE s WHEN 0 THEN ['ab', 'ac'] WHEN 1 THEN ['ab', 'bc'] ELSE ['ac', 'bc'] END) AS pair, word FROM s) GROUP BY 1, 2""")
def stm5(spark, folder):
    """Three sources, each arriving in three slices, united two by two."""
    lines = views.lines(spark, folder)
    later = F.coalesce(F.pmod(F.floor(F.col("doc_id") / 3), F.lit(3)), F.lit(0)).cast("int")
    inputs = {n: lines.where(_third("doc_id") == i).withColumn("slice", later) for i, n in enumerate("abc")}

    def build(a, b, c):
        pair = lambda x, y, name: x.unionByName(y).withColumn("pair", F.lit(name))
        every = pair(a, b, "ab").unionByName(pair(a, c, "ac")).unionByName(pair(b, c, "bc"))
        return words_of(every, "line", "pair").groupBy("pair", "word").agg(row_count())

    return feed.updates(spark, inputs, build, ["pair", "word"])


@query("stm6_grep_count", f"WITH {ctes.LINES} SELECT count(*) AS n FROM lines WHERE contains(line, 'the')")
def stm6(spark, folder):
    lines = _lines(spark, folder)
    half = F.coalesce(F.pmod(F.floor(F.col("doc_id") / 3), F.lit(2)), F.lit(0))
    inputs = {f"s{i}": lines.where(half == i) for i in range(2)}
    build = lambda a, b: grep(a.unionByName(b), "line", "the").groupBy(F.lit(1).alias("one")).agg(row_count())
    return feed.updates(spark, inputs, build, ["one"]).select("n")


@query("stm7_running_count", f"WITH {ctes.WORDS} SELECT word, count(*) AS n FROM words GROUP BY word")
def stm7(spark, folder):
    return feed.updates(spark, {"lines": _lines(spark, folder)}, lambda s: words_of(s).groupBy("word").agg(row_count()), ["word"])


@query("stm8_running_count_with_initial", """SELECT event_id, event_type, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id)
  + CASE WHEN event_type IN ('click', 'view') THEN 1 ELSE 0 END AS running FROM events""")
def stm8(spark, folder):
    out = stateful.running_counts(spark, _events(spark, folder), "event_type", ["ts", "event_id"], {"click": 1, "view": 1})
    return out.select("event_id", "event_type", "running")


@query("stm9_sliding_count", f"""WITH {_hops('events', 6)} SELECT {_START}, event_type, count(*) AS n FROM w GROUP BY 1, 2""")
def stm9(spark, folder):
    build = lambda s: feed.windowed(s, "ts", "6 hours", "1 hour", ["event_type"], row_count())
    return feed.updates(spark, {"events": _events(spark, folder)}, build, ["start", "event_type"]).select(*_stamp("start"), "event_type", "n")


@query("stm10_sliding_sum", f"""WITH {_hops('events', 10)} SELECT {_START}, user_id % 5 AS key, count(*) AS n, round(sum(value), 2) AS total FROM w GROUP BY 1, 2""")
def stm10(spark, folder):
    build = lambda s: feed.windowed(s.withColumn("key", F.col("user_id") % 5), "ts", "10 hours", "1 hour", ["key"],
                                    row_count(), F.round(F.sum("value"), 2).alias("total"))
    return feed.updates(spark, {"events": _events(spark, folder)}, build, ["start", "key"]).select(*_stamp("start"), "key", "n", "total")


_TREND = f"""tags AS (SELECT ts, '#' || json_extract_string(props, '$.k') AS tag FROM events), wide AS (SELECT 'long' AS span, date_trunc('day', ts) AS st, tag FROM tags
  UNION ALL SELECT 'short', date_trunc('hour', ts), tag FROM tags), c AS (SELECT span, st, tag, count(*) AS n FROM wide GROUP BY 1, 2, 3),
  r AS (SELECT *, row_number() OVER (PARTITION BY span, st ORDER BY n DESC, tag) AS rank, count(*) OVER (PARTITION BY span, st) AS tags FROM c)"""


@query("stm11_trending", f"WITH {_TREND} SELECT span, {_START}, tag, n, rank, tags FROM r WHERE rank <= 10")
def stm11(spark, folder):
    """Top ten tags of every day and of every hour, and how many tags there were."""
    tags = _events(spark, folder).select("slice", "ts", F.concat(F.lit("#"), F.get_json_object("props", "$.k")).alias("tag"))
    spans = []
    for span, length in (("long", "1 day"), ("short", "1 hour")):
        build = lambda s, length=length: feed.windowed(s, "ts", length, None, ["tag"], row_count())
        spans.append(feed.updates(spark, {"tags": tags}, build, ["start", "tag"]).withColumn("span", F.lit(span)))
    counts = spans[0].unionByName(spans[1])
    kinds = counts.groupBy("span", "start").agg(F.count(F.lit(1)).alias("tags"))
    ranked = counts.withColumn("rank", F.row_number().over(W.partitionBy("span", "start").orderBy(F.desc("n"), "tag"))).where("rank <= 10")
    return ranked.join(kinds, ["span", "start"]).select("span", *_stamp("start"), "tag", "n", F.col("rank").cast("bigint").alias("rank"), "tags")


@query("stm12_error_rate_per_zip", f"""WITH {ctes.PAGEVIEWS}, {_hops('pageviews', 12)}, c AS (SELECT st, zip, count(*) FILTER (status <> 200) / count(*) AS rate FROM w GROUP BY 1, 2)
  SELECT {_START}, zip, round(rate, 5) AS rate, rate > 0.05 AS flagged FROM c""")
def stm12(spark, folder):
    build = lambda s: feed.windowed(s, "ts", "12 hours", "1 hour", ["zip"], (F.count_if(F.col("status") != 200) / F.count(F.lit(1))).alias("rate"))
    out = feed.updates(spark, {"views": _views(spark, folder)}, build, ["start", "zip"])
    return out.select(*_stamp("start"), "zip", F.round("rate", 5).alias("rate"), (F.col("rate") > 0.05).alias("flagged"))


@query("stm13_active_users", f"WITH {_hops('events', 6)} SELECT {_START}, count(DISTINCT user_id) AS users FROM w GROUP BY 1")
def stm13(spark, folder):
    """The stream keeps one row per window and user; distinct users are then counted per window."""
    build = lambda s: feed.windowed(s, "ts", "6 hours", "1 hour", ["user_id"], row_count())
    seen = feed.updates(spark, {"events": _events(spark, folder)}, build, ["start", "user_id"])
    return seen.groupBy("start").agg(F.count(F.lit(1)).alias("users")).select(*_stamp("start"), "users")


@query("stm14_page_counts", f"""WITH {ctes.PAGEVIEWS}, w AS (SELECT url, date_trunc('day', ts) AS st FROM pageviews) SELECT {_START}, url, count(*) AS n FROM w GROUP BY 1, 2""")
def stm14(spark, folder):
    build = lambda s: feed.windowed(s, "ts", "1 day", None, ["url"], row_count())
    return feed.updates(spark, {"views": _views(spark, folder)}, build, ["start", "url"]).select(*_stamp("start"), "url", "n")


@query("stm16_sql_on_each_batch", f"WITH {ctes.WORDS} SELECT CAST(doc_id % 3 AS INT) AS slice, word, count(*) AS total FROM words GROUP BY 1, 2")
def stm16(spark, folder):
    def work(df):
        words_of(df, "line", "slice").createOrReplaceTempView("batch_words")
        return df.sparkSession.sql("SELECT slice, word, count(*) AS total FROM batch_words GROUP BY slice, word")

    return feed.per_batch(spark, {"lines": _lines(spark, folder)}, work).groupBy("slice", "word").agg(F.sum("total").alias("total"))


@query("stm17_recoverable_count", f"""WITH {ctes.WORDS} SELECT CAST(doc_id % 3 AS INT) AS slice, CASE WHEN word NOT IN ('the', 'of', 'de') THEN word END AS word, count(*) AS n
  FROM words GROUP BY ALL""")
def stm17(spark, folder):
    words = words_of(_lines(spark, folder), "line", "slice")
    return stateful.recoverable_count(spark, words, ("the", "of", "de"))


@query("stm18_approx_distinct_by_batch")
def stm18(spark, folder):
    return stateful.distinct_by_batch(spark, _events(spark, folder), "user_id")


@query("stm18_exact_distinct_by_batch", f"""WITH {EVENTS}, s AS (SELECT unnest(range(0, 3)) AS slice)
  SELECT slice, (SELECT count(DISTINCT user_id) FROM ev WHERE ev.slice = s.slice) AS batch, (SELECT count(DISTINCT user_id) FROM ev WHERE ev.slice <= s.slice) AS overall FROM s""")
def stm18_exact(spark, folder):
    seen = feed.per_batch(spark, {"events": _events(spark, folder)}, lambda df: df.select("slice", "user_id").distinct())
    first = seen.groupBy("user_id").agg(F.min("slice").alias("slice"))
    new = first.groupBy("slice").agg(F.count(F.lit(1)).alias("_new"))
    each = seen.groupBy("slice").agg(F.count_distinct("user_id").alias("batch")).join(new, "slice", "left")
    total = F.sum(F.coalesce("_new", F.lit(0))).over(W.orderBy("slice"))
    return each.select(F.col("slice").cast("bigint").alias("slice"), "batch", total.alias("overall"))


@query("stm19_heavy_hitters_by_batch")
def stm19(spark, folder):
    return stateful.heavy_by_batch(spark, _events(spark, folder), "user_id")


@query("stm19_frequent_bounds_by_batch", f"""WITH {EVENTS}, c AS (SELECT slice, user_id, count(*) AS n FROM ev GROUP BY 1, 2 UNION ALL SELECT -1, user_id, count(*) FROM ev GROUP BY 2),
  t AS (SELECT slice, sum(n) AS total FROM c GROUP BY 1) SELECT slice, user_id, n, true AS found, true AS contained FROM c JOIN t USING (slice) WHERE n >= 0.01 * total""")
def stm19_bounds(spark, folder):
    """Users with a hundredth of a batch or of the stream have counters whose bounds contain their exact counts."""
    e = _events(spark, folder)
    found = stateful.frequent_by_batch(spark, e, "user_id", share=0.01)
    exact = e.select(F.explode(F.array("slice", F.lit(-1))).alias("slice"), "user_id").groupBy("slice", "user_id").agg(row_count())
    heavy = exact.withColumn("_t", F.sum("n").over(W.partitionBy("slice"))).where(F.col("n") >= 0.01 * F.col("_t")).drop("_t")
    return heavy.join(found, ["slice", "user_id"], "left").select("slice", "user_id", "n", F.col("lower").isNotNull().alias("found"),
                                                                  F.col("n").between(F.col("lower"), F.col("upper")).alias("contained"))


@query("stm19_exact_heavy_hitters_by_batch", f"""WITH {EVENTS}, c AS (SELECT slice, user_id, count(*) AS estimate FROM ev GROUP BY 1, 2 UNION ALL SELECT -1, user_id, count(*) FROM ev GROUP BY 2)
  SELECT * FROM (SELECT slice, user_id, estimate, row_number() OVER (PARTITION BY slice ORDER BY estimate DESC, user_id) AS rank FROM c) WHERE rank <= 10""")
def stm19_exact(spark, folder):
    return stateful.exact_by_batch(spark, _events(spark, folder), "user_id")


@query("join7_stream_static", f"""WITH {EVENTS} SELECT slice, user_id, c_name AS name, count(*) AS n FROM ev JOIN customer ON user_id = c_custkey GROUP BY 1, 2, 3""")
def join7(spark, folder):
    """Users seen in each batch with their names from a table at rest."""
    users = broadcast_if_small(table(spark, folder, "customer").select(F.col("c_custkey").alias("user_id"), F.col("c_name").alias("name")))
    out = feed.BatchTable(spark, "seen")
    each = lambda df, i: out.write(df.groupBy("slice", "user_id", "name").agg(row_count()), i)
    feed.Replay(spark, {"events": _events(spark, folder)}).run(lambda s: s.join(users, "user_id"), each)
    return out.read().groupBy("slice", "user_id", "name").agg(F.sum("n").alias("n"))


def _stream_kmeans_sql() -> str:
    parts = ["u AS MATERIALIZED (SELECT vec_id, unnest(range(0, 64)) AS p, CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings)",
             "k0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id) - 1 AS c, vec_id FROM (SELECT vec_id FROM embeddings ORDER BY vec_id LIMIT 5))",
             "c0 AS MATERIALIZED (SELECT k0.c, u.p, u.v, 0 AS n FROM k0 JOIN u USING (vec_id))"]
    for i in range(1, 4):
        parts.append(f"a{i} AS MATERIALIZED (SELECT vec_id, arg_min(c, d) AS c FROM (SELECT u.vec_id, c.c, sum((u.v - c.v) * (u.v - c.v)) AS d FROM u JOIN c{i-1} c ON u.p = c.p WHERE u.vec_id % 3 = {i-1} GROUP BY 1, 2) GROUP BY 1)")
        parts.append(f"m{i} AS MATERIALIZED (SELECT a.c, u.p, sum(u.v) AS v, count(*) AS m FROM a{i} a JOIN u USING (vec_id) GROUP BY 1, 2)")
        parts.append(f"c{i} AS MATERIALIZED (SELECT o.c, o.p, CASE WHEN m.m IS NULL THEN o.v ELSE (o.v * o.n + m.v) / (o.n + m.m) END AS v, o.n + coalesce(m.m, 0) AS n FROM c{i-1} o LEFT JOIN m{i} m ON m.c = o.c AND m.p = o.p)")
    return "WITH " + ", ".join(parts) + " SELECT c AS cluster, p AS pos, round(v, 5) AS centre FROM c3"


@query("stm20_streaming_kmeans", _stream_kmeans_sql())
def stm20(spark, folder):
    e = table(spark, folder, "embeddings").withColumn("slice", _third("vec_id"))
    c = learning.streaming_kmeans(spark, e, "embedding", models.first_points(e, "embedding", "vec_id", 5))
    return spark.createDataFrame([(int(i), int(p), round(float(c[i, p]), 5)) for i in range(c.shape[0]) for p in range(c.shape[1])],
                                 "cluster bigint, pos bigint, centre double")


@query("stm20_predictions")
def stm20_predict(spark, folder):
    """A second stream is assigned to the centres learnt from the first."""
    e = table(spark, folder, "embeddings").withColumn("slice", _third("vec_id"))
    c = learning.streaming_kmeans(spark, e, "embedding", models.first_points(e, "embedding", "vec_id", 5))
    nearest = models.nearest_centre(c)
    out = feed.per_batch(spark, {"test": e}, lambda df: df.select("label", nearest(F.col("embedding").cast("array<double>"))["cluster"].alias("cluster")))
    return out.groupBy("label", "cluster").agg(row_count())


def _gradient_sql(logistic: bool) -> str:
    cols, steps = ["x0", "x2", "x3"], 50
    link = "1 / (1 + exp(-(w.a0 * c.x0 + w.a1 * c.x2 + w.a2 * c.x3)))" if logistic else "(w.a0 * c.x0 + w.a1 * c.x2 + w.a2 * c.x3)"
    y = "CASE WHEN x1 > 0.3 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END" if logistic else "x1"
    parts = [ctes.LABELLED, f"p AS MATERIALIZED (SELECT l_orderkey % 3 AS s, x0, x2, x3, {y} AS y FROM labelled)",
             "w0 AS (SELECT 0.0::DOUBLE AS a0, 0.0::DOUBLE AS a1, 0.0::DOUBLE AS a2)"]
    k = 0
    for s in range(3):
        for i in range(1, steps + 1):
            k += 1
            sums = ", ".join(f"any_value(w.a{j}) - 0.1 / sqrt({i}) * avg(c.{x} * ({link} - c.y)) AS a{j}" for j, x in enumerate(cols))
            parts.append(f"w{k} AS MATERIALIZED (SELECT {sums} FROM p c, w{k-1} w WHERE c.s = {s})")
    return "WITH " + ", ".join(parts) + f" SELECT round(a0, 6) AS w0, round(a1, 6) AS w1, round(a2, 6) AS w2 FROM w{k}"


def _gradient(spark, folder, logistic):
    l = views.labelled_lines(spark, folder)
    y = (F.col("x1") > 0.3).cast("double") if logistic else F.col("x1")
    points = l.select(_third("l_orderkey").alias("slice"), "x0", "x2", "x3", y.alias("y"))
    w = learning.streaming_gradient(spark, points, ["x0", "x2", "x3"], "y", logistic, step=0.1)
    return spark.createDataFrame([tuple(round(x, 6) for x in w)], "w0 double, w1 double, w2 double")


@query("stm21_streaming_linear_regression", _gradient_sql(False))
def stm21(spark, folder):
    """Fifty steps on each of three batches."""
    return _gradient(spark, folder, False)


@query("stm22_streaming_logistic_regression", _gradient_sql(True))
def stm22(spark, folder):
    return _gradient(spark, folder, True)


def _ab(spark, folder):
    e = _events(spark, folder).where(F.col("event_type").isin("purchase", "click")).withColumn("g", F.col("event_type") == "purchase")
    build = lambda s: s.groupBy("g").agg(row_count(), F.avg("value").alias("mean"), F.var_samp("value").alias("variance"))
    return learning.welch(feed.updates(spark, {"events": e}, build, ["g"]), "g")


@query("stm23_ab_test", """WITH g AS (SELECT event_type = 'purchase' AS g, count(*) AS n, avg(value) AS m, var_samp(value) AS v FROM events WHERE event_type IN ('purchase', 'click') GROUP BY 1)
  SELECT a.n AS n0, b.n AS n1, round((b.m - a.m) / sqrt(a.v / a.n + b.v / b.n), 5) AS t,
  round(pow(a.v / a.n + b.v / b.n, 2) / (pow(a.v / a.n, 2) / (a.n - 1) + pow(b.v / b.n, 2) / (b.n - 1)), 3) AS df FROM g a JOIN g b ON NOT a.g AND b.g""")
def stm23(spark, folder):
    return _ab(spark, folder).select("n0", "n1", F.round("t", 5).alias("t"), F.round("df", 3).alias("df"))


@query("stm23_ab_p_value")
def stm23_p(spark, folder):
    r = _ab(spark, folder).first()
    p = learning.p_value(r["t"], r["df"])
    return spark.createDataFrame([(r["t"], r["df"], p, p < 0.05)], "t double, df double, p double, significant boolean")
