"""Projections, filters, strings, arrays, dates, set operations and partitioning."""

from __future__ import annotations

from pyspark.ml.feature import SQLTransformer
from pyspark.sql import functions as F

from millrace.catalog import ctes
from millrace.functions import numeric, text, weblog
from millrace.operators import relational as rel
from millrace.plans.sizing import balanced
from millrace.registry import query
from millrace.sources import views
from millrace.sources.tables import table


@query("prj1_select_alias", """SELECT c_custkey, c_name AS customer, c_acctbal AS balance FROM customer""")
def prj1(spark, folder):
    return table(spark, folder, "customer").select("c_custkey", F.col("c_name").alias("customer"),
                                                   F.col("c_acctbal").alias("balance"))


@query("prj1_select_star", "SELECT * FROM nation")
def prj1_star(spark, folder):
    table(spark, folder, "nation").createOrReplaceTempView("millrace_nation")
    return spark.sql("SELECT * FROM millrace_nation")


@query("prj2_format_rows", """SELECT 'Key: ' || s_suppkey || ', Value: ' || s_name AS line FROM supplier""")
def prj2(spark, folder):
    return rel.format_rows(table(spark, folder, "supplier"), "s_suppkey", "s_name").select("line")


@query("prj3_computed_columns", """SELECT event_id, round(v1 + v2, 4) AS v3, round(v1 * v2, 4) AS v4
  FROM (SELECT event_id, value AS v1, user_id AS v2 FROM events)""")
def prj3(spark, folder):
    e = table(spark, folder, "events").select("event_id", F.col("value").alias("v1"), F.col("user_id").alias("v2"))
    return SQLTransformer(statement="SELECT event_id, round(v1 + v2, 4) AS v3, round(v1 * v2, 4) AS v4 "
                                    "FROM __THIS__").transform(e)


@query("prj4_line_length", f"""WITH {ctes.LINES} SELECT length(line) AS chars, count(*) AS n FROM lines GROUP BY 1""")
def prj4(spark, folder):
    return (rel.with_length(views.lines(spark, folder), "line", "chars")
            .groupBy("chars").agg(F.count(F.lit(1)).alias("n")))


@query("prj5_modulo_key", "SELECT event_id % 10 AS key, count(*) AS n FROM events GROUP BY 1")
def prj5(spark, folder):
    return (table(spark, folder, "events").select((F.col("event_id") % 10).alias("key"))
            .groupBy("key").agg(F.count(F.lit(1)).alias("n")))


@query("flt1_comparison", """SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity < 3
  AND l_returnflag = 'R'""")
def flt1(spark, folder):
    return (table(spark, folder, "lineitem").where((F.col("l_quantity") < 3) & (F.col("l_returnflag") == "R"))
            .select("l_orderkey", "l_linenumber", "l_quantity"))


@query("flt2_filter_over_join", """SELECT o_orderkey, c_name, o_totalprice FROM orders JOIN customer ON o_custkey = c_custkey
  WHERE c_acctbal <= 0 AND o_totalprice >= 300000""")
def flt2(spark, folder):
    o = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    c = table(spark, folder, "customer").select("c_custkey", "c_name", "c_acctbal")
    return (o.join(c, o.o_custkey == c.c_custkey)
            .where((F.col("c_acctbal") <= 0) & (F.col("o_totalprice") >= 300000))
            .select("o_orderkey", "c_name", "o_totalprice"))


@query("flt3_grep_count", f"WITH {ctes.LINES} SELECT count(*) AS n FROM lines WHERE contains(line, 'the')")
def flt3(spark, folder):
    return rel.grep(views.lines(spark, folder), "line", "the").agg(F.count(F.lit(1)).alias("n"))


@query("flt4_starts_with", f"""WITH {ctes.WORDS} SELECT word, count(*) AS n FROM words
  WHERE starts_with(word, 'A') GROUP BY word""")
def flt4(spark, folder):
    w = views.words(spark, folder)
    return w.where(F.startswith("word", F.lit("A"))).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


BLOCKED = ("the", "of", "de", "and")


@query("flt5_drop_blocked_words", f"""WITH {ctes.WORDS} SELECT word, count(*) AS n, false AS dropped FROM words
  WHERE word NOT IN ('the', 'of', 'de', 'and') GROUP BY word
  UNION ALL SELECT '(dropped)', count(*), true FROM words WHERE word IN ('the', 'of', 'de', 'and')""")
def flt5(spark, folder):
    counts = views.words(spark, folder).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return rel.drop_blocked(counts, "word", "n", BLOCKED)


@query("flt6_drop_nan_errors", """SELECT count(*) AS n, round(avg((value - p) * (value - p)), 4) AS mse FROM
  (SELECT value, CASE WHEN event_type = 'error' THEN NULL ELSE value * 0.9 END AS p FROM events) WHERE p IS NOT NULL""")
def flt6(spark, folder):
    e = table(spark, folder, "events").select("value", F.when(F.col("event_type") == "error", F.lit(float("nan")))
                                              .otherwise(F.col("value") * 0.9).alias("p"))
    return rel.squared_errors(e, "value", "p").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("error"), 4).alias("mse"))


@query("str1_split_words", f"WITH {ctes.WORDS} SELECT doc_id, count(*) AS n, count(DISTINCT word) AS kinds FROM words GROUP BY 1")
def str1(spark, folder):
    return views.words(spark, folder).groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("word").alias("kinds"))


@query("str2_split_blanks_tabs", f"""WITH {ctes.LINES}, t AS (SELECT unnest(string_split_regex(line, '[ \t]')) AS word FROM lines)
  SELECT word, count(*) AS n FROM t WHERE length(word) > 0 GROUP BY word""")
def str2(spark, folder):
    return text.blank_separated(views.lines(spark, folder)).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


@query("str3_split_whitespace", r"""WITH t AS (SELECT doc_id, unnest(string_split_regex(regexp_replace(text, '\s+$', ''), '\s+')) AS word FROM documents)
  SELECT doc_id, count(*) AS n FROM t GROUP BY doc_id""")
def str3(spark, folder):
    d = balanced(table(spark, folder, "documents").select("doc_id", "text"))
    return text.whitespace_tokens(d, "text", "doc_id").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))


# The pattern is the fixed access-log layout; matching lines are the unbroken ones.
_PARSED = f"""{ctes.WEBLOG}, parsed AS (SELECT event_id, regexp_extract_all(line, '{weblog.ACCESS_LOG}') AS hit,
  regexp_extract(line, '{weblog.ACCESS_LOG}', ['ip','identity','who','at','request','status','bytes','referer','agent']) AS f
  FROM weblog), keyed AS (SELECT event_id, len(hit) > 0 AS matched, f,
  len(hit) > 0 AND f.who <> '"-"' AS known, coalesce(TRY_CAST(f.bytes AS BIGINT), 0) AS sent FROM parsed)"""


@query("str4_parse_access_log", f"""WITH {_PARSED} SELECT event_id, CASE WHEN known THEN f.ip END AS ip,
  CASE WHEN known THEN f.who END AS user, CASE WHEN known THEN f.request END AS request, sent AS bytes FROM keyed""")
def str4(spark, folder):
    entry = views.weblog(spark, folder).select("event_id", weblog.access_log(F.col("line")).alias("e"))
    return entry.select("event_id", *weblog.visit_key(F.col("e")), weblog.visit_bytes(F.col("e")))


@query("str6_file_extension", r"""SELECT CASE WHEN contains(url, '.') THEN string_split(url, '.')[-1] ELSE 'undef' END AS ext, count(*) AS n
  FROM pages GROUP BY 1""")
def str6(spark, folder):
    return (table(spark, folder, "pages").select(text.file_extension(F.col("url")).alias("ext"))
            .groupBy("ext").agg(F.count(F.lit(1)).alias("n")))


@query("str7_filename_timestamp", """SELECT event_id, CASE WHEN event_id % 4 = 0 THEN NULL
  ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS file_ts FROM events""")
def str7(spark, folder):
    e = table(spark, folder, "events")
    stamp = F.when(F.col("event_id") % 8 == 0, F.lit("nodate")).when(
        F.col("event_id") % 8 == 4, F.date_format("ts", "yyyyMMdd")).otherwise(F.date_format("ts", "yyyyMMdd.HHmmss"))
    name = F.concat(F.lit("a_b-c:d_"), F.col("event_id").cast("string"), F.lit("_"), stamp, F.lit(".dat"))
    return e.select("event_id", F.date_format(text.filename_timestamp(name), "yyyy-MM-dd HH:mm:ss").alias("file_ts"))


@query("str8_parse_page_view", f"WITH {ctes.PAGEVIEWS} SELECT event_id, url, status, zip, user_id FROM pageviews")
def str8(spark, folder):
    v = views.page_views(spark, folder)
    line = F.concat_ws("\t", "url", F.col("status").cast("string"), F.col("zip").cast("string"),
                       F.col("user_id").cast("string"))
    return v.select("event_id", line.alias("line")).select("event_id", text.page_view(F.col("line")).alias("v")).select(
        "event_id", "v.*")


@query("str9_key_cells_json", f"""WITH {ctes.CELLS} SELECT row, string_agg('{{"row":"' || row || '","columnFamily":"f","qualifier":"'
  || qualifier || '","value":"' || value || '"}}', chr(10) ORDER BY qualifier) AS cells FROM cells GROUP BY row""")
def str9(spark, folder):
    return rel.cells_to_json(views.cells(spark, folder), "row")


@query("arr1_flat_map", f"""WITH t AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
  generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos FROM documents) SELECT doc_id, pos, length(line) AS chars FROM t""")
def arr1(spark, folder):
    d = table(spark, folder, "documents")
    flat = rel.flat_map(d, F.split("text", "\n", -1), "line", "doc_id")
    return flat.select("doc_id", F.col("pos").cast("bigint").alias("pos"), F.length("line").cast("bigint").alias("chars"))


@query("arr2_split_list_column", """WITH t AS (SELECT unnest(string_split(p_brand || '|' || p_type, '|')) AS genre FROM part)
  SELECT genre, count(*) AS n FROM t GROUP BY genre""")
def arr2(spark, folder):
    p = table(spark, folder, "part").select(F.concat_ws("|", "p_brand", "p_type").alias("genres"))
    return (p.select(F.explode(F.split("genres", r"\|")).alias("genre"))
            .groupBy("genre").agg(F.count(F.lit(1)).alias("n")))


@query("mth1_gaussian_similarity", """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  round(exp(-(pow(l_quantity / 50 - l_discount * 10, 2) + pow(l_tax * 10 - 0.5, 2)) / 2), 5) AS similarity FROM lineitem""")
def mth1(spark, folder):
    l = table(spark, folder, "lineitem")
    s = numeric.gaussian_similarity(F.col("l_quantity") / 50, F.col("l_tax") * 10, F.col("l_discount") * 10, F.lit(0.5))
    return l.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.round(s, 5).alias("similarity"))


@query("mth2_rating_scaling", """SELECT event_id, greatest(0.0::DOUBLE, least(1.0::DOUBLE, value / 50)) AS clamped,
  CASE WHEN value - 50 > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS positive, round(value - 2.5, 4) AS shifted FROM events""")
def mth2(spark, folder):
    v = F.col("value")
    return table(spark, folder, "events").select(
        "event_id", numeric.clamp(v / 50).alias("clamped"), numeric.binarise(v - 50).alias("positive"),
        F.round(v - 2.5, 4).alias("shifted"))


@query("dat1_seconds_between", """SELECT o_orderkey, l_linenumber, l_suppkey, l_partkey,
  CAST(date_diff('second', o_orderdate, l_shipdate) AS BIGINT) AS age FROM orders JOIN lineitem ON o_orderkey = l_orderkey""")
def dat1(spark, folder):
    o = table(spark, folder, "orders").select("o_orderkey", "o_orderdate")
    l = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", "l_shipdate")
    return l.join(o, l.l_orderkey == o.o_orderkey).select(
        "o_orderkey", "l_linenumber", "l_suppkey", "l_partkey",
        numeric.seconds_between(F.col("o_orderdate"), F.col("l_shipdate")).alias("age"))


@query("dat2_normal_timestamps", """SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS loop_ts,
  strftime(ts, '%Y-%m-%d %H:%M') || ':00' AS file_ts FROM events""")
def dat2(spark, folder):
    return table(spark, folder, "events").select(
        "event_id", numeric.normal_loop_time(F.date_format("ts", "yyyy-MM-dd:HH:mm:ss")).alias("loop_ts"),
        numeric.with_seconds(F.date_format("ts", "yyyy-MM-dd"), F.date_format("ts", "HH:mm")).alias("file_ts"))


@query("set1_union", """SELECT k, count(*) AS n FROM (SELECT c_nationkey AS k FROM customer UNION ALL SELECT s_nationkey FROM supplier)
  GROUP BY k""")
def set1(spark, folder):
    c = table(spark, folder, "customer").select(F.col("c_nationkey").alias("k"))
    s = table(spark, folder, "supplier").select(F.col("s_nationkey").alias("k"))
    return rel.union_all(c, s).groupBy("k").agg(F.count(F.lit(1)).alias("n"))


@query("set2_union_many", """SELECT k, count(*) AS n FROM (SELECT o_custkey AS k FROM orders UNION ALL SELECT c_custkey FROM customer
  UNION ALL SELECT user_id FROM events UNION ALL SELECT l_suppkey FROM lineitem) GROUP BY k""")
def set2(spark, folder):
    named = {"orders": "o_custkey", "customer": "c_custkey", "events": "user_id", "lineitem": "l_suppkey"}
    parts = [table(spark, folder, t).select(F.col(c).alias("k")) for t, c in named.items()]
    return rel.union_all(*parts).groupBy("k").agg(F.count(F.lit(1)).alias("n"))


@query("set3_set_union", """SELECT o_custkey AS k FROM orders UNION SELECT user_id FROM events""")
def set3(spark, folder):
    return rel.set_union(table(spark, folder, "orders").select(F.col("o_custkey").alias("k")),
                         table(spark, folder, "events").select(F.col("user_id").alias("k")))


@query("set4_distinct", "SELECT DISTINCT l_partkey AS src, l_suppkey AS dst FROM lineitem")
def set4(spark, folder):
    return views.part_links(spark, folder).distinct()


@query("prt1_partition_by_rule", """SELECT CASE WHEN user_id % 10 = 0 THEN 0 ELSE 1 END AS part, count(*) AS n FROM events GROUP BY 1""")
def prt1(spark, folder):
    key = F.when(F.col("user_id") % 10 != 0, F.col("user_id"))
    placed = rel.partition_by_rule(table(spark, folder, "events").withColumn("key", key),
                                   F.when(F.col("key").isNull(), 0).otherwise(1), 4)
    return placed.groupBy(F.spark_partition_id().alias("part")).agg(F.count(F.lit(1)).alias("n"))


@query("prt2_group_with_n_partitions", "SELECT l_suppkey, count(*) AS n FROM lineitem GROUP BY l_suppkey")
def prt2(spark, folder):
    return rel.group_with_partitions(table(spark, folder, "lineitem"), "l_suppkey", 6)


@query("udf1_scalar_closure", """SELECT c_custkey, upper(substr(c_mktsegment, 1, 3)) || ':' || length(c_name) AS tag FROM customer""")
def udf1(spark, folder):
    """A per-row function, written as a column expression."""
    return table(spark, folder, "customer").select("c_custkey", F.concat(
        F.upper(F.substring("c_mktsegment", 1, 3)), F.lit(":"), F.length("c_name").cast("string")).alias("tag"))


@query("udf2_row_to_many", """SELECT l_suppkey, d.name, round(sum(d.x), 3) AS total FROM (SELECT l_suppkey,
  unnest([{'name': 'quantity', 'x': l_quantity}, {'name': 'tax', 'x': l_tax}]) AS d FROM lineitem) GROUP BY 1, 2""")
def udf2(spark, folder):
    many = F.array(*[F.struct(F.lit(n).alias("name"), F.col(c).alias("x"))
                     for n, c in (("quantity", "l_quantity"), ("tax", "l_tax"))])
    return (table(spark, folder, "lineitem").select("l_suppkey", F.explode(many).alias("d"))
            .groupBy("l_suppkey", F.col("d.name").alias("name")).agg(F.round(F.sum("d.x"), 3).alias("total")))


@query("udf3_mergeable_aggregate", """SELECT event_type, count(*) AS n, round(sum(value), 2) AS total, min(value) AS low,
  max(value) AS high FROM events GROUP BY event_type""")
def udf3(spark, folder):
    return rel.merged_stats(table(spark, folder, "events"), "event_type", "value")
