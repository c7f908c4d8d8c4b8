"""Views over the given tables that stand in for the inputs of the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.functions.text import lines_of, words_of
from millrace.plans.sizing import balanced
from millrace.sources.tables import table


def lines(spark: SparkSession, folder: str) -> DataFrame:
    return lines_of(balanced(table(spark, folder, "documents").select("doc_id", "text")), "text", "doc_id")


def words(spark: SparkSession, folder: str) -> DataFrame:
    return words_of(lines(spark, folder), "line", "doc_id")


def weblog(spark: SparkSession, folder: str) -> DataFrame:
    """Events written as access-log lines, some without bytes and some broken."""
    e = balanced(table(spark, folder, "events").select("event_id", "ts", "user_id", "event_type", "value"))
    user = F.when(F.col("user_id") % 10 == 0, F.lit('"-"')).otherwise(
        F.concat(F.lit('"u'), F.col("user_id").cast("string"), F.lit('"')))
    status = F.when(F.col("event_type") == "error", "404").otherwise("200")
    sent = F.when(F.col("event_id") % 50 == 7, F.lit("-")).otherwise(
        F.floor("value").cast("string"))
    line = F.concat(
        F.lit("10.0.0."), (F.col("user_id") % 256).cast("string"), F.lit(" - "), user, F.lit(" ["),
        F.date_format("ts", "dd/MMM/yyyy:HH:mm:ss"), F.lit(' +0000] "GET /'), F.col("event_type"),
        F.lit(' HTTP/1.1" '), status, F.lit(" "), sent, F.lit(' "http://ref.example/" "agent/1.0" x'))
    return e.select("event_id", F.when(F.col("event_id") % 50 == 11, F.lit("broken line")).otherwise(line)
                    .alias("line"))


def page_views(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select(
        F.col("event_id"), F.col("ts"),
        F.concat(F.lit("http://foo.com/"), F.col("event_type")).alias("url"),
        F.when(F.col("event_type") == "error", 404).otherwise(200).alias("status"),
        (F.lit(94000) + F.col("user_id") % 7).alias("zip"), F.col("user_id"))


def part_links(spark: SparkSession, folder: str) -> DataFrame:
    """Links (with repeats) from each part number to the supplier numbers that ship it."""
    return table(spark, folder, "lineitem").select(F.col("l_partkey").alias("src"), F.col("l_suppkey").alias("dst"))


def hierarchy(spark: SparkSession, folder: str) -> DataFrame:
    """order -> customer -> nation -> region and supplier -> nation; id = key * 8 + kind."""

    def node(column: str, kind: int):
        return F.col(column).cast("bigint") * 8 + kind

    o = table(spark, folder, "orders").select(node("o_orderkey", 4).alias("src"), node("o_custkey", 2).alias("dst"))
    c = table(spark, folder, "customer").select(node("c_custkey", 2).alias("src"), node("c_nationkey", 1).alias("dst"))
    s = table(spark, folder, "supplier").select(node("s_suppkey", 3).alias("src"), node("s_nationkey", 1).alias("dst"))
    n = table(spark, folder, "nation").select(node("n_nationkey", 1).alias("src"), node("n_regionkey", 0).alias("dst"))
    return o.unionByName(c).unionByName(s).unionByName(n)


def ratings(spark: SparkSession, folder: str) -> DataFrame:
    """Mean quantity / 10 a customer ordered of a part."""
    o = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    l = table(spark, folder, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    return (l.join(o, l.l_orderkey == o.o_orderkey)
            .groupBy(F.col("o_custkey").alias("user"), F.col("l_partkey").alias("item"))
            .agg((F.avg("l_quantity") / 10).alias("rating")))


def baskets(spark: SparkSession, folder: str) -> DataFrame:
    """Set of brands in each order (never more than the number of brands)."""
    l = table(spark, folder, "lineitem").select("l_orderkey", "l_partkey")
    p = table(spark, folder, "part").select("p_partkey", "p_brand")
    return (l.join(p, l.l_partkey == p.p_partkey).groupBy("l_orderkey")
            .agg(F.collect_set("p_brand").alias("items")))


def priority_years(spark: SparkSession, folder: str) -> DataFrame:
    """Per customer: years in order, each with its set of order priorities (small by domain)."""
    o = table(spark, folder, "orders").select(
        "o_custkey", F.year("o_orderdate").alias("yr"), "o_orderpriority")
    years = o.groupBy("o_custkey", "yr").agg(F.sort_array(F.collect_set("o_orderpriority")).alias("items"))
    return years.groupBy("o_custkey").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("yr", "items"))), lambda s: s["items"]).alias("sequence"))


def labelled_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Four scaled measures of a line item and its return flag as class (A 0, N 1, R 2)."""
    return table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        (F.col("l_quantity") / 50).alias("x0"), (F.col("l_extendedprice") / 100000).alias("x1"),
        (F.col("l_discount") * 10).alias("x2"), (F.col("l_tax") * 10).alias("x3"),
        F.when(F.col("l_returnflag") == "A", 0.0).when(F.col("l_returnflag") == "N", 1.0).otherwise(2.0)
        .alias("label"))


def cells(spark: SparkSession, folder: str) -> DataFrame:
    """Customers as (row, family, qualifier, value) cells."""
    c = table(spark, folder, "customer").select(
        F.concat(F.lit("row"), F.col("c_custkey").cast("string")).alias("row"),
        F.col("c_name").alias("name"), F.col("c_nationkey").cast("string").alias("nation"),
        F.col("c_mktsegment").alias("segment"))
    return c.unpivot("row", ["name", "nation", "segment"], "qualifier", "value").select(
        "row", F.lit("f").alias("columnFamily"), "qualifier", "value")
