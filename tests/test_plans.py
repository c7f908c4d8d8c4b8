"""Physical plans: pushed filters, pruned columns, combined aggregates, no product of tables."""

import pytest
from pyspark.sql import functions as F

from millrace.operators import graph
from millrace.plans.durable import shared_folder, staged
from millrace.plans.sizing import broadcast_if_small, input_bytes, planned_bytes, shuffle_partitions
from millrace.registry import registered
from millrace.sources.tables import table

QUERIES = registered()


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_filters_and_columns_reach_the_scan(spark, small):
    text = plan(QUERIES["src2_read_parquet"].run(spark, small))
    assert "GreaterThanOrEqual(l_discount,0.05)" in text
    assert "ReadSchema: struct<l_quantity:double,l_discount:double,l_returnflag:string>" in text


def test_rollup_combines_before_the_shuffle(spark, small):
    text = plan(QUERIES["agg5_log_rollup"].run(spark, small))
    assert "partial_count" in text and "Python" not in text


def test_equality_written_later_is_an_equi_join(spark, small):
    text = plan(QUERIES["join6_where_equality"].run(spark, small))
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_top_k_is_one_operator(spark, small):
    assert "TakeOrderedAndProject" in plan(QUERIES["srt2_top_k_by_count"].run(spark, small))
    assert "WindowGroupLimit" in plan(QUERIES["srt6_top_k_per_group"].run(spark, small))


# Queries that only build a plan, and two that a product of tables would tempt.
LAZY = ("prj", "flt", "str", "join1_", "join2", "join3", "join4", "join6", "join8", "join10", "agg1_", "agg2", "agg4", "agg5", "agg8",
        "agg10", "agg15", "srt2", "srt6", "set", "eva2", "eva3", "sta", "gra1", "gra7", "join5", "cls12")
RELATIONAL = [n for n in QUERIES if n.startswith(LAZY)]


@pytest.mark.parametrize("name", RELATIONAL)
def test_no_product_of_tables(spark, small, name):
    text = plan(QUERIES[name].run(spark, small))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_broadcast_only_when_small(spark, small):
    orders = table(spark, small, "orders")
    assert planned_bytes(orders) > 1000
    assert "ResolvedHint" in broadcast_if_small(orders)._jdf.queryExecution().analyzed().toString()
    assert "ResolvedHint" not in broadcast_if_small(orders, limit=1000)._jdf.queryExecution().analyzed().toString()


def test_partitions_grow_with_the_input(spark, small):
    orders = table(spark, small, "orders")
    joined = orders.join(table(spark, small, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    assert 0 < input_bytes(orders) < input_bytes(joined) < 1_000_000
    assert input_bytes(spark.createDataFrame([(1,)], "x int")) == 0
    configured = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert shuffle_partitions(orders) == configured
    assert shuffle_partitions(orders, per_partition=1000) > configured


def test_links_do_not_move_between_rounds(spark, small):
    """Without broadcasts, only rank shares are exchanged; the laid-out links are read in place."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        links = staged(table(spark, small, "lineitem").select(F.col("l_partkey").alias("src"), F.col("l_suppkey").alias("dst")).distinct())
        laid = graph._Adjacency(links)
        got = laid.received(laid.sources.select(F.col("src").alias("id"), F.lit(1.0).alias("rank")))
        got.count()
        physical = got._jdf.queryExecution().executedPlan().toString()
        top = [line for line in physical.split("\n") if "Exchange hashpartitioning(src" in line and "_salt" in line and "REPARTITION_BY_NUM" not in line]
        assert all("_salt" in line for line in top)
        assert "Exchange hashpartitioning(dst" in physical
        laid.release()
    finally:
        spark.conf.set(key, old)


def test_shared_folder_follows_the_setting(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    folder = shared_folder(spark)
    assert folder == configured.rstrip("/") if configured else folder.startswith("/tmp/run-")
    assert shared_folder(spark) == folder
