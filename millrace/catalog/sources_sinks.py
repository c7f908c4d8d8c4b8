"""Scans, sources and sinks over data that Spark writes from the given tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from millrace.catalog import ctes
from millrace.functions.vectors import libsvm_line, spread
from millrace.operators import dirlog
from millrace.plans.durable import fresh_path
from millrace.registry import query
from millrace.sources import readers, sinks, views
from millrace.sources.tables import SCHEMAS, table


@query("src1_read_lines", f"WITH {ctes.LINES} SELECT line, count(*) AS n FROM lines GROUP BY line")
def src1(spark, folder):
    path = fresh_path(spark, "lines")
    views.lines(spark, folder).select("line").write.text(path)
    return readers.read_lines(spark, path).groupBy("line").agg(F.count(F.lit(1)).alias("n"))


@query("src2_read_parquet", """SELECT l_returnflag, count(*) AS n, round(sum(l_quantity), 2) AS quantity
  FROM lineitem WHERE l_discount >= 0.05 GROUP BY l_returnflag""")
def src2(spark, folder):
    lines = readers.read_parquet(spark, f"{folder}/lineitem.parquet", SCHEMAS["lineitem"])
    return (lines.where(F.col("l_discount") >= 0.05).groupBy("l_returnflag")
            .agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("l_quantity"), 2).alias("quantity")))


@query("src3_read_libsvm", f"""WITH {ctes.LABELLED} SELECT label, count(*) AS n, round(sum(x0), 3) AS s0,
  round(sum(x2), 3) AS s2 FROM labelled GROUP BY label""")
def src3(spark, folder):
    path = fresh_path(spark, "libsvm")
    rows = views.labelled_lines(spark, folder).select("label", F.array("x0", "x1", "x2", "x3").alias("f"))
    rows.select(libsvm_line(F.col("label"), F.col("f"))).write.text(path)
    points = spread(readers.read_libsvm(spark, path, 4), "features", ["x0", "x1", "x2", "x3"], "label", digits=10)
    return points.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("x0"), 3).alias("s0"),
                                       F.round(F.sum("x2"), 3).alias("s2"))


@query("src4_read_delimited", """SELECT o_custkey AS user, count(*) AS n, min(o_orderkey) AS first_item,
  round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1""")
def src4(spark, folder):
    path = fresh_path(spark, "ratings")
    o = table(spark, folder, "orders").select("o_custkey", "o_orderkey", "o_totalprice", "o_orderstatus")
    sinks.write_text(o, path, sep="::")
    back = readers.read_delimited(spark, path, "::", "user bigint, item bigint, rating double, status string")
    return back.groupBy("user").agg(F.count(F.lit(1)).alias("n"), F.min("item").alias("first_item"),
                                    F.round(F.sum("rating"), 2).alias("total"))


@query("src5_read_vectors", """SELECT count(*) AS n, round(sum(CAST(embedding[1] AS DOUBLE)), 3) AS s0,
  round(sum(CAST(embedding[64] AS DOUBLE)), 3) AS s63 FROM embeddings""")
def src5(spark, folder):
    path = fresh_path(spark, "vectors")
    e = table(spark, folder, "embeddings")
    e.select(F.array_join(F.transform("embedding", lambda x: x.cast("double").cast("string")), " ")).write.text(path)
    from pyspark.ml.functions import vector_to_array

    a = readers.read_vectors(spark, path).select(vector_to_array("features").alias("a"))
    return a.agg(F.count(F.lit(1)).alias("n"), F.round(F.sum(F.col("a")[0]), 3).alias("s0"),
                 F.round(F.sum(F.col("a")[63]), 3).alias("s63"))


@query("src6_read_labelled_points", f"""WITH {ctes.LABELLED} SELECT label, count(*) AS n,
  round(sum(x0), 3) AS s0, round(sum(x3), 3) AS s3 FROM labelled GROUP BY label""")
def src6(spark, folder):
    path = fresh_path(spark, "labelled")
    rows = views.labelled_lines(spark, folder)
    rows.select(F.concat(F.col("label").cast("string"), F.lit(","), F.concat_ws(
        " ", *[F.col(c).cast("string") for c in ("x0", "x1", "x2", "x3")]))).write.text(path)
    points = spread(readers.read_labelled_points(spark, path), "features", ["x0", "x1", "x2", "x3"], "label", digits=10)
    return points.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("x0"), 3).alias("s0"),
                                       F.round(F.sum("x3"), 3).alias("s3"))


@query("src7_in_memory_table", """SELECT v.title, count(*) AS n FROM orders
  JOIN (VALUES ('O', 'open'), ('F', 'filled'), ('P', 'partial')) v(status, title) ON o_orderstatus = v.status
  GROUP BY v.title""")
def src7(spark, folder):
    titles = readers.in_memory_table(spark, [("O", "open"), ("F", "filled"), ("P", "partial")],
                                     "status string, title string")
    o = table(spark, folder, "orders").groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))
    return o.join(F.broadcast(titles), F.col("o_orderstatus") == F.col("status")).select("title", "n")


@query("src8_file_inventory")
def src8(spark, folder):
    found = readers.file_inventory(spark, folder, "item")
    return found.select(F.element_at(F.split("path", "/"), -1).alias("name"), "length")


@query("src9_catalog_table", """SELECT n_regionkey AS key, count(*) AS n, min(n_name) AS value
  FROM nation GROUP BY n_regionkey""")
def src9(spark, folder):
    rows = table(spark, folder, "nation").select(F.col("n_regionkey").alias("key"), F.col("n_name").alias("value"))
    name = f"src_{uuid.uuid4().hex}"
    readers.catalog_table(spark, name, rows, fresh_path(spark, "catalog"))
    return spark.sql(f"SELECT key, count(*) AS n, min(value) AS value FROM {name} GROUP BY key")


@query("src10_temp_view", """SELECT c_mktsegment, count(*) AS n, round(max(c_acctbal), 2) AS best
  FROM customer GROUP BY c_mktsegment""")
def src10(spark, folder):
    readers.temp_view(table(spark, folder, "customer"), "millrace_customer")
    return spark.sql("SELECT c_mktsegment, count(*) AS n, round(max(c_acctbal), 2) AS best "
                     "FROM millrace_customer GROUP BY c_mktsegment")


@query("snk1_write_text", """SELECT CAST(l_suppkey AS VARCHAR) || chr(9) || CAST(count(*) AS VARCHAR) AS line
  FROM lineitem GROUP BY l_suppkey""")
def snk1(spark, folder):
    counts = table(spark, folder, "lineitem").groupBy("l_suppkey").count()
    return sinks.write_text(counts, fresh_path(spark, "text")).select(F.col("value").alias("line"))


@query("snk2_write_parquet_vectors", """SELECT label, count(*) AS n, round(avg(CAST(embedding[1] AS DOUBLE)), 4) AS m0
  FROM embeddings GROUP BY label""")
def snk2(spark, folder):
    from pyspark.ml.functions import array_to_vector, vector_to_array

    points = table(spark, folder, "embeddings").select("label", array_to_vector("embedding").alias("features"))
    back = sinks.write_parquet(points, fresh_path(spark, "points"))
    return back.groupBy("label").agg(F.count(F.lit(1)).alias("n"),
                                     F.round(F.avg(vector_to_array("features")[0]), 4).alias("m0"))


@query("snk3_write_csv_reports", f"""WITH {dirlog.SQL_FILE_SUMMARY}
  SELECT file_name, loop_no_first, loop_no_last, first_seen_ts, last_seen_ts, age FROM file_summary""")
def snk3(spark, folder):
    summary = dirlog.file_summary(dirlog.file_list(dirlog.log_lines(spark, folder)))
    return sinks.write_csv(summary, fresh_path(spark, "filesummary"))


@query("snk3_file_list_report", f"""WITH {dirlog.SQL_FILE_LIST}
  SELECT loop_no, file_ext, count(*) AS n, CAST(sum(file_size) AS BIGINT) AS bytes FROM filelist GROUP BY 1, 2""")
def snk3_files(spark, folder):
    """The report of every file, read back and counted."""
    files = dirlog.file_list(dirlog.log_lines(spark, folder))
    back = sinks.write_csv(files, fresh_path(spark, "filelist"))
    return back.groupBy("loop_no", "file_ext").agg(F.count(F.lit(1)).alias("n"), F.sum("file_size").cast("bigint").alias("bytes"))


@query("snk3_loop_summary_report", f"""WITH {dirlog.SQL_LOOP_SUMMARY} SELECT af.loop_no, all_file_count, all_file_size,
  ob_file_count, ob_file_size FROM af JOIN df ON af.loop_no = df.loop_no""")
def snk3_loops(spark, folder):
    loops = dirlog.loop_summary(dirlog.file_list(dirlog.log_lines(spark, folder)))
    back = sinks.write_csv(loops, fresh_path(spark, "loopsummary"))
    return back.select("loop_no", "all_file_count", "all_file_size", "ob_file_count", "ob_file_size")


@query("snk4_chart_rows", f"""WITH {dirlog.SQL_FILE_SUMMARY}
  SELECT ',[''' || file_name || ''',' || loop_no_first || ',' || age || ']' AS value FROM file_summary""")
def snk4(spark, folder):
    summary = dirlog.file_summary(dirlog.file_list(dirlog.log_lines(spark, folder)))
    path = fresh_path(spark, "chart")
    sinks.chart_rows(summary, "file_name", "loop_no_first", "age").write.text(path)
    return spark.read.text(path)


@query("snk5_save_load_model", f"""WITH {ctes.NAIVE_BAYES}, p AS (SELECT arg_max(t.label, prior + l.x0 * t0 + l.x1 * t1 + l.x2 * t2 + l.x3 * t3) AS c
  FROM (SELECT *, row_number() OVER () AS rid FROM labelled) l, t GROUP BY l.rid) SELECT c AS first, c AS second, count(*) AS n FROM p GROUP BY c""")
def snk5(spark, folder):
    """Predictions of a reloaded model, counted against those of the fitted one."""
    from pyspark.ml.classification import NaiveBayes, NaiveBayesModel
    from pyspark.ml.feature import VectorAssembler

    points = VectorAssembler(inputCols=["x0", "x1", "x2", "x3"], outputCol="features").transform(
        views.labelled_lines(spark, folder))
    model = NaiveBayes(smoothing=1.0).fit(points)
    path = fresh_path(spark, "model")
    model.write().overwrite().save(path)
    again = NaiveBayesModel.load(path)
    first = model.setPredictionCol("first").transform(points).drop("rawPrediction", "probability")
    return (again.setPredictionCol("second").transform(first)
            .groupBy("first", "second").agg(F.count(F.lit(1)).alias("n")))
