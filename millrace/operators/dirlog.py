"""Directory-monitor logs: parse the listing lines, then summarise files and loops."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.functions.numeric import normal_loop_time, seconds_between, with_seconds
from millrace.functions.text import file_extension, filename_timestamp
from millrace.plans.durable import fresh_path
from millrace.plans.ordering import carry_forward
from millrace.sources.tables import table

TIME = "yyyy-MM-dd HH:mm:ss"
START_LOOP = "--START-LOOP"


def log_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Events written as directory logs: one log per host, one loop per day.

    Returns (file, split, pos, line) as ``read_ordered_lines`` does. Each listing line is one
    event; day 3 has no ``dat`` file.
    """
    e = table(spark, folder, "events").select(
        "event_id", "ts", F.concat(F.lit("host"), (F.col("user_id") % 3).cast("string")).alias("file"),
        F.dayofyear("ts").alias("day"), F.floor(F.col("value") * 100).cast("bigint").alias("size"))
    ext = (F.when(F.col("event_id") % 7 == 0, F.lit(""))
           .when((F.col("event_id") % 3 == 0) | (F.col("day") == 3), F.lit(".log")).otherwise(F.lit(".dat")))
    stamp = F.when(F.col("event_id") % 5 == 0, F.lit("x_y")).otherwise(F.date_format("ts", "yyyyMMdd_HHmmss"))
    name = F.concat(F.lit("a_b_c_d_f"), (F.col("event_id") % 4000).cast("string"), F.lit("_"), stamp, ext)
    entry = F.concat(F.lit("-rw-r--r--  1 own\tgrp "), F.col("size").cast("string"), F.lit("  "),
                     F.date_format("ts", "yyyy-MM-dd HH:mm"), F.lit(" "), name)
    listed = e.select("file", "day", F.lit(3).alias("kind"), "event_id", entry.alias("line"))
    days = e.groupBy("file", "day").agg(F.min("ts").alias("first"))
    hosts = e.select("file").distinct()
    loop = days.select("file", "day", F.lit(1).alias("kind"), F.lit(-1).cast("bigint").alias("event_id"),
                       F.concat(F.lit(START_LOOP + " "), F.col("day").cast("string")).alias("line"))
    clock = days.select("file", "day", F.lit(2).alias("kind"), F.lit(-1).cast("bigint").alias("event_id"),
                        F.concat(F.lit("TS: "), F.date_format("first", "yyyy-MM-dd:HH:mm:ss")).alias("line"))
    title = hosts.select("file", F.lit(0).alias("day"), F.lit(0).alias("kind"), F.lit(-1).cast("bigint").alias("event_id"),
                         F.concat(F.lit("Hostname: "), F.col("file")).alias("line"))
    whole = listed.unionByName(loop).unionByName(clock).unionByName(title)
    return whole.select("file", F.col("day").cast("bigint").alias("split"),
                        (F.col("kind").cast("bigint") * F.lit(1 << 40) + F.col("event_id") + 1).alias("pos"), "line")


def write_logs(lines: DataFrame) -> str:
    """Lines (file, split, pos, line) as text files, one folder per log, and the folder that holds them.

    A log of any size is written by many tasks: its lines are sorted into ranges, and each part file holds a range.
    """
    path = fresh_path(lines.sparkSession, "logs")
    ordered = lines.repartitionByRange("file", "split", "pos").sortWithinPartitions("file", "split", "pos")
    ordered.select("file", "line").write.partitionBy("file").text(path)
    return path


def file_list(lines: DataFrame) -> DataFrame:
    """Listing lines with the loop, loop time and host in force at that line.

    A log opens with a header that ends at its first loop mark; the host is taken from there
    only. After it, loop marks and time lines change the current loop and every line of
    exactly eight tokens is a file entry.
    """
    tidy = F.regexp_replace("line", r"\s+$", "")
    for pattern in ("\t", ": ", " +"):
        tidy = F.regexp_replace(tidy, pattern, " ")
    parts = lines.select("file", "split", "pos", F.split(tidy, " ").alias("t"))
    word, arg = F.col("t")[0], F.get(F.col("t"), F.lit(1))
    place = F.struct("split", "pos")
    body = parts.where(word == START_LOOP).groupBy("file").agg(F.min(place).alias("_body"))
    marks = parts.join(body, "file").select(
        "file", "split", "pos", "t",
        F.when(word == START_LOOP, arg.try_cast("bigint")).alias("loop_no"),
        F.when((word == "TS") & (place > F.col("_body")), normal_loop_time(arg)).alias("loop_ts"),
        F.when((word == "Hostname") & (place < F.col("_body")), arg).alias("host_name"))
    current = carry_forward(marks, ["split", "pos"], ["loop_no", "loop_ts", "host_name"], keys=["file"])
    entry = current.where(F.col("loop_no").isNotNull() & (F.size("t") == 8)
                          & ~F.col("t")[0].isin(START_LOOP, "TS"))
    name = F.col("t")[7]
    return entry.select(
        "loop_no", "loop_ts", "host_name", name.alias("file_name"), file_extension(name).alias("file_ext"),
        F.col("t")[4].try_cast("bigint").alias("file_size"),
        with_seconds(F.col("t")[5], F.col("t")[6]).alias("file_ts"),
        F.date_format(filename_timestamp(name), TIME).alias("filename_ts"))


def file_summary(files: DataFrame) -> DataFrame:
    """First and last loop and time of each file, and its age in seconds."""
    seen = files.groupBy("file_name").agg(
        F.min("loop_no").alias("loop_no_first"), F.max("loop_no").alias("loop_no_last"),
        F.min("loop_ts").alias("first_seen_ts"), F.max("loop_ts").alias("last_seen_ts"))
    return seen.withColumn("age", seconds_between(F.col("first_seen_ts"), F.col("last_seen_ts")))


def loop_summary(files: DataFrame, extension: str = "dat") -> DataFrame:
    """All files of a loop next to its files of one extension. Loops without such files are left out.

    The two sides meet on the loop number alone. ``files`` is read three times: give it staged.
    """
    first_seen = file_summary(files).select("file_name", "first_seen_ts")
    everything = files.groupBy("loop_no", "loop_ts", "host_name").agg(
        F.count(F.lit(1)).alias("all_file_count"), F.sum("file_size").alias("all_file_size"))
    chosen = (files.where(F.col("file_ext") == extension).join(first_seen, "file_name")
              .groupBy("loop_no", F.col("loop_ts").alias("_ts"))
              .agg(F.count(F.lit(1)).alias("ob_file_count"), F.sum("file_size").alias("ob_file_size"),
                   F.min("first_seen_ts").alias("ob_file_oldest_ts"),
                   F.max("first_seen_ts").alias("ob_file_latest_ts")))
    both = everything.join(chosen, "loop_no").drop("_ts")
    return (both.withColumn("ob_file_oldest_age", seconds_between(F.col("ob_file_oldest_ts"), F.col("loop_ts")))
            .withColumn("ob_file_latest_age", seconds_between(F.col("ob_file_latest_ts"), F.col("loop_ts"))))


SQL_FILE_LIST = """days AS (SELECT 'host' || (user_id % 3) AS host_name, dayofyear(ts) AS day, min(ts) AS first
    FROM events GROUP BY 1, 2),
  listed AS (SELECT CAST(d.day AS BIGINT) AS loop_no, strftime(d.first, '%Y-%m-%d %H:%M:%S') AS loop_ts, d.host_name,
    'a_b_c_d_f' || (event_id % 4000) || '_' ||
    CASE WHEN event_id % 5 = 0 THEN 'x_y' ELSE strftime(ts, '%Y%m%d_%H%M%S') END AS stem,
    CASE WHEN event_id % 7 = 0 THEN '' WHEN event_id % 3 = 0 OR d.day = 3 THEN '.log' ELSE '.dat' END AS ext,
    CAST(floor(value * 100) AS BIGINT) AS file_size, strftime(ts, '%Y-%m-%d %H:%M') || ':00' AS file_ts,
    CASE WHEN event_id % 5 = 0 THEN NULL ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS filename_ts
    FROM events JOIN days d ON d.host_name = 'host' || (user_id % 3) AND d.day = dayofyear(ts)),
  filelist AS (SELECT loop_no, loop_ts, host_name, stem || ext AS file_name,
    CASE ext WHEN '' THEN 'undef' ELSE substr(ext, 2) END AS file_ext, file_size, file_ts, filename_ts FROM listed)"""
SQL_FILE_SUMMARY = SQL_FILE_LIST + """,
  file_summary AS (SELECT *, CAST(date_diff('second', CAST(first_seen_ts AS TIMESTAMP), CAST(last_seen_ts AS TIMESTAMP)) AS BIGINT) AS age
    FROM (SELECT file_name, min(loop_no) AS loop_no_first, max(loop_no) AS loop_no_last, min(loop_ts) AS first_seen_ts,
    max(loop_ts) AS last_seen_ts FROM filelist GROUP BY file_name))"""
SQL_LOOP_SUMMARY = SQL_FILE_SUMMARY + """,
  af AS (SELECT loop_no, loop_ts, host_name, count(*) AS all_file_count, CAST(sum(file_size) AS BIGINT) AS all_file_size
    FROM filelist GROUP BY 1, 2, 3),
  df AS (SELECT l.loop_no, l.loop_ts, count(*) AS ob_file_count, CAST(sum(l.file_size) AS BIGINT) AS ob_file_size,
    min(s.first_seen_ts) AS ob_file_oldest_ts, max(s.first_seen_ts) AS ob_file_latest_ts
    FROM filelist l JOIN file_summary s USING (file_name) WHERE l.file_ext = 'dat' GROUP BY 1, 2)"""
