"""Line, word, log and file-name parsing on literal inputs."""

import datetime as dt
import random
from collections import Counter

from pyspark.sql import functions as F

from millrace.functions import numeric, text, weblog
from millrace.operators import dictionary, dirlog
from millrace.operators.features import active_entries, quantile_buckets, text_corpus
from millrace.sources.readers import read_log_folders, read_ordered_lines


def one(spark, value, expression):
    return spark.createDataFrame([(value,)], "x string").select(expression(F.col("x")).alias("y")).first()["y"]


def words(spark, line, split=text.words_of):
    return [r["word"] for r in split(spark.createDataFrame([(line,)], "line string")).collect()]


def test_words_keep_inner_and_drop_trailing_empties(spark):
    assert words(spark, "a  b ") == ["a", "", "b"]
    assert words(spark, "") == [""]
    assert words(spark, "   ") == []
    assert words(spark, " a") == ["", "a"]
    assert words(spark, "a\tb  c", text.blank_separated) == ["a", "b", "c"]
    assert words(spark, "a \t b\n", text.whitespace_tokens) == ["a", "b"]


def test_file_names(spark):
    assert one(spark, "a.b.dat", text.file_extension) == "dat"
    assert one(spark, "plain", text.file_extension) == "undef"
    assert one(spark, "a_b-c:d.e_20240131_235959.dat", text.filename_timestamp) == dt.datetime(2024, 1, 31, 23, 59, 59)
    for bad in ("a_b_c_d_e_20240131.dat", "a_b_20240131_235959", "a_b_c_d_e_2024013_235959.dat", "a_b_c_d_e_20240131_2359.x"):
        assert one(spark, bad, text.filename_timestamp) is None


def test_access_log(spark):
    line = '1.2.3.4 - {user} [02/Mar/2021:05:06:07 +0200] "GET /x HTTP/1.1" 200 {sent} "http://r/" "agent" tail'
    rows = [line.format(user='"ANN"', sent="871"), line.format(user='"ANN"', sent="-"),
            line.format(user='"-"', sent="20"), "not a log line", line.format(user='"A\x01"', sent="5")]
    got = spark.createDataFrame([(r,) for r in rows], "line string").select(weblog.access_log(F.col("line")).alias("e")).select(
        *weblog.visit_key(F.col("e")), weblog.visit_bytes(F.col("e"))).collect()
    key = ("1.2.3.4", '"ANN"', "GET /x HTTP/1.1")
    assert [tuple(r) for r in got] == [(*key, 871), (*key, 0), (None, None, None, 20), (None, None, None, 0),
                                       ("1.2.3.4", '"A\x01"', "GET /x HTTP/1.1", 5)]


def test_times(spark):
    assert one(spark, "2024-01-02:03:04:05", numeric.normal_loop_time) == "2024-01-02 03:04:05"
    assert one(spark, "2024-01-02 03:04:05", numeric.normal_loop_time) == "2024-01-02 03:04:05"
    day = spark.createDataFrame([("2024-01-02", "03:04"), ("2024-13-02", "03:04")], "d string, c string")
    assert [r[0] for r in day.select(numeric.with_seconds(F.col("d"), F.col("c"))).collect()] == ["2024-01-02 03:04:00", None]


LOG = """Start 2024-01-01
Hostname: alpha
TS: 2023-12-31:00:00:00
--START-LOOP 1
Hostname: ignored
TS: 2024-01-01:00:00:00
-rw-r--r-- 1 own\tgrp 10  2024-01-01 00:00 a_b_c_d_e_20240101_000000.dat
-rw-r--r-- 1 own grp 20 2024-01-01 00:01 note
total 30
--START-LOOP 2
TS: 2024-01-01:00:10:00
-rw-r--r-- 1 own grp 30 2024-01-01 00:02 note
"""


def test_directory_log_files(spark, tmp_path, many_blocks):
    """Read as text files in many splits; the order of the lines must hold."""
    for host in ("alpha", "beta"):
        (tmp_path / f"{host}.log").write_text(LOG.replace("alpha", host))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100b")
    try:
        files = dirlog.file_list(read_ordered_lines(spark, str(tmp_path)))
        got = sorted(tuple(r) for r in files.where("host_name = 'beta'").collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == [
        (1, "2024-01-01 00:00:00", "beta", "a_b_c_d_e_20240101_000000.dat", "dat", 10, "2024-01-01 00:00:00", "2024-01-01 00:00:00"),
        (1, "2024-01-01 00:00:00", "beta", "note", "undef", 20, "2024-01-01 00:01:00", None),
        (2, "2024-01-01 00:10:00", "beta", "note", "undef", 30, "2024-01-01 00:02:00", None)]
    summary = {r["file_name"]: r for r in dirlog.file_summary(files).collect()}
    assert summary["note"]["age"] == 600 and summary["note"]["loop_no_last"] == 2
    loops = dirlog.loop_summary(files).collect()
    assert {r["loop_no"] for r in loops} == {1} and all(r["ob_file_count"] == 2 for r in loops)


def test_logs_written_in_parts_and_read_in_ranges(spark, small, many_blocks):
    """Logs go to many part files and come back in ranges of a few kilobytes, with every line in its place."""
    lines = dirlog.log_lines(spark, small)
    path = dirlog.write_logs(lines)
    key, old = "spark.sql.files.maxPartitionBytes", spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set(key, "4096")
    try:
        read = read_log_folders(spark, path)
        assert read.rdd.getNumPartitions() > 9 and read.select("split").distinct().count() > 9
        back = sorted((r.file, r.split, r.pos, r.line) for r in read.collect())
        assert len(spark.read.text(path).inputFiles()) > 3
        files = dirlog.file_list(read).collect()
    finally:
        spark.conf.set(key, old)
    want = sorted((r.file, r.split, r.pos, r.line) for r in lines.collect())
    assert [(f, line) for f, _, _, line in back] == [(f, line) for f, _, _, line in want]
    assert sorted(map(str, files)) == sorted(map(str, dirlog.file_list(lines).collect()))


def test_corpus_keeps_every_term(spark):
    """More terms than the library's default vocabulary of 2 to the 18th."""
    docs = spark.range(2700).select("id", F.array_join(F.transform(
        F.sequence(F.lit(0), F.lit(99)), lambda i: F.concat(F.lit("w"), (F.col("id") * 100 + i).cast("string"))), " ").alias("text"))
    corpus, learned = text_corpus(docs, "id", "text")
    assert learned.size == learned.terms.count() == 270_000
    sizes = corpus.select(F.size(active_entries("features")).alias("n")).groupBy("n").count().collect()
    assert [(r["n"], r["count"]) for r in sizes] == [(100, 2700)]


def test_dictionary_places_terms_by_frequency(spark, many_blocks, monkeypatch):
    """Against plain counting: hot terms, ties, nulls, a repeated identity, an empty document, a bounded dictionary."""
    monkeypatch.setattr(dictionary, "FREQUENT", 3)
    draw = random.Random(5)
    docs = [(i, " ".join(["the"] * 3 + [draw.choice("abcdefgh") for _ in range(draw.randrange(9))])) for i in range(60)] + [(7, "a a zz"), (90, None), (91, "")]
    df = spark.createDataFrame(docs, "id int, text string")
    total = Counter(w for _, t in docs for w in (t or "").split())
    order = [t for t, _ in sorted(total.items(), key=lambda p: (-p[1], p[0]))]
    for size in (None, 4):
        corpus, learned = text_corpus(df, "id", "text", size)
        assert [(r.term, r.n) for r in learned.terms.orderBy("pos").collect()] == [(t, total[t]) for t in order[:size]]
        got = sorted((r.id, tuple(sorted((order[int(i)], x) for i, x in zip(r.features.indices, r.features.values)))) for r in corpus.collect())
        want = sorted((i, tuple(sorted((w, float(n)) for w, n in Counter((t or "").split()).items() if w in order[:size]))) for i, t in docs)
        assert got == want and sorted(r.row for r in corpus.collect()) == list(range(len(docs)))
        assert {r.features.size for r in corpus.collect()} == {len(order[:size])}
    counts = dictionary.term_counts(df.select("id", F.split("text", " ").alias("w")), "id", "w")
    assert dictionary.learn(counts, 10, min_documents=2).terms.where("term = 'zz'").isEmpty()
    assert text_corpus(df.limit(0), "id", "text")[0].count() == 0


def test_rare_terms_meet_no_hot_key(spark, many_blocks, monkeypatch):
    """The counts of the most frequent terms take part in no exchange by term."""
    monkeypatch.setattr(dictionary, "FREQUENT", 1)
    counts = dictionary.term_counts(spark.createDataFrame([(1, ["a", "a", "b"]), (2, ["a", "c"])], "id int, w array<string>"), "id", "w")
    found = dictionary.numbered(counts, dictionary.learn(counts, 2))
    assert sorted((r.id, r.term, r.n, r.pos, r.df) for r in found.collect()) == [(1, "a", 2, 0, 2), (1, "b", 1, 1, 1), (2, "a", 1, 0, 2), (2, "c", 1, 2, 1)]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" in plan and plan.count("strategy=broadcast") == 2


def test_quantile_buckets(spark):
    rows = [(i, float(i % 10)) for i in range(40)] + [(40, None), (41, float("nan"))]
    frame = spark.createDataFrame(rows, "id int, x double")
    got = {r["id"]: r["b"] for r in quantile_buckets(frame, "x", ["x", "id"], 4, "b").collect()}
    # Positions 9, 19 and 29 of the sorted values hold 2, 4 and 7.
    assert got == {i: None if x is None or x != x else float((x >= 2) + (x >= 4) + (x >= 7)) for i, x in rows}
    assert quantile_buckets(frame.limit(0), "x", ["x", "id"], 4, "b").count() == 0
