"""Every stage of the pipeline on odd tables: nulls, empty and very long texts, repeats, ties, extra columns, no rows."""

import random

import pytest

import corpus_pipeline as pipeline
from tests.llm import brute

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, kept string, _hits int, _gone int, shard string"
DRAW = random.Random(1)
WORDS = [f"word{i}" for i in range(900)]
CLEAN = [" ".join(DRAW.choices(WORDS, k=80)) for _ in range(6)]
LONG = " ".join(DRAW.choices(WORDS, k=60_000))
ITEM = " ".join(DRAW.choices(WORDS, k=30))
MAIL = CLEAN[5] + " write to jane@example.org now"


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("tables"))
    texts = [(1, CLEAN[0], "en", "a"), (1, CLEAN[0], "en", "a"), (2, CLEAN[0], "en", "a"), (3, CLEAN[1], None, None), (4, None, "en", "a"), (5, "", "en", None),
             (None, CLEAN[2], "en", "a"), (6, LONG, "de", "b"), (7, CLEAN[3] + " " + ITEM, "en", "a"), (8, MAIL, "en", "a"), (9, "same line\n" * 300, "en", "a")]
    rows = [(i, t, lang, source, len(t or ""), "x", 1, 2, "s") for i, t, lang, source in texts]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, ITEM), (2, None), (3, "...")], "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder


def ids(df):
    assert tuple(df.columns) == pipeline.COLUMNS
    return sorted((r.doc_id or 0) for r in df.collect())


def test_stages(spark, odd):
    docs = spark.read.schema(SCHEMA).parquet(f"{odd}/documents.parquet")
    assert ids(pipeline.quality_rules(spark, docs, odd)) == [0, 1, 1, 2, 3, 6, 7, 8]
    assert ids(pipeline.near_duplicates(spark, docs, odd)) == [0, 1, 3, 4, 5, 6, 7, 8, 9]
    assert ids(pipeline.decontamination(spark, docs, odd)) == [0, 1, 1, 2, 3, 4, 5, 6, 8, 9]
    masked = pipeline.personal_data(spark, docs, odd)
    assert ids(masked) == [0, 1, 1, 2, 3, 4, 5, 6, 7, 8, 9]
    rows = {r.doc_id: r for r in masked.collect()}
    assert rows[4].text is None and rows[8].n_chars == len(rows[8].text) and not brute.personal(rows[8].text) and rows[6].text == LONG
    pieces = pipeline.packed(spark, docs, odd).collect()
    assert sum(r.length for r in pieces if r.doc_id == 6) == next(r.doc_tokens for r in pieces if r.doc_id == 6) > 4096
    assert {r.doc_tokens for r in pieces if r.doc_id in (4, 5)} == {1}


def test_stages_of_an_empty_table(spark, odd):
    none = spark.read.schema(SCHEMA).parquet(f"{odd}/documents.parquet").where("doc_id = -1")
    for _, stage in pipeline.STAGES:
        assert stage(spark, none, odd).count() == 0


def test_run_takes_every_stage(spark, odd):
    assert {r.doc_id for r in pipeline.run(spark, odd).collect()} == {None, 1, 3, 6, 8}
