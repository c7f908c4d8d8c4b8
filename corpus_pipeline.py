"""Corpus pipeline: quality rules, near-duplicates, benchmark decontamination, personal data, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows that its predecessor kept. All but the last return
the columns of ``documents``. Between stages the rows are written as Parquet in the shared folder and read again.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.llm import decontaminate, near_dup, packing, pii, quality
from millrace.llm.batches import small_batches
from millrace.plans.durable import staged
from millrace.session import configure
from millrace.sources.tables import table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rule or lie beyond the limits of their language and source go.

    A null or empty text has no words and goes by the base rule; a null language or source is a group like any other;
    rows that repeat are judged alike, so all stay or all go; texts are measured whole; a null id is kept as it is; an
    empty table stays empty; columns other than those of ``documents`` are dropped.
    """
    small_batches(configure(spark))
    measured = staged(quality.measure(docs.select(*COLUMNS)), "measured")
    return quality.judge(measured).where("kept").select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays, that of the smallest id; shingles of five words, similarity 0.8.

    Null, empty and wordless texts are linked with nothing and stay; rows with a null id stay; rows that repeat an id are
    one document, of which one row stays; an empty table stays empty; other columns are dropped.
    """
    small_batches(configure(spark))
    return near_dup.deduplicate(docs.select(*COLUMNS))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which one word in twenty or more belongs to benchmark windows go.

    A null text has no words and stays; rows that repeat are judged alike; null and wordless benchmark items, or an empty
    benchmark, reject nothing; an empty table stays empty; other columns are dropped.
    """
    small_batches(configure(spark))
    marked = decontaminate.mark(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"), prefix="_")
    return marked.where(~decontaminate.contaminated("_n_words", "_hits")).select(*COLUMNS)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by the name of its kind; all documents stay.

    A null text stays null with the count it had; otherwise n_chars is that of the masked text; rows that repeat are
    masked alike; an empty table stays empty; other columns are dropped.
    """
    small_batches(configure(spark))
    masked = pii.mask(docs.select(*COLUMNS), output="_masked")
    return masked.select("doc_id", F.col("_masked").alias("text"), "lang", "source",
                         F.when(F.col("_masked").isNull(), F.col("n_chars")).otherwise(F.char_length("_masked")).cast("bigint").alias("n_chars"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 4096 tokens.

    A null or empty text is one end-of-text token; a text longer than a sequence is cut into pieces; rows that repeat
    are packed each; an empty table gives no pieces; other columns are dropped.
    """
    small_batches(configure(spark))
    return packing.pack(docs.select(*COLUMNS), public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("quality rules", quality_rules), ("near duplicates", near_duplicates), ("decontamination", decontamination),
          ("personal data", personal_data), ("packing", packed)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(configure(spark), sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs


# Token ids and checksums of the last stage cannot be said in SQL; tests compare with a brute-force version.
ORACLE_SQL = None
