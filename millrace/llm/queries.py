"""The registered queries of this package: thin calls of the operators, and their SQL where it can say the same."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.llm import (chat, decontaminate, html_text, near_dup, packing, pii, quality, resampling, sharding, tokens, topk, toxicity,
                          vector_codes)
from millrace.llm.batches import small_batches
from millrace.llm.sql import SHARD_LIMIT, SQL  # noqa: F401  (SQL is the other half of what is registered)
from millrace.plans.durable import staged
from millrace.session import configure
from millrace.sources.tables import table


def op1_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return tokens.token_budget(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"), 1024)


def op2_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    poor = labels.select("doc_id", (1 - F.col("quality")).alias("low_quality"), "toxic")
    categories = ["low_quality", "toxic"]
    links = toxicity.fit_chain(docs, poor, categories)
    return toxicity.score(docs, links, categories).withColumn("toxic", F.col("p_toxic") >= toxicity.THRESHOLD)


def op3_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.assign(table(spark, folder, "documents"), SHARD_LIMIT)


def op4_near_dup(spark: SparkSession, folder: str) -> DataFrame:
    return near_dup.components(table(spark, folder, "documents"), width=4)


def op5_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    marked = decontaminate.mark(table(spark, folder, "documents"), table(spark, folder, "benchmark"), keep=["doc_id"])
    return marked.select("doc_id", "n_words", decontaminate.hit_words().alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
                         decontaminate.digest().alias("items_sha256"), decontaminate.contaminated().alias("contaminated"))


def op6_pii(spark: SparkSession, folder: str) -> DataFrame:
    found = pii.find_spans(table(spark, folder, "documents"), ["doc_id"])
    written = F.transform("spans", lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
    n_base = F.size(F.filter("spans", lambda s: s["kind"].isin(*pii.BASE)))
    kinds = F.transform("spans", lambda s: s["kind"])
    counts = [F.size(F.array_compact(F.transform(kinds, _if_equal(kind)))).cast("bigint").alias(f"n_{kind}") for kind in pii.BASE]
    # Spans come by kind, those of the base first.
    base = F.array_join(F.slice(written, 1, n_base), ",")
    return found.select("doc_id", *counts, F.sha2(base.cast("binary"), 256).alias("base_sha256"), F.array_join(written, ",").alias("spans"))


def _if_equal(kind: str):
    return lambda value: F.when(value == kind, value)


def op7_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "lang", "source", "text")
    measured = staged(quality.measure(docs).drop("text"), "measured")
    return quality.judge(measured).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                                          "base_failed", "kept")


def op8_chat(spark: SparkSession, folder: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    own = spark.range(2).select(F.lit(-7).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
                                F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    turns = table(spark, folder, "conversations").unionByName(own)
    return chat.read_back(chat.format_chats(turns.withColumn("parts", chat.text_part(F.col("text")))))


def op9_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op10_html_text(spark: SparkSession, folder: str) -> DataFrame:
    return html_text.extract(table(spark, folder, "pages"), ["page_id", "url"])


def op11_importance_resampling(spark: SparkSession, folder: str) -> DataFrame:
    drawn = resampling.resample(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


def op12_top_k(spark: SparkSession, folder: str) -> DataFrame:
    return topk.top_k(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0)


def op13_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    return vector_codes.compress(table(spark, folder, "embeddings"))


def _prepared(fn):
    def run(spark: SparkSession, folder: str) -> DataFrame:
        configure(spark)
        small_batches(spark)
        return fn(spark, folder)

    return run


QUERIES = {fn.__name__: _prepared(fn) for fn in (
    op1_token_counts, op2_toxicity, op3_sharding, op4_near_dup, op5_decontaminate, op6_pii, op7_quality, op8_chat, op9_packing,
    op10_html_text, op11_importance_resampling, op12_top_k, op13_vector_codes)}
