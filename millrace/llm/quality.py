"""Quality rules whose limits adapt to the language and the source, with DataFrame functions only.

Per document some shares are measured as whole numbers. Their distribution per (language, source) is kept as a
mergeable quantile sketch: counts of values in buckets that are exact up to 63 and within 3 percent above, so
partial sketches are added up by a sum and the result does not depend on the order of the rows. The quartiles of a
group are mixed with those of its language's merged sketch, which weighs as much as 20 documents: a large source has its
own limits, a small one nearly those of the language, and no size switches from one to the other. The limits are fences
around the quartiles, q3 + 3 (q3 - q1) + slack and, for word length, q1 - 3 (q3 - q1) - slack. A share's fence is never
above the rule's highest limit, so that a group in which most documents are poor still has one. The limits are joined
to the documents and those beyond any of them are rejected.

Defined results: null text counts as empty, and as such fails the base rule; null language or source is a group
like any other; rows that repeat are measured and counted each; an empty table gives no rows; other columns are
kept (the names of ``MEASURES`` and those added by ``judge`` must not clash with them: an error says so).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from millrace.plans.durable import staged
from millrace.plans.sizing import balanced, planned_bytes

LANGUAGE_WEIGHT = 20
BROADCAST_BYTES = 8 << 20
SPACE = "[\\x20\\x09-\\x0D]"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_upper")
# Rule: numerator, denominator, factor, slack above, slack below (None: no lower limit), highest limit (None: any).
RULES = {
    "symbols": ("n_symbols", "word_chars", 1000, 50, None, 500),
    "dup_lines": ("n_dup_lines", "n_lines", 1000, 400, None, 700),
    "repeats": ("n_repeat_words", "n_words", 1000, 400, None, 700),
    "upper": ("n_upper", "word_chars", 1000, 100, None, 700),
    "word_length": ("word_chars", "n_words", 10, 10, 10, None),
}


def measure(df: DataFrame, text_column: str = "text") -> DataFrame:
    """``df`` with the columns of ``MEASURES``."""
    if clash := set(MEASURES) & set(df.columns):
        raise ValueError(f"columns {sorted(clash)} are there already")
    text = F.coalesce(F.col(text_column), F.lit(""))
    words = F.array_remove(F.split(text, f"{SPACE}+"), "")
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike("[^\\x20\\x09-\\x0D]"))
    split = balanced(df).withColumn("_words", words).withColumn("_lines", lines)
    n = F.size("_words")
    three = [F.slice("_words", i, F.greatest(n - 2, F.lit(0))) for i in (1, 2, 3)]
    windows = F.transform(F.arrays_zip(*[w.alias(f"w{i}") for i, w in enumerate(three)]),
                          lambda w, i: F.struct(F.concat_ws(" ", w["w0"], w["w1"], w["w2"]).alias("w"), i.alias("i")))
    # Equal windows stand side by side once sorted; all their starts are collected, and each covers three words.
    sorted_windows = split.withColumn("_sorted", F.sort_array(windows))
    others = F.greatest(n - 3, F.lit(0))
    beside = F.zip_with(F.slice("_sorted", 1, others), F.slice("_sorted", 2, others),
                        lambda a, b: F.when(a["w"] == b["w"], F.array(a["i"], b["i"])))
    starts = F.sort_array(F.array_distinct(F.flatten(F.filter(beside, lambda p: p.isNotNull()))))
    zero = F.struct(F.lit(0).alias("total"), F.lit(-3).alias("last"))
    covered = F.aggregate(starts, zero, lambda a, s: F.struct(
        (a["total"] + F.least(F.lit(3), s - a["last"])).alias("total"), s.alias("last")))["total"]
    joined = F.array_join("_words", "")
    return sorted_windows.select(
        *df.columns, n.cast("bigint").alias("n_words"), F.char_length(joined).cast("bigint").alias("word_chars"),
        _without(joined, "[#*$%&|<>]").alias("n_symbols"), F.size("_lines").cast("bigint").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint").alias("n_dup_lines"),
        F.when(n >= 4, covered).otherwise(0).cast("bigint").alias("n_repeat_words"),
        _without(joined, "[A-Z]").alias("n_upper"))


def _without(text: Column, pattern: str) -> Column:
    """How many characters match."""
    return (F.char_length(text) - F.char_length(F.regexp_replace(text, pattern, ""))).cast("bigint")


def share(rule: str) -> Column:
    part, whole, factor, *_ = RULES[rule]
    return F.floor(F.col(part) * factor / F.greatest(F.col(whole), F.lit(1))).cast("bigint")


def bucket(value: Column) -> Column:
    """The value with all but its six highest bits set to zero."""
    low = F.greatest(F.length(F.bin(value)) - 6, F.lit(0))
    return value - F.pmod(value, F.pow(F.lit(2.0), low).cast("bigint"))


def sketches(measured: DataFrame, groups: list[str]) -> DataFrame:
    """(groups, rule, bucket, n): one sketch per group and rule. Sketches of parts merge by adding n."""
    rules = F.array(*[F.struct(F.lit(r).alias("rule"), bucket(share(r)).alias("bucket")) for r in RULES])
    return (measured.select(*groups, F.inline(rules))
            .groupBy(*groups, "rule", "bucket").agg(F.count(F.lit(1)).alias("n")))


def quartiles(counts: DataFrame, groups: list[str], support: str, low: str, high: str) -> DataFrame:
    """(groups, rule, support, low, high): size and first and third quartile of each sketch."""
    inside = W.partitionBy(*groups, "rule")
    running = counts.select("*", F.sum("n").over(inside.orderBy("bucket")).alias("_upto"), F.sum("n").over(inside).alias("_all"))
    return running.groupBy(*groups, "rule").agg(
        F.max("_all").alias(support),
        F.min(F.when(4 * F.col("_upto") >= F.col("_all"), F.col("bucket"))).alias(low),
        F.min(F.when(4 * F.col("_upto") >= 3 * F.col("_all"), F.col("bucket"))).alias(high))


def thresholds(measured: DataFrame, language: str = "lang", source: str = "source") -> DataFrame:
    """(language, source, <rule>_above, <rule>_below): fences around a source's quartiles mixed with its language's."""
    own = staged(sketches(measured, [language, source]), "sketches")
    merged = own.groupBy(language, "rule", "bucket").agg(F.sum("n").alias("n"))
    narrow = quartiles(own, [language, source], "_n", "_q1", "_q3")
    wide = quartiles(merged, [language], "_m", "_p1", "_p3").withColumnsRenamed({language: "_lang", "rule": "_rule"})
    joined = narrow.join(wide, narrow[language].eqNullSafe(wide["_lang"]) & (narrow["rule"] == wide["_rule"]))
    mixed = lambda a, b: (F.col("_n") * F.col(a) + LANGUAGE_WEIGHT * F.col(b)) / (F.col("_n") + LANGUAGE_WEIGHT)
    ends = joined.select(language, source, "rule", mixed("_q1", "_p1").alias("q1"), mixed("_q3", "_p3").alias("q3"))
    reach = 3 * (F.col("q3") - F.col("q1"))
    limits = []
    for rule, (_, _, _, above, below, highest) in RULES.items():
        mine = F.col("rule") == rule
        fence = F.floor(F.col("q3") + reach + above)
        limits.append(F.max(F.when(mine, fence if highest is None else F.least(fence, F.lit(highest)))).alias(f"{rule}_above"))
        if below is not None:
            limits.append(F.max(F.when(mine, F.ceil(F.col("q1") - reach - below))).alias(f"{rule}_below"))
    return ends.groupBy(language, source).agg(*limits)


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def judge(measured: DataFrame, language: str = "lang", source: str = "source") -> DataFrame:
    """``measured`` (written, as it is read twice) with base_failed and kept."""
    if clash := {"base_failed", "kept"} & set(measured.columns):
        raise ValueError(f"columns {sorted(clash)} are there already")
    limits = staged(thresholds(measured, language, source), "limits")
    limits = limits.withColumnsRenamed({language: "_lang", source: "_source"})
    small = planned_bytes(limits) <= BROADCAST_BYTES
    same = measured[language].eqNullSafe(limits["_lang"]) & measured[source].eqNullSafe(limits["_source"])
    joined = measured.join(F.broadcast(limits) if small else limits, same)
    within = [share(r) <= F.col(f"{r}_above") for r in RULES]
    within += [share(r) >= F.col(f"{r}_below") for r, rule in RULES.items() if rule[4] is not None]
    return joined.select(*measured.columns, base_failed().alias("base_failed"),
                         (~base_failed() & reduce(Column.__and__, within)).alias("kept"))
