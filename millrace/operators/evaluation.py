"""Quality measures of predictions, as DataFrame arithmetic."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from millrace.plans.durable import staged
from millrace.plans.ordering import row_index, running_sums


def threshold_counts(df: DataFrame, score: str, label: str) -> DataFrame:
    """True and false positives when everything scored at or above a threshold is positive.

    Rows are first counted per score; running sums over the scores then work in blocks.
    """
    per_score = df.groupBy(F.col(score).alias("threshold")).agg(
        F.sum(F.when(F.col(label) > 0.5, 1).otherwise(0)).alias("_p"), F.count(F.lit(1)).alias("_n"))
    down = per_score.withColumn("_down", -F.col("threshold"))
    sums = running_sums(down, ["_down"], {"tp": F.col("_p"), "fp": F.col("_n") - F.col("_p")})
    return staged(sums.select("threshold", "tp", "fp"), "thresholds")


def _f_beta(p: Column, r: Column, beta: float) -> Column:
    b = beta * beta
    return F.when(p + r == 0, 0.0).otherwise((1 + b) * p * r / (b * p + r))


def threshold_metrics(counts: DataFrame) -> DataFrame:
    """Precision, recall, F1, F0.5 and false positive rate at each threshold."""
    totals = counts.agg(F.max("tp").alias("tp"), F.max("fp").alias("fp")).first()
    p = F.try_divide(F.col("tp"), F.col("tp") + F.col("fp"))
    r = F.try_divide(F.col("tp"), F.lit(float(totals["tp"] or 0)))
    return counts.select("threshold", "tp", "fp", p.alias("precision"), r.alias("recall"),
                         F.try_divide(F.col("fp"), F.lit(float(totals["fp"] or 0))).alias("fpr"),
                         _f_beta(p, r, 1.0).alias("f1"), _f_beta(p, r, 0.5).alias("f05"))


def curve_areas(metrics: DataFrame) -> DataFrame:
    """Areas under the ROC and the precision-recall curve by trapezoids.

    Neighbouring thresholds meet through their positions, so no task sees the whole curve.
    The precision-recall curve starts at recall 0 with the first precision.
    """
    m = metrics.select((-F.col("threshold")).alias("_d"), "fpr", "recall", "precision")
    here = row_index(m, ["_d"], "_i")
    after = here.select((F.col("_i") - 1).alias("_i"), F.col("fpr").alias("fpr2"), F.col("recall").alias("recall2"),
                        F.col("precision").alias("precision2"))
    inner = here.join(after, "_i").agg(
        F.sum((F.col("fpr2") - F.col("fpr")) * (F.col("recall2") + F.col("recall")) / 2).alias("roc"),
        F.sum((F.col("recall2") - F.col("recall")) * (F.col("precision2") + F.col("precision")) / 2).alias("pr"))
    first = here.where(F.col("_i") == 0).agg(F.max(F.col("fpr") * F.col("recall") / 2).alias("roc"),
                                             F.max(F.col("recall") * F.col("precision")).alias("pr"))
    return inner.unionByName(first).agg(F.sum("roc").alias("area_under_roc"), F.sum("pr").alias("area_under_pr"))


def confusion(df: DataFrame, label: str, prediction: str) -> DataFrame:
    return df.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(F.count(F.lit(1)).alias("n"))


def class_metrics(matrix: DataFrame) -> DataFrame:
    """Precision, recall, F1 and false positive rate per class from a confusion matrix."""
    total = matrix.agg(F.sum("n")).scalar()
    hit = F.sum(F.when(F.col("side") == "both", F.col("n")).otherwise(0))
    sides = F.array(F.struct(F.col("label").alias("cls"), F.lit("label").alias("side")),
                    F.struct(F.col("prediction").alias("cls"), F.lit("prediction").alias("side")),
                    F.struct(F.when(F.col("label") == F.col("prediction"), F.col("label")).alias("cls"), F.lit("both").alias("side")))
    rows = matrix.select("n", F.inline(sides)).where(F.col("cls").isNotNull())
    per = rows.groupBy("cls").agg(
        hit.alias("tp"), F.sum(F.when(F.col("side") == "label", F.col("n")).otherwise(0)).alias("actual"),
        F.sum(F.when(F.col("side") == "prediction", F.col("n")).otherwise(0)).alias("predicted"))
    p = F.coalesce(F.try_divide(F.col("tp"), F.col("predicted")), F.lit(0.0))
    r = F.coalesce(F.try_divide(F.col("tp"), F.col("actual")), F.lit(0.0))
    fpr = F.coalesce(F.try_divide(F.col("predicted") - F.col("tp"), total - F.col("actual")), F.lit(0.0))
    return per.select("cls", "tp", "actual", "predicted", p.alias("precision"), r.alias("recall"),
                      F.coalesce(F.try_divide(2 * p * r, p + r), F.lit(0.0)).alias("f1"), fpr.alias("fpr"))


def weighted_metrics(classes: DataFrame) -> DataFrame:
    """Accuracy and measures weighted by the actual class sizes."""
    n = F.sum("actual")
    weighted = [(F.sum(F.col(m) * F.col("actual")) / n).alias(f"weighted_{m}") for m in ("precision", "recall", "f1", "fpr")]
    return classes.agg((F.sum("tp") / n).alias("accuracy"), *weighted)


def multilabel_metrics(df: DataFrame, predicted: str, actual: str) -> DataFrame:
    """Document-averaged and micro-averaged measures of label sets; empty sets are allowed."""
    both = F.size(F.array_intersect(predicted, actual))
    p, l = F.size(predicted), F.size(actual)
    row = df.select(both.alias("b"), p.alias("p"), l.alias("l"))
    ratio = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    kinds = df.select(F.explode(actual).alias("k")).agg(F.count_distinct("k")).scalar()
    b, p, l = F.col("b"), F.col("p"), F.col("l")
    return row.agg(
        F.count(F.lit(1)).alias("n"), F.avg(ratio(b, p)).alias("precision"), F.avg(ratio(b, l)).alias("recall"),
        F.avg(ratio(2 * b, p + l)).alias("f1"), F.avg(ratio(b, p + l - b)).alias("accuracy"),
        F.avg(((b == p) & (b == l)).cast("double")).alias("subset_accuracy"),
        F.sum(p + l - 2 * b).alias("_wrong"), F.try_divide(F.sum(b), F.sum(p)).alias("micro_precision"),
        F.try_divide(F.sum(b), F.sum(l)).alias("micro_recall"), F.try_divide(2 * F.sum(b), F.sum(p + l)).alias("micro_f1"),
    ).withColumn("hamming_loss", F.col("_wrong") / (F.col("n") * kinds)).drop("_wrong")


def label_metrics(df: DataFrame, predicted: str, actual: str) -> DataFrame:
    """Precision, recall and F1 of each label."""
    union = df.select(F.explode(F.array_union(predicted, actual)).alias("cls"), F.col(predicted).alias("_p"), F.col(actual).alias("_a"))
    inp, ina = F.array_contains("_p", F.col("cls")), F.array_contains("_a", F.col("cls"))
    c = union.groupBy("cls").agg(F.count_if(inp & ina).alias("tp"), F.count_if(inp).alias("p"), F.count_if(ina).alias("a"))
    pr = F.coalesce(F.try_divide("tp", "p"), F.lit(0.0))
    rc = F.coalesce(F.try_divide("tp", "a"), F.lit(0.0))
    return c.select("cls", pr.alias("precision"), rc.alias("recall"),
                    F.coalesce(F.try_divide(2 * pr * rc, pr + rc), F.lit(0.0)).alias("f1"))


def ranking_metrics(ranked: DataFrame, relevant: DataFrame, user: str, item: str, rank: str,
                    cuts: Sequence[int] = (1, 3, 5)) -> DataFrame:
    """precision@k, NDCG@k and mean average precision.

    ``ranked`` holds one row per (user, item) with a rank from 1, ``relevant`` the true items.
    Hits of a user are numbered through a running sum, so long lists may span many tasks.
    """
    truth = relevant.select(user, item).distinct().withColumn("_hit", F.lit(1))
    sizes = truth.groupBy(user).agg(F.count(F.lit(1)).alias("_relevant"))
    marked = (ranked.select(user, item, F.col(rank).alias("_rank")).join(truth, [user, item], "left")
              .select(user, "_rank", F.coalesce("_hit", F.lit(0)).alias("_hit")))
    counted = running_sums(marked, ["_rank"], {"_hits": F.col("_hit")}, keys=[user])
    gain = F.lit(1.0) / F.log2(F.col("_rank") + 1)
    per = counted.groupBy(user).agg(
        F.sum(F.when(F.col("_hit") == 1, F.col("_hits") / F.col("_rank")).otherwise(0.0)).alias("_ap"),
        *[F.sum(F.when((F.col("_rank") <= k), F.col("_hit")).otherwise(0)).alias(f"_h{k}") for k in cuts],
        *[F.sum(F.when((F.col("_rank") <= k) & (F.col("_hit") == 1), gain).otherwise(0.0)).alias(f"_d{k}") for k in cuts])
    joined = per.join(sizes, user, "left").withColumn("_relevant", F.coalesce("_relevant", F.lit(0)))
    ideal = {k: F.aggregate(F.sequence(F.lit(1), F.lit(k)), F.lit(0.0), lambda acc, i: acc + F.when(
        i <= F.col("_relevant"), F.lit(1.0) / F.log2(i + 1)).otherwise(0.0)) for k in cuts}
    return joined.agg(
        F.avg(F.coalesce(F.try_divide("_ap", "_relevant"), F.lit(0.0))).alias("map"),
        *[F.avg(F.col(f"_h{k}") / k).alias(f"precision_{k}") for k in cuts],
        *[F.avg(F.coalesce(F.try_divide(F.col(f"_d{k}"), ideal[k]), F.lit(0.0))).alias(f"ndcg_{k}") for k in cuts])


def regression_metrics(df: DataFrame, label: str, prediction: str, *groups: str) -> DataFrame:
    """MSE, RMSE, MAE, r2 and explained variance, all from one pass."""
    y, p = F.col(label), F.col(prediction)
    sums = df.groupBy(*groups).agg(
        F.count(F.lit(1)).alias("n"), F.avg(F.pow(y - p, 2)).alias("mse"), F.avg(F.abs(y - p)).alias("mae"),
        F.var_pop(y).alias("_vy"), F.avg(y).alias("_my"), F.avg(p).alias("_mp"), F.var_pop(p).alias("_vp"))
    return sums.select(*groups, "n", "mse", F.sqrt("mse").alias("rmse"), "mae", (1 - F.try_divide(F.col("mse"), F.col("_vy"))).alias("r2"),
                       (F.col("_vp") + F.pow(F.col("_mp") - F.col("_my"), 2)).alias("explained_variance"))


def accuracy(df: DataFrame, label: str, prediction: str) -> DataFrame:
    right = F.avg((F.col(label) == F.col(prediction)).cast("double"))
    return df.agg(F.count(F.lit(1)).alias("n"), right.alias("accuracy"), (1 - right).alias("error"))
