"""Exact, distributed evaluation of a score column against a 0/1 label.

Predictions are first collapsed to one row per distinct score with the count of
positives ``p`` and negatives ``n`` (partial aggregation: a score shared by a
third of the rows is one row after the map side). Curves and AUC then need
running sums over the score order, which come from the range-partitioned
prefix operator instead of a single-task global window. AUC keeps one row per
range and group of them, so nothing of the data's size is stored.

AUC is tie-aware: sum over scores of p * (negatives below + n/2) / (P * N),
the same as ``BinaryClassificationEvaluator(numBins=0)``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickspark.operators.prefix import prefix_sums, range_sums


def score_counts(pred: DataFrame, label: str, score, group: Sequence[str] = ()) -> DataFrame:
    s = F.col(score) if isinstance(score, str) else score
    y = F.col(label)
    return (pred.select(*group, s.cast("double").alias("score"), y.alias("_y"))
                .where(F.col("score").isNotNull())
                .groupBy(*group, "score")
                .agg(F.count_if(F.col("_y") == 1).cast("double").alias("p"),
                     F.count_if(F.col("_y") != 1).cast("double").alias("n")))


def auc_exact(pred: DataFrame, label: str, score, group: Sequence[str] = (),
              partitions: int | None = None) -> DataFrame:
    """(group..., auc, n_pos, n_neg); auc is null when a class is absent.

    A positive beats the negatives of its own range that are below it and all
    negatives of earlier ranges: each range gives its own sum, and the table of
    ranges (at most partitions x groups rows) adds the rest."""
    counts = score_counts(pred, label, score, group)
    local = range_sums(counts, [F.col("score").asc()], ["n"], group, partitions)
    inside = F.col("p") * (F.col("_lc_n") - 0.5 * F.col("n"))
    ranges = local.groupBy("_pid", *group).agg(F.sum(inside).alias("_s"), F.sum("p").alias("_p"), F.sum("n").alias("_n"))
    earlier = Window.partitionBy(*group).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.withColumn("_below", F.coalesce(F.sum("_n").over(earlier), F.lit(0.0)))
    return (ranges.groupBy(*group)
               .agg(F.sum(F.col("_s") + F.col("_p") * F.col("_below")).alias("_s"),
                    F.sum("_p").alias("P"), F.sum("_n").alias("N"))
               .select(*group,
                       F.when((F.col("P") > 0) & (F.col("N") > 0), F.col("_s") / (F.col("P") * F.col("N")))
                        .alias("auc"),
                       F.col("P").cast("bigint").alias("n_pos"), F.col("N").cast("bigint").alias("n_neg")))


def roc_curve(pred: DataFrame, label: str, score, partitions: int | None = None,
              with_origin: bool = True) -> DataFrame:
    """(threshold, fpr, tpr): one point per distinct score, descending; plus (0, 0)."""
    counts = score_counts(pred, label, score)
    run = prefix_sums(counts, [F.col("score").desc()], ["p", "n"], (), partitions)
    pts = run.select(F.col("score").alias("threshold"),
                     F.try_divide(F.col("cum_n"), F.col("total_n")).alias("fpr"),
                     F.try_divide(F.col("cum_p"), F.col("total_p")).alias("tpr"))
    if with_origin:
        origin = pred.sparkSession.createDataFrame([(None, 0.0, 0.0)], "threshold double, fpr double, tpr double")
        pts = origin.unionByName(pts)
    return pts


def pr_curve(pred: DataFrame, label: str, score, partitions: int | None = None) -> DataFrame:
    """(threshold, recall, precision): one point per distinct score, descending."""
    counts = score_counts(pred, label, score)
    run = prefix_sums(counts, [F.col("score").desc()], ["p", "n"], (), partitions)
    return run.select(F.col("score").alias("threshold"),
                      F.try_divide(F.col("cum_p"), F.col("total_p")).alias("recall"),
                      F.try_divide(F.col("cum_p"), F.col("cum_p") + F.col("cum_n")).alias("precision"))


def confusion_matrix(pred: DataFrame, label: str, prediction: str = "prediction",
                     weight: str | None = None) -> DataFrame:
    """(label, prediction, n); with ``weight``, n is the sum of row weights (double)."""
    n = F.sum(F.col(weight).cast("double")) if weight else F.count(F.lit(1))
    return (pred.groupBy(F.col(label).cast("int").alias("label"), F.col(prediction).cast("int").alias("prediction"))
                .agg(n.alias("n")))


def weighted_metrics(pred: DataFrame, label: str, prediction: str = "prediction",
                     weight: str | None = None) -> DataFrame:
    """(metric, value): accuracy and label-frequency-weighted precision, recall,
    F1, false- and true-positive rate, from the confusion table (at most
    classes^2 rows, so everything after the first aggregate is tiny). With
    ``weight`` every count is a sum of row weights, as in MLlib's weighted
    training summaries."""
    cm = confusion_matrix(pred, label, prediction, weight)
    per_label = cm.groupBy(F.col("label").alias("c")).agg(F.sum("n").alias("n_c"),
                                                          F.sum(F.when(F.col("label") == F.col("prediction"),
                                                                       F.col("n")).otherwise(0)).alias("tp"))
    per_pred = cm.groupBy(F.col("prediction").alias("c")).agg(F.sum("n").alias("pred_c"))
    t = per_label.join(per_pred, "c", "left").fillna(0, ["pred_c"])
    # t has one row per class: a window over it is a window over <= classes rows
    t = t.withColumn("N", F.sum("n_c").over(Window.partitionBy()))
    prec = F.when(F.col("pred_c") > 0, F.col("tp") / F.col("pred_c")).otherwise(0.0)
    rec = F.when(F.col("n_c") > 0, F.col("tp") / F.col("n_c")).otherwise(0.0)
    f1 = F.when(prec + rec > 0, 2 * prec * rec / (prec + rec)).otherwise(0.0)
    fpr = F.when(F.col("N") - F.col("n_c") > 0,
                 (F.col("pred_c") - F.col("tp")) / (F.col("N") - F.col("n_c"))).otherwise(0.0)
    w = F.try_divide(F.col("n_c"), F.col("N"))
    agg = t.agg(F.try_divide(F.sum("tp"), F.max("N")).alias("accuracy"),
                F.sum(w * prec).alias("weighted_precision"),
                F.sum(w * rec).alias("weighted_recall"),
                F.sum(w * f1).alias("weighted_f1"),
                F.sum(w * fpr).alias("weighted_fpr"),
                F.sum(w * rec).alias("weighted_tpr"))
    names = ["accuracy", "weighted_precision", "weighted_recall", "weighted_f1", "weighted_fpr", "weighted_tpr"]
    return agg.select(F.explode(F.array(*[F.struct(F.lit(n).alias("metric"), F.col(n).alias("value"))
                                           for n in names])).alias("m")).select("m.*")


def top_confident_negatives(pred: DataFrame, key: Sequence[str], prob0, n: int = 10,
                            prediction: str = "prediction", columns: Sequence[str] = ()) -> DataFrame:
    """The ``n`` rows predicted negative with the highest class-0 probability
    (a top-k: partial top-n per partition, then one merge of n rows each)."""
    p0 = F.col(prob0) if isinstance(prob0, str) else prob0
    return (pred.where(F.col(prediction) == 0)
                .select(*key, *columns, p0.alias("prob_neg"), F.col(prediction))
                .orderBy(F.col("prob_neg").desc(), *[F.col(k).asc() for k in key])
                .limit(n))
