"""Evaluation tables over (label, prediction) columns.

Everything is aggregated to the confusion matrix first (classes x classes
rows, a single partial aggregate over the predictions), and the metrics are
computed from that small table, as ``MulticlassMetrics`` does.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def confusion_matrix(pred: DataFrame, label: str = "label",
                     prediction: str = "prediction") -> DataFrame:
    """(label, prediction, n)."""
    return pred.groupBy(F.col(label).alias("label"),
                        F.col(prediction).alias("prediction")).agg(
        F.count(F.lit(1)).alias("n"))


def accuracy(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """(n, accuracy, test_error)."""
    hit = F.when(F.col(label) == F.col(prediction), F.lit(1.0)).otherwise(F.lit(0.0))
    return pred.agg(F.count(F.lit(1)).alias("n"), F.avg(hit).alias("accuracy")).withColumn(
        "test_error", F.lit(1.0) - F.col("accuracy"))


def rmse(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    d = F.col(prediction).cast("double") - F.col(label).cast("double")
    return pred.agg(F.sqrt(F.avg(d * d)).alias("rmse"))


def regression_metrics(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """(n, accuracy, test_error, rmse) in one pass over the predictions."""
    hit = F.when(F.col(label) == F.col(prediction), F.lit(1.0)).otherwise(F.lit(0.0))
    d = F.col(prediction).cast("double") - F.col(label).cast("double")
    return pred.agg(F.count(F.lit(1)).alias("n"), F.avg(hit).alias("accuracy"), F.sqrt(F.avg(d * d)).alias("rmse")).select(
        "n", "accuracy", (F.lit(1.0) - F.col("accuracy")).alias("test_error"), "rmse")


def per_label_metrics(pred: DataFrame, label: str = "label",
                      prediction: str = "prediction") -> DataFrame:
    """(label, n, tp, fp, fn, precision, recall, tpr, fpr, f1) per label
    value present in ``label``; zero denominators give 0."""
    cm = confusion_matrix(pred, label, prediction)
    total = cm.select(F.sum("n")).scalar()
    by_label = cm.groupBy("label").agg(
        F.sum("n").alias("n"),
        F.sum(F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0)).alias("tp"))
    by_pred = cm.groupBy(F.col("prediction").alias("label")).agg(F.sum("n").alias("n_pred"))
    m = by_label.join(by_pred, "label", "left").fillna(0, ["n_pred"])

    def ratio(a, b):
        return F.when(b == 0, F.lit(0.0)).otherwise(a.cast("double") / b)

    tp, n, npred = F.col("tp"), F.col("n"), F.col("n_pred")
    fp, fn = npred - tp, n - tp
    precision, recall = ratio(tp, npred), ratio(tp, n)
    out = m.select("label", "n", "tp", fp.alias("fp"), fn.alias("fn"),
                   precision.alias("precision"), recall.alias("recall"),
                   ratio(fp, total - n).alias("fpr"))
    p, r = F.col("precision"), F.col("recall")
    return out.withColumn("tpr", F.col("recall")).withColumn(
        "f1", F.when(p + r == 0, F.lit(0.0)).otherwise(2 * p * r / (p + r)))


def weighted_metrics(pred: DataFrame, label: str = "label",
                     prediction: str = "prediction") -> DataFrame:
    """One row: accuracy and label-share weighted precision, recall (=TPR),
    FPR and F1, as ``MulticlassMetrics.weighted*``."""
    per = per_label_metrics(pred, label, prediction)
    w = F.col("n") / F.sum("n").over(_all())
    agg = per.select(
        (w * F.col("precision")).alias("wp"), (w * F.col("recall")).alias("wr"),
        (w * F.col("fpr")).alias("wf"), (w * F.col("f1")).alias("w1"),
        F.col("tp"), F.col("n"))
    return agg.agg(
        (F.sum("tp") / F.sum("n")).alias("accuracy"),
        F.sum("wp").alias("weighted_precision"), F.sum("wr").alias("weighted_recall"),
        F.sum("wr").alias("weighted_tpr"), F.sum("wf").alias("weighted_fpr"),
        F.sum("w1").alias("weighted_f1"))


def _all():
    from pyspark.sql import Window
    # The per-label table has one row per class: a global window is bounded.
    return Window.partitionBy()
