"""Multinomial naive Bayes over long-form features, as joins and aggregates.

Same estimates as ``pyspark.ml.classification.NaiveBayes`` (multinomial):

    pi_c      = ln(n_c + l) - ln(N + l * C)
    theta_cj  = ln(S_cj + l) - ln(S_c + l * V)

with n_c documents of class c among N, C classes present, S_cj the summed
feature value of term j in class c, S_c = sum_j S_cj and V the number of
features (distinct training terms).  Terms never seen with class c share
``theta_unseen_c = ln(l) - ln(S_c + l * V)``, so the likelihood table holds
only observed (class, term) pairs instead of classes x vocabulary.

Scoring: score_c = pi_c + theta_unseen_c * sum_j x_j
                         + sum_{j seen in c} x_j * (theta_cj - theta_unseen_c).
The per-class constants (C rows) are the only values taken to the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aisleflow.operators.skew import ROWS_PER_TASK, share_join
from aisleflow.plans.cache import hold

# More classes than this are taken for a wrong label column.
MAX_CLASSES = 1000


@dataclass
class NaiveBayesTwin:
    priors: DataFrame        # label, n_docs, pi, theta_unseen
    likelihoods: DataFrame   # label, term, theta, delta
    wide: DataFrame          # term, d0 .. d{C-1}: theta - theta_unseen per class
    classes: list            # sorted class labels
    constants: dict          # label -> (pi, theta_unseen)


def fit(features: DataFrame, labels: DataFrame, *, key: str,
        smoothing: float = 1.0) -> NaiveBayesTwin:
    """``features``: (key, term, x) of training documents, optionally with
    the document's ``label`` already attached (then no join is needed);
    ``labels``: (key, label), one row per training document (documents
    without features count in the priors).  Sums per (class, term) are combined in every
    task before the shuffle, so a term of all documents sends one row a task and class."""
    lam = F.lit(float(smoothing))
    n_c = labels.groupBy("label").agg(F.count(F.lit(1)).alias("n_docs"))
    lf = features if "label" in features.columns else features.join(labels, key, "inner")
    # One row per (class, term): the model itself, kept for the steps below.
    s_cj = hold(lf.groupBy("label", "term").agg(F.sum("x").alias("s_cj")))
    s_c_rows = s_cj.groupBy("label").agg(F.sum("s_cj").alias("s_c")).limit(MAX_CLASSES + 1).collect()
    v = s_cj.select("term").distinct().count()
    s_c = {r["label"]: r["s_c"] for r in s_c_rows}
    pri = n_c.limit(MAX_CLASSES + 1).collect()
    if len(pri) > MAX_CLASSES:
        raise ValueError(f"more than {MAX_CLASSES} distinct labels")
    lam_v, n_docs = float(smoothing), {r["label"]: r["n_docs"] for r in pri}
    n_total, n_classes = sum(n_docs.values()), len(n_docs)
    constants = {}
    for c, n in n_docs.items():
        pi = math.log(n + lam_v) - math.log(n_total + lam_v * n_classes)
        t0 = math.log(lam_v) - math.log(s_c.get(c, 0.0) + lam_v * v)
        constants[c] = (pi, t0)
    classes = sorted(constants)
    spark = features.sparkSession
    priors = spark.createDataFrame(
        [(float(c), int(n_docs[c]), constants[c][0], constants[c][1]) for c in classes],
        "label double, n_docs long, pi double, theta_unseen double")
    denom = {c: F.lit(float(s_c.get(c, 0.0)) + lam_v * v) for c in classes}
    den_col = t0_col = None
    for c in classes:
        cond = F.col("label") == F.lit(c)
        den_col = F.when(cond, denom[c]) if den_col is None else den_col.when(cond, denom[c])
        t0 = F.lit(constants[c][1])
        t0_col = F.when(cond, t0) if t0_col is None else t0_col.when(cond, t0)
    theta = F.log(F.col("s_cj") + lam) - F.log(den_col)
    lik = s_cj.select("label", "term", theta.alias("theta"),
                      (theta - t0_col).alias("delta"))
    wide = lik.groupBy("term").agg(*[
        F.max(F.when(F.col("label") == F.lit(c), F.col("delta"))).alias(f"d{i}")
        for i, c in enumerate(classes)])
    return NaiveBayesTwin(priors, lik, wide, classes, constants)


def scores(model: NaiveBayesTwin, docs: DataFrame, features: DataFrame, *,
           key: str, weights: DataFrame | None = None, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """(key, score_<i> per class i, prediction) for every row of ``docs``.

    ``features`` (key, term, x) are matched to the model's per-term table in one join, in which
    terms of many rows are spread by their share, and summed per document.  With ``weights`` (term, w; for example the
    IDF) a feature counts ``x * w``; the weights join the per-term table, not the
    rows.  Terms outside the training vocabulary drop out.  Documents
    without any such term score on the priors alone.
    """
    wide = model.wide
    x = F.col("x")
    if weights is not None:
        wide = wide.join(weights, "term", "inner")
        x = x * F.col("w")
    loads = features.groupBy("term").agg(F.count(F.lit(1)).alias("load"))
    f = share_join(features, wide, ["term"], "load", F.col(key), rows_per_task, loads=loads).withColumn("x", x)
    k = len(model.classes)
    per_doc = f.groupBy(key).agg(
        F.sum("x").alias("xsum"),
        *[F.sum(F.col("x") * F.coalesce(F.col(f"d{i}"), F.lit(0.0))).alias(f"_s{i}")
          for i in range(k)])
    out = docs.select(key).join(per_doc, key, "left")
    cols = []
    for i, c in enumerate(model.classes):
        pi, t0 = model.constants[c]
        cols.append((F.lit(pi) + F.lit(t0) * F.coalesce("xsum", F.lit(0.0))
                     + F.coalesce(f"_s{i}", F.lit(0.0))).alias(f"score_{i}"))
    out = out.select(key, *cols)
    best = F.greatest(*[F.col(f"score_{i}") for i in range(k)]) if k > 1 else F.col("score_0")
    pred = None
    for i, c in enumerate(model.classes):      # ascending: ties -> lowest label
        cond = F.col(f"score_{i}") == best
        pred = F.when(cond, F.lit(c)) if pred is None else pred.when(cond, F.lit(c))
    return out.withColumn("prediction", pred)
