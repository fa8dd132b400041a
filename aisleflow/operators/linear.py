"""Margins and objective of fitted linear classifiers over features in long form.

``entries`` are (key, index, value) of the non-zero features, ``coefficients`` (class,
feature_index, value) as ``plans.models.logistic_coefficients`` exports them, with the intercepts at
index -1.  A sparse product is one join by index, in which features of many rows are spread by
their share, and one aggregate by key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aisleflow.operators.skew import ROWS_PER_TASK, share_join


def _classes(coefficients: DataFrame) -> dict[int, float]:
    """Intercept by class: one row a class."""
    return {r["class"]: r["value"] for r in coefficients.filter("feature_index = -1").orderBy("class").collect()}


def _by_index(coefficients: DataFrame, classes) -> DataFrame:
    """(index, b<class>...): one row a feature."""
    own = coefficients.filter("feature_index >= 0").groupBy(F.col("feature_index").alias("index"))
    return own.agg(*[F.sum(F.when(F.col("class") == c, F.col("value")).otherwise(0.0)).alias(f"b{c}") for c in classes])


def margins(rows: DataFrame, entries: DataFrame, coefficients: DataFrame, key: str, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """``rows`` with ``m<class>`` for every class; a binomial model (one row of coefficients) gives the
    margin of class 1 as ``m1`` and 0 as ``m0``."""
    intercepts = _classes(coefficients)
    loads = entries.groupBy("index").agg(F.count(F.lit(1)).alias("load"))
    hits = share_join(entries, _by_index(coefficients, intercepts), ["index"], "load", F.col(key), rows_per_task, loads=loads)
    sums = hits.groupBy(key).agg(*[F.sum(F.col("value") * F.col(f"b{c}")).alias(f"s{c}") for c in intercepts])
    out = rows.join(sums, key, "left")
    own = {c: F.coalesce(F.col(f"s{c}"), F.lit(0.0)) + F.lit(b) for c, b in intercepts.items()}
    own = {0: F.lit(0.0), 1: own[0]} if len(own) == 1 else own
    return out.select(*rows.columns, *[m.alias(f"m{c}") for c, m in own.items()])


def log_loss(scored: DataFrame, label: str = "label") -> DataFrame:
    """(n, loss): mean negative log-likelihood of the labels under the margins of ``scored``."""
    names = [c for c in scored.columns if c.startswith("m") and c[1:].isdigit()]
    top = F.greatest(*[F.col(c) for c in names])
    total = sum((F.exp(F.col(c) - top) for c in names[1:]), F.exp(F.col(names[0]) - top))
    own = F.coalesce(*[F.when(F.col(label) == int(c[1:]), F.col(c)) for c in names])
    return scored.agg(F.count(F.lit(1)).alias("n"), F.avg(F.log(total) + top - own).alias("loss"))


def deviations(entries: DataFrame, n_rows: int) -> DataFrame:
    """(index, deviation): sample standard deviation of each feature over ``n_rows`` rows, those without
    an entry being 0."""
    sums = entries.groupBy("index").agg(F.sum("value").alias("s"), F.sum(F.col("value") * F.col("value")).alias("q"))
    variance = (F.col("q") - F.col("s") * F.col("s") / F.lit(float(n_rows))) / F.lit(float(max(n_rows - 1, 1)))
    return sums.select("index", F.sqrt(F.greatest(variance, F.lit(0.0))).alias("deviation"))


def penalty(coefficients: DataFrame, deviation: DataFrame, reg: float, elastic_net: float) -> DataFrame:
    """(penalty): elastic net over the coefficients of standardised features; intercepts are free."""
    b = F.col("value") * F.col("deviation")
    own = coefficients.filter("feature_index >= 0").join(deviation, F.col("feature_index") == F.col("index"))
    l2, l1 = F.lit(reg * (1 - elastic_net) / 2), F.lit(reg * elastic_net)
    return own.agg(F.coalesce(F.sum(l2 * b * b + l1 * F.abs(b)), F.lit(0.0)).alias("penalty"))


def objective(rows: DataFrame, entries: DataFrame, coefficients: DataFrame, key: str, reg: float, elastic_net: float) -> DataFrame:
    """(n, loss, penalty, objective) of a logistic model over its training rows (key, label)."""
    n = rows.count()
    loss = log_loss(margins(rows, entries, coefficients, key))
    cost = penalty(coefficients, deviations(entries, n), reg, elastic_net)
    return loss.withColumn("penalty", cost.scalar()).withColumn("objective", F.col("loss") + F.col("penalty"))
