"""Gini split table: the impurity gain of every candidate threshold of every
continuous feature, the quantity a decision tree maximises at its root.

Candidate thresholds are midpoints of consecutive distinct values (what
``DecisionTreeClassifier`` uses when a feature has fewer distinct values than
bins).  Plan: unpivot the features, aggregate to (feature, value) class
counts (map-side combined), then prefix sums in two levels: a feature's values are cut into
``RANGES`` ranges at approximate quantiles; windows run over the sums of the ranges and over the values
of one range.  Where the cuts lie changes the work, not the result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


RANGES = 64


def _gini(n: str, counts: list[str]) -> str:
    s = " + ".join(f"({c} / {n}) * ({c} / {n})" for c in counts)
    return f"(CASE WHEN {n} = 0 THEN 0.0D ELSE 1.0D - ({s}) END)"


def gini_splits(df: DataFrame, features: Sequence[str], classes: Sequence[float],
                label: str = "label", digits: int = 9) -> DataFrame:
    """(feature, feature_index, threshold, n_left, n_right, gain)."""
    k = len(classes)
    long = df.select(label, *features).unpivot([label], list(features), "feature", "value")
    per = long.groupBy("feature", "value").agg(
        F.expr("count(1) AS n"),
        *[F.expr(f"sum(CASE WHEN `{label}` = {float(c)!r}D THEN 1 ELSE 0 END) AS _c{i}")
          for i, c in enumerate(classes)])
    cuts = F.percentile_approx("value", [i / RANGES for i in range(1, RANGES)], 1000).alias("cuts")
    bounds = per.groupBy("feature").agg(cuts)  # one row a feature
    per = per.join(F.broadcast(bounds), "feature").withColumn(
        "part", F.size(F.filter("cuts", lambda c: c < F.col("value")))).drop("cuts")
    counts = ["n"] + [f"_c{i}" for i in range(k)]
    sums = per.groupBy("feature", "part").agg(F.min("value").alias("first"), *[F.sum(c).alias(c) for c in counts])
    up = "OVER (PARTITION BY feature ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    whole = "OVER (PARTITION BY feature)"
    sums = sums.selectExpr("feature", "part", "lead(first) OVER (PARTITION BY feature ORDER BY part) AS next_first",
                           *[f"coalesce(sum({c}) {up}, 0) AS before{c}" for c in counts],
                           *[f"sum({c}) {whole} AS total{c}" for c in counts])  # at most RANGES rows a feature
    run = "OVER (PARTITION BY feature, part ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    per = per.selectExpr("feature", "part", "value", "lead(value) OVER (PARTITION BY feature, part ORDER BY value) AS next_value",
                         *[f"sum({c}) {run} AS run{c}" for c in counts])
    t = per.join(F.broadcast(sums), ["feature", "part"]).selectExpr(
        "feature", "value", "coalesce(next_value, next_first) AS next_value",
        "beforen + runn AS nl", "totaln AS nt",
        *[f"before_c{i} + run_c{i} AS l{i}" for i in range(k)],
        *[f"total_c{i} AS t{i}" for i in range(k)],
    ).filter("next_value IS NOT NULL")
    nl, nt, nr = "CAST(nl AS DOUBLE)", "CAST(nt AS DOUBLE)", "CAST(nt - nl AS DOUBLE)"
    g_parent = _gini(nt, [f"CAST(t{i} AS DOUBLE)" for i in range(k)])
    g_left = _gini(nl, [f"CAST(l{i} AS DOUBLE)" for i in range(k)])
    g_right = _gini(nr, [f"CAST(t{i} - l{i} AS DOUBLE)" for i in range(k)])
    gain = f"{g_parent} - ({nl} / {nt}) * {g_left} - ({nr} / {nt}) * {g_right}"
    fidx = "CASE feature " + " ".join(
        f"WHEN '{f}' THEN {i}" for i, f in enumerate(features)) + " END"
    return t.selectExpr(
        "feature", f"CAST({fidx} AS INT) AS feature_index",
        "(CAST(value AS DOUBLE) + CAST(next_value AS DOUBLE)) / 2 AS threshold",
        "nl AS n_left", "nt - nl AS n_right", f"round({gain}, {digits}) AS gain")


def best_split(splits: DataFrame) -> DataFrame:
    """The single best (feature, threshold): highest gain, ties to the lowest
    feature index then threshold (a top-1 over the split table)."""
    return splits.orderBy(F.desc("gain"), "feature_index", "threshold").limit(1)
