"""Rows brought through an exported decision tree, and its nodes recomputed from them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_children(nodes: DataFrame) -> DataFrame:
    """The node table (in preorder, so a left child is the smaller number) with ``left`` and ``right``."""
    child = nodes.filter("parent IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(
        F.min(nodes["node"]).alias("left"), F.max(nodes["node"]).alias("right"))
    return nodes.join(child, "node", "left")


def route(rows: DataFrame, nodes: DataFrame, features: Sequence[str]) -> DataFrame:
    """``rows`` with ``path``: the nodes from the root to the leaf, one join with the node table for each level.

    Continuous splits only: a row goes left if its feature is not above the threshold."""
    table = with_children(nodes).filter("NOT is_leaf").select(F.col("node").alias("at"), "feature", "threshold", "left", "right")
    depth = int(nodes.agg(F.max("depth")).first()[0])
    out = rows.withColumn("at", F.lit(0)).withColumn("path", F.array(F.lit(0)))
    value = F.element_at(F.array(*[F.col(f).cast("double") for f in features]), F.col("feature") + 1)
    for _ in range(depth):
        step = F.when(value <= F.col("threshold"), F.col("left")).otherwise(F.col("right"))
        out = out.join(table, "at", "left").withColumn("at", F.when(F.col("feature").isNull(), F.col("at")).otherwise(step)).withColumn(
            "path", F.when(F.col("feature").isNull(), F.col("path")).otherwise(F.concat("path", F.array("at")))).drop(
            "feature", "threshold", "left", "right")
    return out.drop("at")


def node_statistics(rows: DataFrame, nodes: DataFrame, features: Sequence[str], labels: Sequence[float], label: str = "label") -> DataFrame:
    """The node table with ``n``, ``own_impurity``, ``own_prediction`` and (of inner nodes) ``own_gain`` recomputed from
    ``rows``: gini over the counts of ``labels``, majority with ties to the lowest label."""
    held = route(rows, nodes, features).select(F.explode("path").alias("node"), label)
    counts = held.groupBy("node").agg(F.count(F.lit(1)).alias("n"), *[
        F.sum((F.col(label) == v).cast("long")).alias(f"n{i}") for i, v in enumerate(labels)])
    per = [F.col(f"n{i}") for i in range(len(labels))]
    share = [c / F.col("n") for c in per]
    gini = F.lit(1.0) - sum((s * s for s in share[1:]), share[0] * share[0])
    most = F.greatest(*per) if len(per) > 1 else per[0]
    prediction = F.coalesce(*[F.when(c == most, F.lit(float(v))) for c, v in zip(per, labels)])
    stats = counts.select("node", "n", gini.alias("own_impurity"), prediction.alias("own_prediction"))
    part = lambda side: stats.select(F.col("node").alias(side), F.col("n").alias(f"n_{side}"), F.col("own_impurity").alias(f"i_{side}"))
    out = with_children(nodes).join(stats, "node", "left").join(part("left"), "left", "left").join(part("right"), "right", "left")
    n = F.col("n")
    gain = F.col("own_impurity") - F.col("n_left") / n * F.col("i_left") - F.col("n_right") / n * F.col("i_right")
    return out.select(*nodes.columns, "n", "own_impurity", "own_prediction", gain.alias("own_gain"))
