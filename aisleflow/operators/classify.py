"""Classification helpers in relational form: label index, categorical
feature detection and the value -> index map of categorical features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


# More classes than this are taken for a wrong label column.
MAX_CLASSES = 100_000


def label_index(df: DataFrame, column: str, *, order: str = "frequencyDesc") -> DataFrame:
    """(label, label_index, n): the StringIndexer mapping.

    ``frequencyDesc``: most frequent first, ties alphabetical;
    ``alphabetAsc``: alphabetical.  The window runs over the distinct labels only (one row per
    class after the aggregate); more than ``MAX_CLASSES`` raise an error.
    """
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(
        F.count(F.lit(1)).alias("n")).limit(MAX_CLASSES + 1)  # no window sees more; one too many raises
    many = F.count(F.lit(1)).over(Window.partitionBy(F.lit(0)))
    if order == "frequencyDesc":
        w = Window.orderBy(F.desc("n"), F.asc(column))
    elif order == "alphabetAsc":
        w = Window.orderBy(F.asc(column))
    else:
        raise ValueError(order)
    ok = F.assert_true(many <= MAX_CLASSES, f"more than {MAX_CLASSES} distinct labels").isNull()
    return counts.select(F.col(column).alias("label"),
                         (F.row_number().over(w) - 1).cast("double").alias("label_index"),
                         "n", ok.alias("ok")).filter("ok").drop("ok")


def categorical_features(df: DataFrame, columns: Sequence[str],
                         max_categories: int = 20) -> DataFrame:
    """(feature, n_distinct, is_categorical): VectorIndexer's decision, a
    feature is categorical when it has at most ``max_categories`` values."""
    long = df.select(F.lit(1).alias("_k"), *columns).unpivot(
        ["_k"], list(columns), "feature", "value")
    per = long.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("_c"))
    return (per.groupBy("feature").agg(F.count(F.lit(1)).alias("n_distinct"))
            .withColumn("is_categorical", F.col("n_distinct") <= F.lit(max_categories)))


def categorical_map(df: DataFrame, columns: Sequence[str],
                    max_categories: int = 20) -> DataFrame:
    """(feature, value, category_index) of the categorical features: VectorIndexer's
    map, values in order with 0 first if it occurs.  A window sees at most
    ``max_categories`` rows of a feature."""
    long = df.select(F.lit(1).alias("_k"), *columns).unpivot(
        ["_k"], list(columns), "feature", "value")
    values = long.filter(F.col("value").isNotNull()).groupBy("feature", "value").agg(F.count(F.lit(1)).alias("_c"))
    few = values.groupBy("feature").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") <= max_categories).select("feature")
    w = Window.partitionBy("feature").orderBy(F.col("value") != 0, "value")
    return values.join(few, "feature").select(
        "feature", F.col("value").cast("double").alias("value"), (F.row_number().over(w) - 1).cast("int").alias("category_index"))
