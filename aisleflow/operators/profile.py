"""Column profile (count, mean, sample stddev, min, max) and value histogram."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def column_profile(df: DataFrame, columns: Sequence[str], digits: int = 4) -> DataFrame:
    """Long form of ``describe``: one row per column, typed numbers.

    One aggregate pass computes every statistic of every column (partial
    aggregation on the map side); the unpivot runs on the single result row.
    """
    aggs = []
    for c in columns:
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"{c}__n"), F.avg(x).alias(f"{c}__mean"),
                 F.stddev_samp(x).alias(f"{c}__sd"), F.min(x).alias(f"{c}__min"),
                 F.max(x).alias(f"{c}__max")]
    one = df.agg(*aggs)
    parts = ", ".join(
        f"'{c}', `{c}__n`, round(`{c}__mean`, {digits}), round(`{c}__sd`, {digits}), "
        f"`{c}__min`, `{c}__max`" for c in columns)
    return one.selectExpr(
        f"stack({len(columns)}, {parts}) AS (column_name, count, mean, stddev, min, max)")


def value_histogram(df: DataFrame, column: str) -> DataFrame:
    """(value, n): rows per distinct value of ``column``."""
    return df.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
