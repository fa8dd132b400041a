"""Conditional-count feature pivots (one row per customer, one column per
class or category).

Both pivots are a single hash aggregate: Spark computes all conditional
counts in one pass with a map-side partial aggregate, so a customer holding a
large share of the rows is combined inside each map task before the shuffle
and never lands whole in one reducer.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The purchase classes that get a feature column and the
# category names the segmentation jobs keep (classes 17-20 have no column;
# categories 0 and 16-19 are not kept).
DEFAULT_CLASSES = tuple(range(1, 17))
DEFAULT_CATEGORY_NAMES = (
    "cat#01", "cat#02", "cat#03", "cat#04", "cat#05", "cat#06", "cat#07",
    "cat#08", "cat#09", "cat#10", "cat#11", "cat#12", "cat#13", "cat#14",
    "cat#15",
)
# The category list exactly as the original segmentation query
# wrote it, with "cat#013" (which matches no item) instead of "cat#13".
ORIGINAL_CATEGORY_NAMES = (
    "cat#01", "cat#02", "cat#03", "cat#04", "cat#05", "cat#06", "cat#07",
    "cat#08", "cat#09", "cat#10", "cat#11", "cat#12", "cat#013", "cat#14",
    "cat#15",
)
DEFAULT_CATEGORIES = tuple(range(20))
# Fixed value: click-count threshold on category 0 that labels a customer as
# interested (1.0) or not (0.0).
CLICK_LABEL_THRESHOLD = 3.871510156577754


def class_count_pivot(sales: DataFrame, items: DataFrame, *,
                      classes: Sequence[int] = DEFAULT_CLASSES,
                      category_names: Iterable[str] = DEFAULT_CATEGORY_NAMES,
                      min_rows_exclusive: int = 3,
                      key: str = "ss_customer_id",
                      key_alias: str = "cid") -> DataFrame:
    """Per customer: ``id{c}`` = number of bought lines of class ``c``.

    Only items of the given categories count; customers must have more than
    ``min_rows_exclusive`` such lines over *all* classes (also those without
    a column).  NULL customers are dropped before the join.
    """
    it = (items.filter(F.col("i_category_name").isin(list(category_names)))
          .select("i_item_id", "i_class_id"))
    s = sales.filter(F.col(key).isNotNull()).select(key, "ss_item_id")
    j = s.join(it, s["ss_item_id"] == it["i_item_id"], "inner")
    # One SQL string per aggregate: cheap to build, same plan.
    aggs = [F.expr(f"count(CASE WHEN i_class_id = {int(c)} THEN 1 END) AS id{int(c)}")
            for c in classes]
    return (j.groupBy(key)
            .agg(*aggs, F.count("ss_item_id").alias("_rows"))
            .filter(F.col("_rows") > min_rows_exclusive)
            .select(F.col(key).alias(key_alias), *[f"id{c}" for c in classes]))


def category_click_pivot(clicks: DataFrame, items: DataFrame, *,
                         categories: Sequence[int] = DEFAULT_CATEGORIES,
                         key: str = "wl_customer_id") -> DataFrame:
    """Per customer: ``clicks_in_{c}`` = clicks on items of category ``c``."""
    c = clicks.filter(F.col(key).isNotNull()).select(key, "wl_item_id")
    it = items.filter(F.col("i_category_id").isNotNull()).select(
        "i_item_id", "i_category_id")
    j = c.join(it, c["wl_item_id"] == it["i_item_id"], "inner")
    aggs = [F.expr(f"sum(CASE WHEN i_category_id = {int(n)} THEN 1 ELSE 0 END) AS clicks_in_{int(n)}")
            for n in categories]
    return j.groupBy(key).agg(*aggs)


def threshold_label(df: DataFrame, column: str, threshold, *,
                    label: str = "label") -> DataFrame:
    """Add ``label`` = 1.0 when ``column`` > threshold else 0.0.

    ``threshold`` is a number or a Column (for example a scalar subquery such
    as ``df.select(F.avg(c)).scalar()``).
    """
    thr = threshold if not isinstance(threshold, (int, float)) else F.lit(float(threshold))
    return df.withColumn(label, F.when(F.col(column) > thr, F.lit(1.0)).otherwise(F.lit(0.0)))


def click_label(clicks_pivot: DataFrame, threshold=CLICK_LABEL_THRESHOLD, *,
                source: str = "clicks_in_0",
                key: str = "wl_customer_id") -> DataFrame:
    """Binary interest label from one category's clicks; features are the
    other categories' counts."""
    feats = [c for c in clicks_pivot.columns if c.startswith("clicks_in_") and c != source]
    lab = threshold_label(clicks_pivot, source, threshold)
    return lab.select(key, "label", *feats)


def click_label_by_mean(clicks_pivot: DataFrame, *, source: str = "clicks_in_0",
                        key: str = "wl_customer_id") -> DataFrame:
    """As :func:`click_label` with the threshold = mean of ``source``.

    The mean is a scalar subquery: Spark runs it as its own small aggregate
    and inlines the value, no join with the big side.
    """
    mean = clicks_pivot.select(F.avg(source)).scalar()
    return click_label(clicks_pivot, mean, source=source, key=key)
