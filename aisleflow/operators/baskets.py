"""Market baskets, frequent itemsets, association rules, recommendations.

Baskets are ``collect_set`` per transaction: Spark partially aggregates the
sets inside each map task, so a transaction with a huge share of the rows is
merged from per-task sets and its basket is bounded by the number of
distinct items, not by its row count.  Itemsets and rules come from
``pyspark.ml.fpm.FPGrowth`` (parallel FP-growth: conditional transactions are
shuffled by item group, trees mined per partition).  Recommendations are a
relational plan: a rule meets only the baskets that hold its rarest item.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.ml.fpm import FPGrowth, FPGrowthModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aisleflow.operators.skew import ROWS_PER_TASK, SALTS, share_join, spread_keys
from aisleflow.plans.cache import FIT_PARTITIONS_PER_CORE, adopt, hold_for_fit, let_go

# FP-growth settings of the market-basket job and of its
# RDD-API variant.
MIN_SUPPORT = 0.01
MIN_CONFIDENCE = 0.9
RDD_VARIANT_MIN_SUPPORT = 0.004


def basket_items(sales: DataFrame, items: DataFrame | None = None, *,
                 txn: str = "ss_transaction_id", item: str = "ss_item_id",
                 item_col: str | None = None) -> DataFrame:
    """Distinct (txn, item) pairs.  With ``items`` the sales are joined to
    it first (inner, so unknown items drop out) and ``item_col`` of the item
    table (for example ``i_brand``) can stand for the item."""
    s = sales.filter(F.col(item).isNotNull())
    if items is not None:
        s = s.join(items, s[item] == items["i_item_id"], "inner")
    col = item_col or item
    return s.select(F.col(txn), F.col(col).alias("item")).distinct()


def baskets(sales: DataFrame, items: DataFrame | None = None, *,
            txn: str = "ss_transaction_id", item: str = "ss_item_id",
            item_col: str | None = None) -> DataFrame:
    """(txn, items): sorted distinct items per transaction."""
    s = sales.filter(F.col(item).isNotNull())
    if items is not None:
        s = s.join(items, s[item] == items["i_item_id"], "inner")
    col = item_col or item
    return s.groupBy(txn).agg(F.array_sort(F.collect_set(F.col(col))).alias("items"))


def hold_alike(basket_df: DataFrame, *, txn: str = "ss_transaction_id", items_col: str = "items",
               rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """``basket_df`` cached for ``fit_fp_growth``, equal baskets in one partition.

    Each task of the mining sends a tree of the different baskets that it has met; where equal ones lie
    together, the trees of all tasks hold each basket once.  A basket of more than ``rows_per_task``
    transactions is spread by its number.
    """
    held = hold_for_fit(basket_df)
    loads = held.groupBy(items_col).agg(F.count(F.lit(1)).alias("load"))
    often = F.broadcast(spread_keys(loads, [items_col], "load", rows_per_task))
    salt = F.coalesce(F.pmod(F.xxhash64(txn), F.col(SALTS).cast("long")), F.lit(0))
    n = FIT_PARTITIONS_PER_CORE * basket_df.sparkSession.sparkContext.defaultParallelism
    alike = hold_for_fit(held.join(often, items_col, "left").repartition(n, F.col(items_col), salt).select(*basket_df.columns))
    let_go(held)
    return alike


def fit_fp_growth(basket_df: DataFrame, *, min_support: float = MIN_SUPPORT,
                  min_confidence: float = MIN_CONFIDENCE,
                  num_partitions: int | None = None,
                  items_col: str = "items") -> FPGrowthModel:
    fp = FPGrowth(itemsCol=items_col, minSupport=min_support,
                  minConfidence=min_confidence)
    if num_partitions:
        fp = fp.setNumPartitions(num_partitions)
    model = fp.fit(basket_df.select(items_col))
    return model


def with_min_confidence(model: FPGrowthModel, min_confidence: float) -> FPGrowthModel:
    """Same itemsets, rules filtered at another confidence (no re-fit)."""
    return model.copy({model.minConfidence: min_confidence})


def mined(model: FPGrowthModel) -> FPGrowthModel:
    """The same model with its itemsets cached for the enclosing owner: they are lazy
    behind the model, and itemsets and rules would each mine the baskets again."""
    adopt(model.freqItemsets.persist(StorageLevel.MEMORY_AND_DISK))
    return model


def frequent_itemsets(model: FPGrowthModel) -> DataFrame:
    """(items sorted, size, freq)."""
    return model.freqItemsets.select(F.array_sort("items").alias("items"),
                                     F.size("items").alias("size"), "freq")


def association_rules(model: FPGrowthModel, digits: int = 9) -> DataFrame:
    """(antecedent sorted, consequent, confidence, lift, support)."""
    r = model.associationRules
    return r.select(F.array_sort("antecedent").alias("antecedent"),
                    F.col("consequent")[0].alias("consequent"),
                    F.round("confidence", digits).alias("confidence"),
                    F.round("lift", digits).alias("lift"),
                    F.round("support", digits).alias("support"))


def recommend(basket_df: DataFrame, rules: DataFrame, itemsets: DataFrame, *,
              txn: str = "ss_transaction_id", rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """(txn, prediction): consequents of rules whose antecedent is inside the
    basket, minus items already in it; only baskets with a recommendation.

    ``basket_df``: (txn, items); ``itemsets`` gives the frequency of the single items.
    Each rule is joined to basket rows by the rarest item of its antecedent; whether
    the basket holds the whole antecedent is then checked on its array.  Spark
    broadcasts the rules if they are small; otherwise this is a shuffle join by item, in which
    an item of many baskets is spread by its frequency.
    """
    freq = itemsets.filter(F.size("items") == 1).select(F.col("items")[0].alias("item"), "freq")
    own = rules.select("antecedent", "consequent", F.explode("antecedent").alias("item")).join(freq, "item")
    rarest = own.groupBy("antecedent", "consequent").agg(F.min(F.struct("freq", "item")).alias("least")).select(
        "antecedent", "consequent", F.col("least.item").alias("item"))
    rows = basket_df.select(txn, "items", F.explode("items").alias("item"))
    hits = share_join(rows, rarest, ["item"], "freq", F.col(txn), rows_per_task, loads=freq).filter(
        (F.size(F.array_except("antecedent", "items")) == 0) & ~F.array_contains("items", F.col("consequent")))
    return hits.groupBy(txn).agg(F.array_sort(F.collect_set("consequent")).alias("prediction"))
