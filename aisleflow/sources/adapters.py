"""Adapters giving the driver's test tables the shapes the retail jobs read.

| job table        | built from                                              |
| ---------------- | ------------------------------------------------------- |
| items            | part: id = p_partkey, category = p_partkey % 20,        |
|                  | class = (p_size - 1) % 20 + 1, brand = p_brand          |
| store_sales      | lineitem JOIN orders: transaction = l_orderkey,         |
|                  | customer = o_custkey, item = l_partkey                  |
| clicks           | events: customer = user_id, item = JSON $.k of props    |
| product_reviews  | documents JOIN labels: rating from quality / toxic      |

All are projections and joins Catalyst can prune and push filters through;
nothing is materialised here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aisleflow.sources.tables import by_key, table, texts_by_key

N_CATEGORIES = 20
N_CLASSES = 20


def category_name(cat: Column) -> Column:
    """``cat#NN`` label of a category id (two digits, zero padded)."""
    return F.concat(F.lit("cat#"), F.lpad(cat.cast("string"), 2, "0"))


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    cat = (F.col("p_partkey") % N_CATEGORIES).cast("int")
    return p.select(
        F.col("p_partkey").alias("i_item_id"),
        cat.alias("i_category_id"),
        category_name(cat).alias("i_category_name"),
        ((F.col("p_size") - 1) % N_CLASSES + 1).cast("int").alias("i_class_id"),
        F.col("p_brand").alias("i_brand"),
    )


def store_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per sold line.  The order join is a shuffle join on the order
    key for large inputs; AQE splits a hot order if one exists."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return li.join(o, li.l_orderkey == o.o_orderkey, "inner").select(
        F.col("l_orderkey").alias("ss_transaction_id"),
        F.col("o_custkey").alias("ss_customer_id"),
        F.col("l_partkey").alias("ss_item_id"),
    )


def sales_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``store_sales`` without the customer: (transaction, item) straight
    from lineitem.  Jobs that never read the customer (baskets) use this and
    skip the order join, the largest shuffle of ``store_sales``."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(F.col("l_orderkey").alias("ss_transaction_id"),
                     F.col("l_partkey").alias("ss_item_id"))


def click_rows(events: DataFrame) -> DataFrame:
    """Web clicks with the item id pulled out of the event's JSON text."""
    return events.select(
        F.col("event_id").alias("wl_id"),
        F.col("user_id").alias("wl_customer_id"),
        F.get_json_object("props", "$.k").cast("bigint").alias("wl_item_id"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("wl_timestamp"),
    )


def clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return click_rows(table(spark, sf_dir, "events"))


def review_rating(quality: Column, toxic: Column, doc_id: Column) -> Column:
    """Star rating 1-5 derived from the quality / toxicity labels."""
    return (F.when((quality == 0) & (toxic == 1), F.lit(1))
            .when(quality == 0, F.lit(2))
            .when(toxic == 1, F.lit(3))
            .otherwise((F.lit(4) + doc_id % 2).cast("int")))


def product_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rated reviews with whole texts: the documents that have labels."""
    d = by_key(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")
    lab = table(spark, sf_dir, "labels")
    j = d.join(lab, "doc_id", "inner")
    return j.select(
        F.col("doc_id").alias("pr_review_id"),
        review_rating(F.col("quality"), F.col("toxic"), F.col("doc_id")).cast("int").alias("pr_rating"),
        F.col("text").alias("pr_content"),
    )


def review_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``product_reviews`` without the text: no text leaves the scan."""
    j = table(spark, sf_dir, "documents").select("doc_id").join(table(spark, sf_dir, "labels"), "doc_id", "inner")
    return j.select(
        F.col("doc_id").alias("pr_review_id"),
        review_rating(F.col("quality"), F.col("toxic"), F.col("doc_id")).cast("int").alias("pr_rating"))


def review_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every review text, rated or not, partitioned by review."""
    d = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("pr_review_id"), F.col("text").alias("pr_content"))
    return texts_by_key(d, "pr_review_id", "pr_content")
