"""Texts are dealt by their bytes, so that a task's words don't grow with the input."""

from __future__ import annotations

from pyspark.sql import functions as F

from aisleflow.sources import tables


def test_each_partition_holds_a_bounded_share_of_the_texts(spark, monkeypatch):
    monkeypatch.setattr(tables, "TEXT_BYTES_PER_TASK", 1000)
    docs = spark.range(400).select(F.col("id"), F.when(F.col("id") % 7 > 0, F.repeat(F.lit("word "), 20)).alias("text"))
    docs = docs.unionByName(spark.sql("SELECT CAST(NULL AS BIGINT) AS id, 'no key' AS text"))
    dealt = tables.texts_by_key(docs, "id", "text")
    sizes = [r[0] for r in dealt.groupBy(F.spark_partition_id()).agg(F.sum(F.octet_length("text"))).collect()]
    assert len(sizes) > 25 and max(sizes) < 4000  # 34 kB in 35 partitions, not in the session's 4
    assert dealt.exceptAll(docs).count() == docs.exceptAll(dealt).count() == 0


def test_small_or_no_texts_stay_with_adaptive_execution(spark):
    for docs in (spark.createDataFrame([(1, "a b"), (2, None)], "id long, text string"), spark.createDataFrame([], "id long, text string")):
        assert tables.texts_by_key(docs, "id", "text").count() == docs.count()
