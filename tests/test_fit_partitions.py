"""Inputs of iterative fits lie in a bounded number of partitions."""

from __future__ import annotations

from aisleflow.plans import cache


def test_a_fit_reads_few_partitions_however_many_the_rows_came_in(spark):
    most = cache.FIT_PARTITIONS_PER_CORE * spark.sparkContext.defaultParallelism
    with cache.owned() as owner:
        many = cache.hold_for_fit(spark.range(0, 5000, 1, 20 * most))
        assert many.rdd.getNumPartitions() == most and many.storageLevel.useMemory
        assert owner.frames == [many]  # the frame in many partitions is released
        assert many.count() == 5000 and many.selectExpr("sum(id)").first()[0] == 4999 * 2500
        few = cache.hold_for_fit(spark.range(0, 50, 1, most))
        assert few.rdd.getNumPartitions() == most and few.count() == 50
    assert not many.storageLevel.useMemory


def test_shared_vectors_are_in_few_partitions(spark, sf):
    from aisleflow.plans import queries as Q
    most = cache.FIT_PARTITIONS_PER_CORE * spark.sparkContext.defaultParallelism
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 8 * most)
    try:
        cache.clear()
        for frame in (Q._vectors(spark, sf), Q._click_vectors(spark, sf, 6)):
            assert frame.rdd.getNumPartitions() <= most
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        cache.clear()
