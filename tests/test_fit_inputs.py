"""What the fits read, and how often."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import IDF, HashingTF, Tokenizer
from pyspark.sql import functions as F

from aisleflow.plans import cache
from aisleflow.plans import models as M


def test_kmeans_keeps_its_vectors_over_its_passes(spark, monkeypatch):
    held = M.assemble(spark.range(60).selectExpr("id", "id % 7 AS a", "id % 3 AS b"), ["a", "b"]).persist()
    given, fit = [], KMeans.fit
    monkeypatch.setattr(KMeans, "fit", lambda self, data: given.append(data) or fit(self, data))
    try:
        model = M.fit_kmeans(held, k=3)
        assert not given[0].storageLevel.useMemory and given[0].columns == ["features"]  # else the estimator keeps norms alone
        cost = fit(KMeans(featuresCol="features", seed=M.DEFAULT_SEED, **{**M.KMEANS, "k": 3}), held).summary.trainingCost
        assert abs(model.summary.trainingCost - cost) < 1e-9
        assert model.transform(held).columns == ["id", "a", "b", "features", "prediction"]
    finally:
        held.unpersist()


def _texts(spark, seen):
    @F.udf("string")
    def read(x):
        seen.add(1)
        return x

    rows = spark.range(0, 40, 1, 4).select("id", F.when(F.col("id") % 9 > 0, F.expr("concat_ws(' ', 'w' || id % 5, 'the', 'w' || id % 3)")).alias("t"),
                                           (F.col("id") % 2).cast("double").alias("label"))
    return rows.select("id", "label", read.asNondeterministic()("t").alias("text"))


def test_each_text_is_read_once_for_its_features(spark):
    seen = spark.sparkContext.accumulator(0)
    docs, is_train = _texts(spark, seen), F.col("label") == 1
    with cache.owned() as owner:
        stages, data = M.fit_text_features(docs, "text", is_train, 64)
        got = {r["id"]: (r["label"], r["features"]) for r in data.collect()}
        assert seen.value == 40 and data.columns == ["id", "label", "features"]
        assert owner.frames == [data]  # the counts are released
    assert not data.storageLevel.useMemory
    whole = docs.filter("text IS NOT NULL")
    plain = Pipeline(stages=[Tokenizer(inputCol="text", outputCol="words"), HashingTF(inputCol="words", outputCol="raw", numFeatures=64),
                             IDF(inputCol="raw", outputCol="features")]).fit(whole.filter(is_train))
    assert got == {r["id"]: (r["label"], r["features"]) for r in plain.transform(whole).collect()}
    assert got == {r["id"]: (r["label"], r["features"]) for r in stages.transform(whole).collect()}


def test_text_features_are_held_as_they_came_and_read_by_fits_in_few_partitions(spark):
    """Joined partitions that are stored again take memory that Spark doesn't count, more the larger they are."""
    most = cache.FIT_PARTITIONS_PER_CORE * spark.sparkContext.defaultParallelism
    docs = spark.range(0, 400, 1, 3 * most).selectExpr("id", "concat_ws(' ', 'w' || id % 5, 'v' || id % 3) AS text")
    with cache.owned() as owner:
        features = M.hashed_lda_features(docs, "id", "text", 64)
        assert [f.rdd.getNumPartitions() for f in owner.frames] == [3 * most]
        assert features.rdd.getNumPartitions() == most and features.count() == 400


def test_each_text_is_read_once_for_hashed_topics(spark):
    seen = spark.sparkContext.accumulator(0)
    docs = _texts(spark, seen)
    with cache.owned():
        got = {r["id"]: r["features"] for r in M.hashed_lda_features(docs, "id", "text", 64).collect()}
        assert seen.value == 40
    whole = docs.filter("text IS NOT NULL")
    plain = Pipeline(stages=M.words_of("text") + [HashingTF(inputCol="words", outputCol="raw", numFeatures=64),
                                                  IDF(inputCol="raw", outputCol="features")]).fit(whole)
    assert got == {r["id"]: r["features"] for r in plain.transform(whole).collect()}
