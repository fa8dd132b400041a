import math

import numpy as np
from pyspark.ml.classification import NaiveBayes
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import IDF, CountVectorizer
from pyspark.sql import functions as F

from aisleflow.operators import bayes, evaluate as ev, text


def test_twin_equals_spark_naive_bayes(spark):
    docs = spark.createDataFrame(
        [(1, "good great fine", 2.0), (2, "bad awful", 0.0), (3, "good fine ok", 2.0),
         (4, "meh ok", 1.0), (5, "awful bad bad", 0.0), (6, "ok meh fine", 1.0)],
        "doc_id long, text string, label double")
    tok = text.token_rows(docs)
    tf = text.term_frequencies(tok)
    idf = text.term_idf(tf, docs)
    x = tf.join(idf, "term").select("doc_id", "term", (F.col("tf") * F.col("idf")).alias("x"))
    twin = bayes.fit(x, docs.select("doc_id", "label"), key="doc_id", smoothing=1.0)
    # Same feature space in pyspark.ml: CountVectorizer vocabulary + IDF.
    words = docs.select("doc_id", "label", F.split("text", " ").alias("w"))
    cv = CountVectorizer(inputCol="w", outputCol="tf").fit(words)
    feats = IDF(inputCol="tf", outputCol="features").fit(cv.transform(words)).transform(cv.transform(words))
    m = NaiveBayes(smoothing=1.0, modelType="multinomial").fit(feats)
    pi = {r["label"]: r["pi"] for r in twin.priors.collect()}
    for i, lab in enumerate(sorted(pi)):
        assert math.isclose(pi[lab], float(m.pi[i]), rel_tol=1e-12)
    theta = m.theta.toArray()
    got = {(r["label"], r["term"]): r["theta"] for r in twin.likelihoods.collect()}
    unseen = {r["label"]: r["theta_unseen"] for r in twin.priors.collect()}
    for ci, lab in enumerate(sorted(pi)):
        for j, term in enumerate(cv.vocabulary):
            want = theta[ci, j]
            assert math.isclose(got.get((lab, term), unseen[lab]), want, rel_tol=1e-9)
    # predictions on the training docs agree with the model's
    sc = {r["doc_id"]: r["prediction"] for r in bayes.scores(twin, docs, x, key="doc_id").collect()}
    ref = {r["doc_id"]: r["prediction"] for r in m.transform(feats).collect()}
    assert sc == ref
    # the IDF as weights of the per-term table gives the same scores
    weighted = bayes.scores(twin, docs, tf.withColumnRenamed("tf", "x"), key="doc_id", weights=idf.select("term", F.col("idf").alias("w")))
    plain = {r["doc_id"]: r["score_0"] for r in bayes.scores(twin, docs, x, key="doc_id").collect()}
    assert all(math.isclose(r["score_0"], plain[r["doc_id"]], rel_tol=1e-9) for r in weighted.collect())


def _pred(spark):
    # three classes; class 2 is never predicted
    rows = [(0.0, 0.0), (0.0, 0.0), (0.0, 1.0), (1.0, 1.0), (1.0, 0.0),
            (1.0, 1.0), (2.0, 0.0), (2.0, 1.0), (2.0, 1.0)]
    return spark.createDataFrame(rows, "label double, prediction double")


def test_metrics_equal_spark_evaluator(spark):
    p = _pred(spark)
    acc = ev.accuracy(p).first()
    e = MulticlassClassificationEvaluator()
    assert math.isclose(acc["accuracy"], e.evaluate(p, {e.metricName: "accuracy"}))
    assert math.isclose(acc["test_error"], 1 - acc["accuracy"])
    w = ev.weighted_metrics(p).first()
    for mine, name in [("weighted_precision", "weightedPrecision"),
                       ("weighted_recall", "weightedRecall"),
                       ("weighted_fpr", "weightedFalsePositiveRate"),
                       ("weighted_f1", "f1")]:
        assert math.isclose(w[mine], e.evaluate(p, {e.metricName: name}), abs_tol=1e-12), mine
    per = {r["label"]: r for r in ev.per_label_metrics(p).collect()}
    assert per[2.0]["precision"] == 0.0 and per[2.0]["f1"] == 0.0     # zero denominators
    for lab, r in per.items():
        for mine, name in [("precision", "precisionByLabel"), ("recall", "recallByLabel"),
                           ("fpr", "falsePositiveRateByLabel"), ("f1", "fMeasureByLabel")]:
            ref = e.evaluate(p, {e.metricName: name, e.metricLabel: lab})
            assert math.isclose(r[mine], ref, abs_tol=1e-12), (lab, mine)
    cm = {(r["label"], r["prediction"]): r["n"] for r in ev.confusion_matrix(p).collect()}
    assert cm[(2.0, 1.0)] == 2 and sum(cm.values()) == 9
    rm = ev.rmse(p).first()["rmse"]
    assert math.isclose(rm, math.sqrt(np.mean([(a - b) ** 2 for a, b in
                                               [(r[0], r[1]) for r in p.collect()]])))


def test_query_fits_on_sums_by_class_and_not_on_rows_of_documents(spark, sf, monkeypatch):
    from aisleflow.functions.split import hash_bucket
    from aisleflow.plans import cache, queries as Q
    seen = []
    fit = bayes.fit
    monkeypatch.setattr(bayes, "fit", lambda features, labels, **kw: seen.append(features) or fit(features, labels, **kw))
    cache.clear()
    Q.nb_pipeline(spark, sf)
    assert seen[0].columns == ["label", "term", "x"]
    assert seen[0].groupBy("label", "term").count().where("count > 1").count() == 0
    # the same sums as over the documents' own rows
    reviews = Q._reviews(spark, sf)
    from aisleflow.functions import labels as L
    docs = reviews.select("pr_review_id", L.rating_label(F.col("pr_rating"), L.RATING_TO_BAYES).alias("label"), "pr_content").where(
        F.col("label").isNotNull() & (hash_bucket(F.col("pr_review_id")) < 6))
    tf = text.term_frequencies(text.token_rows(docs, "pr_review_id", "pr_content", positions=False), "pr_review_id")
    rows = text.weigh(tf, text.term_idf(tf, docs, "pr_review_id"), "pr_review_id").join(docs.select("pr_review_id", "label"), "pr_review_id")
    want = rows.groupBy("label", "term").agg(F.sum(F.col("tf") * F.col("idf")).alias("want"))
    both = seen[0].join(want, ["label", "term"], "full")
    assert both.where("x is null or want is null or abs(x - want) > 1e-9 * (1 + want)").count() == 0 and both.count() > 1000
    cache.clear()
