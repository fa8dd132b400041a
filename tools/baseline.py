"""

One run each in one session over cached inputs of the same adapters; prints one JSON
line.  Env as for ``bench.py``.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.ml import Pipeline  # noqa: E402
from pyspark.ml.classification import (DecisionTreeClassifier, LinearSVC, LogisticRegression,  # noqa: E402
                                       MultilayerPerceptronClassifier, NaiveBayes)
from pyspark.ml.clustering import LDA, GaussianMixture, KMeans  # noqa: E402
from pyspark.ml.evaluation import ClusteringEvaluator, MulticlassClassificationEvaluator  # noqa: E402
from pyspark.ml.feature import IDF, CountVectorizer, HashingTF, StopWordsRemover, Tokenizer, VectorAssembler  # noqa: E402
from pyspark.ml.fpm import FPGrowth  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from aisleflow.operators import baskets as B  # noqa: E402
from aisleflow.plans import models as M  # noqa: E402
from aisleflow.plans import queries as Q  # noqa: E402
from aisleflow.session import build_session  # noqa: E402


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(f"local[{cpus}]", app="baseline", shuffle_partitions=2 * cpus,
                          extra={"spark.driver.memory": "12g", "spark.sql.files.maxPartitionBytes": str(64 << 20)})
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}

    def timed(name, fn):
        t0 = time.perf_counter()
        out = fn()
        times[name] = round(time.perf_counter() - t0, 3)
        return out

    def cached(df):
        df = df.cache()
        df.count()
        return df

    reviews = cached(Q._review_split(spark, sf))
    train, test = reviews.filter("split = 'train'"), reviews.filter("split = 'test'")
    text = [Tokenizer(inputCol="pr_content", outputCol="w"), HashingTF(inputCol="w", outputCol="tf", numFeatures=1 << 18),
            IDF(inputCol="tf", outputCol="features")]
    accuracy = MulticlassClassificationEvaluator(metricName="accuracy")

    def classify(est):
        return accuracy.evaluate(Pipeline(stages=text + [est]).fit(train).transform(test))

    timed("naive Bayes", lambda: classify(NaiveBayes(**M.NB_PARAMS)))
    timed("logistic", lambda: classify(LogisticRegression(family="multinomial", **M.LOGREG)))
    docs = cached(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", F.col("text").alias("pr_content")))

    def topics():
        words = [text[0], StopWordsRemover(inputCol="w", outputCol="s"), CountVectorizer(inputCol="s", outputCol="features", vocabSize=1 << 20)]
        feats = Pipeline(stages=words).fit(docs).transform(docs).select("features").cache()
        return LDA(seed=1, **M.LDA_PARAMS).fit(feats)
    timed("LDA k=4, 100 iterations", topics)
    points = cached(VectorAssembler(inputCols=Q.PIVOT_FEATURES, outputCol="features").transform(Q.customer_class_pivot(spark, sf)))
    silhouette = ClusteringEvaluator()

    def kmeans(k):
        return silhouette.evaluate(KMeans(seed=1, **{**M.KMEANS, "k": k}).fit(points).transform(points))
    timed("k-means k=4 + silhouette", lambda: kmeans(4))
    timed("k sweep 2..14", lambda: [kmeans(k) for k in M.KMEANS_SWEEP_KS])
    timed("Gaussian mixture", lambda: GaussianMixture(**M.GMM).fit(points))
    clicks = cached(VectorAssembler(inputCols=Q.CLICK_FEATURES, outputCol="features").transform(Q.click_label(spark, sf)))

    def click(est):
        return accuracy.evaluate(est.fit(clicks).transform(clicks))
    timed("decision tree", lambda: click(DecisionTreeClassifier(**M.TREE)))
    timed("linear SVC", lambda: click(LinearSVC(**M.SVC)))
    timed("multilayer perceptron", lambda: click(MultilayerPerceptronClassifier(layers=[19, *M.MLP_HIDDEN, 2], **M.MLP)))
    baskets = cached(Q.brand_baskets(spark, sf))

    def fp():
        m = FPGrowth(itemsCol="items", minSupport=B.MIN_SUPPORT, minConfidence=Q.LOW_CONFIDENCE).fit(baskets)
        return m.associationRules.count(), m.transform(baskets).write.format("noop").mode("overwrite").save()
    timed("FP-growth 1 % + rules + recommendations", fp)
    print(json.dumps({"sf": sf, "cpus": cpus, "seconds": times}))
    spark.stop()


if __name__ == "__main__":
    main()
