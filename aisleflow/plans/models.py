"""Model fits through ``pyspark.ml`` with every output exported as a
DataFrame.

Inputs are cached (MEMORY_AND_DISK) around the iterative fits by their owner (see
:mod:`aisleflow.plans.cache`), which releases them; a lost executor recomputes its blocks from the short lineage
(parquet scan -> features).  Model-sized values (centres, weights,
coefficients, summaries) already live on the driver in ``pyspark.ml`` and
are turned into small DataFrames; per-row outputs (assignments,
predictions, topic mixes) stay distributed.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.ml.classification import (DecisionTreeClassifier, LinearSVC,
                                       LogisticRegression,
                                       MultilayerPerceptronClassifier, NaiveBayes)
from pyspark.ml.clustering import LDA, GaussianMixture, KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import (IDF, HashingTF, StopWordsRemover, Tokenizer,
                                VectorAssembler)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aisleflow.functions.gamma import special
from aisleflow.operators import text, topics
from aisleflow.operators.skew import ROWS_PER_TASK, share_join
from aisleflow.plans.cache import collect_garbage, hold, hold_for_fit, in_few_partitions, let_go, owned
from aisleflow.sources import vectors as vec

# Model settings of the nine jobs.
KMEANS = dict(k=4, initSteps=5, maxIter=20, tol=0.01)
KMEANS_SWEEP_KS = tuple(range(2, 15))
GMM = dict(k=2, tol=0.01, seed=538009335)
LDA_PARAMS = dict(k=4, maxIter=100)
NB_PARAMS = dict(smoothing=1.0, modelType="multinomial")
LOGREG = dict(maxIter=10, regParam=0.1, elasticNetParam=0.00001)
TREE = dict(maxDepth=7, maxBins=32)
SVC = dict(maxIter=10, regParam=0.001, tol=0.01, aggregationDepth=2)
MLP = dict(maxIter=100, blockSize=1000, seed=1234138471039)
MLP_HIDDEN = (5,)
DEFAULT_SEED = 1234138471039


def assemble(df: DataFrame, columns: Sequence[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(columns), outputCol=out).transform(df)


# --- clustering -----------------------------------------------------------------

def fit_kmeans(vectors: DataFrame, *, seed: int = DEFAULT_SEED, **overrides):
    """The estimator is given the vectors alone, a frame that is not itself held, and so keeps them as objects over its passes.
    Of a held frame it keeps the norms alone, and each pass would take the vectors out of the cache's rows again."""
    params = {**KMEANS, **overrides}
    return KMeans(featuresCol="features", predictionCol="prediction", seed=seed,
                  **params).fit(vectors.select("features"))


def kmeans_centers(spark: SparkSession, model, features: Sequence[str],
                   digits: int = 6) -> DataFrame:
    rows = [(i, f, float(v)) for i, c in enumerate(model.clusterCenters())
            for f, v in zip(features, c)]
    return spark.createDataFrame(rows, "cluster int, feature string, value double").withColumn(
        "value", F.round("value", digits))


def silhouette_of(predictions: DataFrame) -> float:
    return ClusteringEvaluator(featuresCol="features", predictionCol="prediction",
                               distanceMeasure="squaredEuclidean").evaluate(predictions)


def kmeans_quality(spark: SparkSession, model, vectors: DataFrame) -> DataFrame:
    s = model.summary
    sil = silhouette_of(model.transform(vectors))
    return spark.createDataFrame(
        [(model.getK(), float(sil), float(s.trainingCost), int(s.numIter))],
        "k int, silhouette double, training_cost double, num_iter int")


def chosen_k(sweep: DataFrame) -> DataFrame:
    """(k, silhouette) of the highest silhouette, ties to the smallest k."""
    best = F.max_by(F.struct("k", "silhouette"), F.struct("silhouette", -F.col("k"))).alias("b")
    return sweep.agg(best).select("b.k", "b.silhouette")


def kmeans_sweep(spark: SparkSession, vectors: DataFrame,
                 ks: Sequence[int] = KMEANS_SWEEP_KS, seed: int = DEFAULT_SEED) -> DataFrame:
    """(k, silhouette, training_cost, chosen): one fit per k over one
    cached input; ``chosen`` marks the k of highest silhouette."""
    with owned():
        v = hold_for_fit(vectors)
        rows = []
        for k in ks:
            m = fit_kmeans(v, seed=seed, k=k)
            rows.append((k, float(silhouette_of(m.transform(v))), float(m.summary.trainingCost)))
            m.summary.cluster.unpersist()
    sweep = spark.createDataFrame(rows, "k int, silhouette double, training_cost double")
    best = chosen_k(sweep).select(F.col("k").alias("best"))
    return sweep.join(F.broadcast(best), F.col("k") == F.col("best"), "left").select(
        "k", "silhouette", "training_cost", F.col("best").isNotNull().alias("chosen"))


def fit_gmm(vectors: DataFrame, **overrides):
    params = {**GMM, **overrides}
    return GaussianMixture(featuresCol="features", **params).fit(vectors)


def gmm_components(spark: SparkSession, model) -> DataFrame:
    rows = []
    for i, (w, g) in enumerate(zip(model.weights, model.gaussians)):
        rows.append((i, float(w), [float(x) for x in g.mean.toArray()],
                     [float(x) for x in np.asarray(g.cov.toArray()).ravel()]))
    return spark.createDataFrame(
        rows, "component int, weight double, mean array<double>, cov array<double>")


def gmm_summary(spark: SparkSession, model) -> DataFrame:
    s = model.summary
    return spark.createDataFrame(
        [(int(s.k), float(s.logLikelihood), int(s.numIter))],
        "k int, log_likelihood double, num_iter int")


# --- text models --------------------------------------------------------------------

# The topic model over hashed TF-IDF.
LDA_HASHED = dict(k=3, maxIter=10)
LDA_HASHED_TERMS = 3


def words_of(text_col: str):
    return [Tokenizer(inputCol=text_col, outputCol="tokens"),
            StopWordsRemover(inputCol="tokens", outputCol="words")]


@dataclass
class TopicModel:
    """Fitted topics: the numbered vocabulary and the topics over its numbers, both as tables."""

    vocabulary: DataFrame    # term, term_index, freq, doc_freq
    width: int               # terms in the vectors
    lda: topics.TopicTable

    def features(self, docs: DataFrame, key: str, text_col: str, packs: DataFrame | None = None) -> DataFrame:
        """(key, features) of every document with a text; terms unknown to the model drop out.  ``packs``: the
        ``packed_counts`` of ``docs``, for a caller that has more than one model read them."""
        if packs is None:
            packs = packed_counts(docs, word_counts(docs, key, text_col), key, text_col)
        return pack_vectors(packs, docs, self.vocabulary, self.width, key)

    def transform(self, docs: DataFrame, key: str, text_col: str, packs: DataFrame | None = None) -> DataFrame:
        """(key, topic, share) of raw documents."""
        return lda_doc_topics(self.lda, self.features(docs, key, text_col, packs), key)

    def save(self, path: str) -> str:
        self.vocabulary.write.mode("overwrite").parquet(f"{path}/vocabulary")
        self.lda.save(f"{path}/lda")
        return path

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "TopicModel":
        lda = topics.TopicTable.load(spark, f"{path}/lda")
        return cls(spark.read.parquet(f"{path}/vocabulary"), lda.vocabSize(), lda)


def word_counts(docs: DataFrame, key: str, text_col: str) -> DataFrame:
    """(key, term, tf) without stop words."""
    return text.term_frequencies(text.remove_stop_words(text.token_rows(docs, key, text_col, positions=False)), key)


def packed_counts(docs: DataFrame, tf: DataFrame, key: str, text_col: str) -> DataFrame:
    """``text.packed`` of the counts ``tf``, with a vector wanted for every document with a text."""
    packs = text.packed(tf, docs.filter(F.col(text_col).isNotNull()), key)
    collect_garbage(docs.sparkSession)
    return packs


def term_vectors(docs: DataFrame, tf: DataFrame, vocabulary: DataFrame, width: int, key: str, text_col: str) -> DataFrame:
    """(key, features): counts at the terms' numbers, for every document with a text, whose key must be its own.

    The numbers are joined to the terms of each pack of documents; the vocabulary is not gathered anywhere."""
    return pack_vectors(packed_counts(docs, tf, key, text_col), docs, vocabulary, width, key)


def pack_vectors(packs: DataFrame, docs: DataFrame, vocabulary: DataFrame, width: int, key: str) -> DataFrame:
    """``term_vectors`` of the documents ``docs`` from their ``packed_counts``."""
    vectors = vec.to_vectors(text.pack_vectors(packs, vocabulary, width, docs.schema[key]), "features")
    collect_garbage(docs.sparkSession)
    return vectors


def fit_topics(docs: DataFrame, key: str, text_col: str, vocab_size: int | None = None, *,
               max_bytes: int | None = None, seed: int = DEFAULT_SEED, **overrides) -> tuple[TopicModel, DataFrame, int]:
    """(model, features, number of terms in all): LDA over the counts of the ``vocab_size`` most frequent
    terms, or of all.  The topics lie over the cluster; a caller that means to gather them names ``max_bytes``, and
    more topics x terms doubles than that raise an error before the fit."""
    params = {**LDA_PARAMS, **overrides}
    packs = packed_counts(docs, word_counts(docs, key, text_col), key, text_col)
    vocabulary = text.term_vocabulary(text.pack_terms(packs))
    n_terms = vocabulary.count()
    width = max(1, min(n_terms, vocab_size or n_terms))
    if max_bytes is not None and params["k"] * width * 8 > max_bytes:
        raise ValueError(f"{params['k']} topics x {width} terms would be {params['k'] * width * 8} bytes on the driver, above "
                         f"{max_bytes}; bound vocab_size, use hashed_lda_features, or raise max_bytes")
    vocabulary = vocabulary.filter(F.col("term_index") < width)
    features = pack_vectors(packs, docs, vocabulary, width, key)  # read from files; the fit holds what it reads again
    lda = topics.fit(features, key, width, lda_estimator(seed=seed, **overrides))
    collect_garbage(docs.sparkSession)
    return TopicModel(vocabulary, width, lda), features, n_terms


def lda_estimator(*, seed: int = DEFAULT_SEED, **overrides) -> LDA:
    return LDA(featuresCol="features", seed=seed, **{**LDA_PARAMS, **overrides})


def fit_lda(features: DataFrame, **overrides):
    """The library's own fit, which keeps topics x terms doubles on the driver: for vectors of a bounded width."""
    return lda_estimator(**overrides).fit(features)


def hashed_lda_features(docs: DataFrame, key: str, text_col: str, num_features: int = 1 << 18):
    """(key, features): hashed TF-IDF, of one width whatever the vocabulary; held for the innermost owner."""
    docs = docs.filter(F.col(text_col).isNotNull()).select(key, text_col)
    return in_few_partitions(fit_tfidf(docs, text_col, words_of(text_col), num_features)[1]).select(key, "features")


def fit_tfidf(docs: DataFrame, text_col: str, word_stages: Sequence, num_features: int, is_train=None) -> tuple[PipelineModel, DataFrame]:
    """(stages, frame): word stages -> HashingTF -> IDF fitted on the rows of ``is_train`` (a condition on columns beside
    the text; default: all), and ``docs`` with their ``features`` in place of the text, held for the innermost owner in as many
    partitions as the texts came in; a fit reads them by ``in_few_partitions``.

    The counts are held before the IDF is fitted, so that each text is read, moved and cut into words once."""
    counting = PipelineModel(stages=[*word_stages, HashingTF(inputCol="words", outputCol="raw", numFeatures=num_features)])
    counts = hold(counting.transform(docs).select(*[c for c in docs.columns if c != text_col], "raw"))
    few = in_few_partitions(counts)
    idf = IDF(inputCol="raw", outputCol="features").fit(few if is_train is None else few.filter(is_train))
    features = hold(idf.transform(counts).drop("raw"))
    let_go(counts)
    return PipelineModel(stages=[*counting.stages, idf]), features


def topic_terms(lda, max_terms: int) -> DataFrame:
    """(topic, rank, term_index, weight)."""
    if isinstance(lda, topics.TopicTable):
        return lda.describe(max_terms)
    return lda.describeTopics(max_terms).select(
        "topic", F.posexplode(F.arrays_zip("termIndices", "termWeights")).alias("rank", "tw")).select(
        "topic", "rank", F.col("tw.termIndices").alias("term_index"), F.col("tw.termWeights").alias("weight"))


def lda_topics(model: TopicModel, max_terms: int = 10) -> DataFrame:
    """(topic, rank, term, weight): the numbers of k x ``max_terms`` terms are joined to their names."""
    return topic_terms(model.lda, max_terms).join(model.vocabulary.select("term_index", "term"), "term_index").select(
        "topic", "rank", "term", "weight")


def lda_doc_topics(lda, features: DataFrame, key: str) -> DataFrame:
    if isinstance(lda, topics.TopicTable):
        return lda.doc_topics(features, key)
    return lda.transform(features).select(key, F.posexplode(vector_to_array("topicDistribution")).alias("topic", "share"))


def lda_topic_table(spark: SparkSession, lda, per: int = 1 << 16) -> tuple[DataFrame, float]:
    """((term_index, log_beta), topics' part of the bound): the expected logarithm of each term's weight in every
    topic, from the model's matrix on the driver, and the part of the bound that no document changes."""
    import pyarrow as pa
    digamma, log_gamma = special()
    weights = lda.topicsMatrix().toArray()  # terms x topics, not normalised
    width, k = weights.shape
    eta = lda.getTopicConcentration() if lda.isSet("topicConcentration") else 1.0 / k
    total = weights.sum(axis=0)
    log_beta = np.empty_like(weights)
    bound = float((log_gamma(np.full(k, eta * width)) - log_gamma(total)).sum())
    for lo in range(0, width, per):
        w = weights[lo:lo + per]
        log_beta[lo:lo + per] = digamma(w) - digamma(total)
        bound += float(((eta - w) * log_beta[lo:lo + per]).sum() + (log_gamma(w) - log_gamma(np.full(1, eta))).sum())
    rows = pa.table({"term_index": pa.array(np.arange(width)),
                     "log_beta": pa.ListArray.from_arrays(pa.array(np.arange(0, (width + 1) * k, k, dtype=np.int32)), pa.array(log_beta.ravel()))})
    return spark.createDataFrame(rows, "term_index long, log_beta array<double>"), bound


def lda_bound(spark: SparkSession, lda, features: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> tuple[float, float]:
    """(bound, words): the variational lower bound of the log-likelihood of ``features``, and their number of words.

    What ``LDAModel.logLikelihood`` computes, but that takes the exponential of the whole topic matrix again for each
    document.  Here the documents' topics are inferred once, by ``transform``, and each entry of a document is joined
    to its term's row of the topics, in which a term of many documents is spread by their number."""
    if isinstance(lda, topics.TopicTable):
        return lda.bound(features)
    table, bound = lda_topic_table(spark, lda)
    alpha = [float(a) for a in lda.estimatedDocConcentration().toArray()]
    shares = lda.transform(features).select("features", vector_to_array("topicDistribution").alias("share"))
    docs = vec.to_parts(shares, "features").filter(F.size("features.values") > 0)
    words = F.aggregate("features.values", F.lit(0.0), lambda a, x: a + x)
    docs = docs.withColumn("words", words).withColumn("gamma", F.transform("share", lambda s: s * (F.col("words") + sum(alpha))))
    # the terms of the bound that depend on the document alone, then those of its entries
    own = dirichlet_rows(docs.select("features", "words", "gamma"), alpha)
    whole = own.agg(F.sum("words").alias("n"), F.sum("own").alias("own")).first()
    entries = vec.entries(own, "log_theta", "features").withColumn("term_index", F.col("index").cast("long"))
    loads = vec.entries(docs, "words", "features").groupBy(F.col("index").cast("long").alias("term_index")).agg(F.count(F.lit(1)).alias("doc_freq"))
    joined = share_join(entries, table, ["term_index"], "doc_freq", F.col("log_theta"), rows_per_task, loads=loads)
    logs = F.zip_with("log_theta", "log_beta", lambda a, b: a + b)
    of_entries = joined.select("value", logs.alias("x")).withColumn("top", F.array_max("x")).agg(F.sum(
        F.col("value") * (F.col("top") + F.log(F.aggregate(F.transform("x", lambda x: F.exp(x - F.col("top"))), F.lit(0.0), lambda a, x: a + x)))).alias("s")).first()["s"]
    return bound + float(whole["own"] or 0.0) + float(of_entries or 0.0), float(whole["n"] or 0.0)


def dirichlet_rows(docs: DataFrame, alpha: Sequence[float]) -> DataFrame:
    """``docs`` with ``log_theta``, the expected logarithms of the shares under Dirichlet(``gamma``), and ``own``, the
    document's part of the bound, in place of ``gamma``."""
    digamma, log_gamma = special()
    prior = np.asarray(alpha, dtype=float)
    prior_part = float(log_gamma(prior.sum()) - log_gamma(prior).sum())

    @F.pandas_udf("log_theta array<double>, own double")
    def both(gamma: pd.Series) -> pd.DataFrame:
        g = np.stack(gamma.to_numpy()).astype(float) if len(gamma) else np.zeros((0, len(prior)))
        total = g.sum(axis=1)
        log_theta = digamma(g) - digamma(total)[:, None]
        own = ((prior - g) * log_theta).sum(axis=1) + log_gamma(g).sum(axis=1) - log_gamma(total) + prior_part
        return pd.DataFrame({"log_theta": list(log_theta), "own": own})

    return docs.withColumn("d", both("gamma")).select(*[c for c in docs.columns if c != "gamma"], "d.log_theta", "d.own")


def lda_quality(spark: SparkSession, lda, features: DataFrame, n_terms: int) -> DataFrame:
    """Bound of the log-likelihood, and perplexity: its negative for each word.  ``terms_left_out``: terms of the
    corpus beyond the vocabulary bound."""
    bound, words = lda_bound(spark, lda, features)
    v = int(lda.vocabSize())
    return spark.createDataFrame([(bound, -bound / words if words else float("nan"), v, int(n_terms) - v)],
                                 "log_likelihood double, log_perplexity double, vocab_size int, terms_left_out long")


def fit_text_features(data: DataFrame, text_col: str, is_train, num_features: int = 1 << 18) -> tuple[PipelineModel, DataFrame]:
    """(stages, frame): Tokenizer -> HashingTF -> IDF fitted on the rows of ``is_train`` alone, and
    ``data`` with their ``features`` in place of the text, held for the innermost owner."""
    return fit_tfidf(data.filter(F.col(text_col).isNotNull()), text_col, [Tokenizer(inputCol=text_col, outputCol="words")],
                     num_features, is_train)


def text_features(data: DataFrame, text_col: str, is_train) -> DataFrame:
    return fit_text_features(data, text_col, is_train)[1]


def text_pipeline(stages: PipelineModel, classifier) -> PipelineModel:
    """One fitted pipeline from raw text to a prediction: the feature stages and the classifier
    that was fitted on their vectors."""
    return PipelineModel(stages=[*stages.stages, classifier])


def score_texts(model: PipelineModel, texts: DataFrame, key: str, text_col: str) -> DataFrame:
    """(key, prediction, probability) of raw texts; a null text counts as the empty one."""
    own = texts.select(key, F.coalesce(F.col(text_col), F.lit("")).alias(model.stages[0].getInputCol()))
    return model.transform(own).select(key, "prediction", vector_to_array("probability").alias("probability"))


def naive_bayes_estimator(**overrides):
    return NaiveBayes(**{**NB_PARAMS, **overrides})


def logistic_estimator(family: str = "multinomial", **overrides):
    """``family="auto"`` is binomial for two classes, multinomial for more."""
    return LogisticRegression(family=family, **{**LOGREG, **overrides})


def prediction_scores(predictions: DataFrame, key: str, probability: bool = True) -> DataFrame:
    """(key, label, prediction, class, raw, probability): the scores behind each
    prediction; without ``probability`` (margin classifiers) that column is left out."""
    parts = {"raw": vector_to_array("rawPrediction")}
    if probability:
        parts["probability"] = vector_to_array("probability")
    rows = predictions.select(key, "label", "prediction", F.posexplode(F.arrays_zip(*[c.alias(n) for n, c in parts.items()])).alias("class", "s"))
    return rows.select(key, "label", "prediction", "class", *[F.col(f"s.{n}").alias(n) for n in parts])


def logistic_coefficients(spark: SparkSession, lr_model) -> DataFrame:
    """(class, feature_index, value): non-zero coefficients (sparse long
    form, bounded by classes x features) plus intercepts at index -1.  A binomial model
    has one row of coefficients."""
    dense = lr_model.coefficientMatrix.toArray()
    cls, feat = np.nonzero(dense)
    icpt = lr_model.interceptVector.toArray()
    pdf = pd.DataFrame({
        "class": np.concatenate([cls, np.arange(len(icpt))]).astype("int32"),
        "feature_index": np.concatenate([feat, np.full(len(icpt), -1)]).astype("int32"),
        "value": np.concatenate([dense[cls, feat], icpt]).astype("float64")})
    # Arrow transfer of a model-sized table (classes x features at most).
    return spark.createDataFrame(pdf, "class int, feature_index int, value double")


def logistic_facts(spark: SparkSession, lr_model) -> DataFrame:
    rows = [("num_classes", float(lr_model.numClasses)), ("num_features", float(lr_model.numFeatures)),
            ("coefficient_rows", float(lr_model.coefficientMatrix.numRows)), ("iterations", float(lr_model.summary.totalIterations))]
    return spark.createDataFrame(rows, "name string, value double")


def logistic_history(spark: SparkSession, lr_model) -> DataFrame:
    h = lr_model.summary.objectiveHistory
    return spark.createDataFrame([(i, float(v)) for i, v in enumerate(h)],
                                 "iteration int, objective double")


def logistic_train_metrics(spark: SparkSession, lr_model) -> DataFrame:
    s = lr_model.summary
    vals = [("accuracy", s.accuracy), ("weighted_fpr", s.weightedFalsePositiveRate),
            ("weighted_tpr", s.weightedTruePositiveRate), ("weighted_f1", s.weightedFMeasure()),
            ("weighted_precision", s.weightedPrecision), ("weighted_recall", s.weightedRecall)]
    return spark.createDataFrame([(k, float(v)) for k, v in vals], "metric string, value double")


def logistic_label_metrics(spark: SparkSession, lr_model) -> DataFrame:
    s = lr_model.summary
    labels = s.labels
    rows = [(float(l), float(a), float(b), float(c), float(d), float(e))
            for l, a, b, c, d, e in zip(labels, s.falsePositiveRateByLabel,
                                        s.truePositiveRateByLabel, s.precisionByLabel,
                                        s.recallByLabel, s.fMeasureByLabel())]
    return spark.createDataFrame(
        rows, "label double, fpr double, tpr double, precision double, recall double, f1 double")


# --- click-interest classifiers ---------------------------------------------------

def fit_tree(train: DataFrame, **overrides):
    return DecisionTreeClassifier(labelCol="label", featuresCol="features",
                                  **{**TREE, **overrides}).fit(train)


def tree_nodes(spark: SparkSession, model) -> DataFrame:
    """The node table (node, parent, depth, is_leaf, feature, threshold, gain,
    impurity, prediction), in preorder; a left child is the node after its parent."""
    rows: list[tuple] = []
    todo = [(model._call_java("rootNode"), None, 0)]
    while todo:
        node, parent, depth = todo.pop()
        at, leaf = len(rows), node.subtreeDepth() == 0
        split = None if leaf else node.split()
        categorical = split is not None and split.getClass().getSimpleName() == "CategoricalSplit"
        rows.append((at, parent, depth, leaf, None if leaf else int(split.featureIndex()),
                     None if leaf or categorical else float(split.threshold()),
                     None if leaf else float(node.gain()), float(node.impurity()), float(node.prediction())))
        if not leaf:
            todo += [(node.rightChild(), at, depth + 1), (node.leftChild(), at, depth + 1)]
    return spark.createDataFrame(rows, "node int, parent int, depth int, is_leaf boolean, feature int, "
                                       "threshold double, gain double, impurity double, prediction double")


def tree_text(spark: SparkSession, model) -> DataFrame:
    """(line, text): the model's printed form."""
    return spark.createDataFrame(list(enumerate(model.toDebugString.splitlines())), "line int, text string")


def tree_facts(spark: SparkSession, model) -> DataFrame:
    rows = [("num_nodes", float(model.numNodes)), ("depth", float(model.depth)),
            ("num_features", float(model.numFeatures)), ("num_classes", float(model.numClasses))]
    facts = spark.createDataFrame(rows, "name string, value double")
    root = tree_nodes(spark, model).filter("node = 0 AND NOT is_leaf")
    return facts.unionByName(root.select(F.expr(
        "stack(2, 'root_feature', CAST(feature AS DOUBLE), 'root_threshold', threshold) AS (name, value)")))


def tree_importances(spark: SparkSession, model, features: Sequence[str]) -> DataFrame:
    imp = model.featureImportances.toArray()
    return spark.createDataFrame([(f, float(v)) for f, v in zip(features, imp)],
                                 "feature string, importance double")


def fit_svc(train: DataFrame, **overrides):
    if train.select("label").distinct().limit(2).count() < 2:
        raise ValueError("LinearSVC needs both classes (0 and 1) in the training data")
    return LinearSVC(labelCol="label", featuresCol="features", **{**SVC, **overrides}).fit(train)


def svc_coefficients(spark: SparkSession, model, features: Sequence[str]) -> DataFrame:
    rows = [(f, float(v)) for f, v in zip(features, model.coefficients.toArray())]
    rows.append(("intercept", float(model.intercept)))
    return spark.createDataFrame(rows, "feature string, value double").withColumn(
        "value", F.when(F.col("feature") == "intercept", F.round("value", 8)).otherwise(F.col("value")))


def fit_mlp(train: DataFrame, n_features: int, n_classes: int, *,
            hidden: Sequence[int] = MLP_HIDDEN, **overrides):
    layers = [n_features, *hidden, n_classes]
    return MultilayerPerceptronClassifier(labelCol="label", featuresCol="features",
                                          layers=layers, **{**MLP, **overrides}).fit(train)
