import math

import pytest
from pyspark.sql import functions as F

from aisleflow.operators import tree
from aisleflow.plans import models as M
from aisleflow.plans import queries as Q


def test_gini_best_equals_tree_root(spark, sf):
    cl = Q.click_label(spark, sf)
    best = tree.best_split(tree.gini_splits(cl, Q.CLICK_FEATURES, [0.0, 1.0])).first()
    v = M.assemble(cl, Q.CLICK_FEATURES)
    m = M.fit_tree(v, maxDepth=1)
    facts = {r["name"]: r["value"] for r in M.tree_facts(spark, m).collect()}
    assert int(facts["root_feature"]) == best["feature_index"]
    assert math.isclose(facts["root_threshold"], best["threshold"])


def test_tree_invariants(spark, sf):
    v = M.assemble(Q.click_label(spark, sf), Q.CLICK_FEATURES)
    m = M.fit_tree(v)
    assert m.depth <= 7
    imp = m.featureImportances.toArray()
    assert abs(imp.sum() - 1.0) < 1e-9 or imp.sum() == 0


def test_svc_single_class_fails_clearly(spark):
    df = spark.createDataFrame([(0.0, 1.0), (0.0, 2.0)], "label double, a double")
    with pytest.raises(ValueError, match="both classes"):
        M.fit_svc(M.assemble(df, ["a"]))


def test_svc_prediction_is_sign(spark, sf):
    v = M.assemble(Q.click_label(spark, sf), Q.CLICK_FEATURES)
    m = M.fit_svc(v)
    w, b = m.coefficients.toArray(), m.intercept
    for r in m.transform(v).select("features", "prediction").collect():
        assert r["prediction"] == (1.0 if float(r["features"].toArray() @ w) + b > 0 else 0.0)


def test_mlp_weight_count(spark, sf):
    v = M.assemble(Q.click_label(spark, sf), Q.CLICK_FEATURES)
    m = M.fit_mlp(v, 19, 3, maxIter=5)
    assert len(m.weights) == (19 + 1) * 5 + (5 + 1) * 3       # 118


def test_gmm_invariants(spark, sf):
    v = M.assemble(Q.customer_class_pivot(spark, sf), Q.PIVOT_FEATURES)
    m = M.fit_gmm(v)
    assert abs(sum(m.weights) - 1.0) < 1e-9
    for g in m.gaussians:
        c = g.cov.toArray()
        assert (abs(c - c.T) < 1e-9).all()
    again = M.fit_gmm(v)
    assert math.isclose(m.summary.logLikelihood, again.summary.logLikelihood, rel_tol=1e-9)


def test_tree_nodes_are_the_printed_tree(spark, sf):
    v = M.assemble(Q.click_label(spark, sf), Q.CLICK_FEATURES)
    m = M.fit_tree(v)
    nodes = {r["node"]: r for r in M.tree_nodes(spark, m).collect()}
    assert len(nodes) == m.numNodes and max(r["depth"] for r in nodes.values()) == m.depth
    kids = {}
    for r in nodes.values():
        if r["parent"] is not None:
            kids.setdefault(r["parent"], []).append(r["node"])
    for r in v.limit(200).collect():
        at = 0
        while not nodes[at]["is_leaf"]:
            low, high = sorted(kids[at])
            at = low if r["features"][nodes[at]["feature"]] <= nodes[at]["threshold"] else high
        assert nodes[at]["prediction"] == m.predict(r["features"])


def test_gini_table_is_exact_over_many_values(spark):
    """More distinct values than ranges: against a plain computation."""
    import random
    rnd = random.Random(2)
    rows = [(float(rnd.random() < 0.3), rnd.randrange(500), rnd.choice([0, 0, 0, 1, 10 ** 9])) for _ in range(2000)]
    df = spark.createDataFrame(rows, "label double, a long, b long")
    got = {(r["feature"], r["threshold"]): (r["n_left"], r["n_right"], r["gain"]) for r in tree.gini_splits(df, ["a", "b"], [0.0, 1.0]).collect()}

    def gini(labels):
        n = len(labels)
        return 1 - sum((labels.count(c) / n) ** 2 for c in (0.0, 1.0)) if n else 0.0

    want = {}
    for k, f in ((1, "a"), (2, "b")):
        values = sorted({r[k] for r in rows})
        for x, y in zip(values, values[1:]):
            left, right = [r[0] for r in rows if r[k] <= x], [r[0] for r in rows if r[k] > x]
            gain = gini(left + right) - len(left) / 2000 * gini(left) - len(right) / 2000 * gini(right)
            want[f, (x + y) / 2] = (len(left), len(right), gain)
    assert set(got) == set(want)
    for k, (n, r, g) in want.items():
        assert got[k][:2] == (n, r) and math.isclose(got[k][2], g, abs_tol=2e-9)


def test_logistic_history_and_probabilities(spark, sf):
    data = M.text_features(Q._review_split(spark, sf), "pr_content", F.col("split") == "train")
    m = M.logistic_estimator().fit(data.filter(F.col("split") == "train"))
    h = m.summary.objectiveHistory
    assert all(b <= a + 1e-9 for a, b in zip(h, h[1:]))
    for r in m.transform(data).select("probability").collect():
        assert abs(sum(r[0]) - 1.0) < 1e-9


def test_lda_shares_vocabulary_and_terms_left_out(spark, sf, tmp_path):
    from aisleflow.operators import text
    from aisleflow.sources import adapters
    key, col = "pr_review_id", "pr_content"
    docs = adapters.review_texts(spark, sf)
    n = text.vocabulary_size(docs, key, col).first()[0]
    for bound in (n, 50):
        m, features, n_terms = M.fit_topics(docs, key, col, bound, maxIter=3)
        shares = M.lda_doc_topics(m.lda, features, key).groupBy(key).agg(F.sum("share").alias("s")).collect()
        assert len(shares) == docs.filter(f"{col} IS NOT NULL").count() and n_terms == n
        assert all(abs(r["s"] - 1.0) < 1e-6 or r["s"] == 0 for r in shares)
        terms = {r["term"]: r["term_index"] for r in m.vocabulary.collect()}
        assert sorted(terms.values()) == list(range(bound))
        topics = M.lda_topics(m).collect()
        assert len(topics) == 40 and {r["term"] for r in topics} <= set(terms)
        q = M.lda_quality(spark, m.lda, features, n).first()
        assert (q["vocab_size"], q["terms_left_out"]) == (bound, n - bound)
        loaded = M.TopicModel.load(spark, m.save(str(tmp_path / f"topics{bound}")))
        new = spark.createDataFrame([(1, docs.first()[col]), (2, "zzz-unknown"), (3, ""), (4, None)], f"{key} long, {col} string")
        a, b = ({(r[key], r["topic"]): r["share"] for r in x.transform(new, key, col).collect()} for x in (m, loaded))
        assert a == b and {k for k, _ in a} == {1, 2, 3}


def test_topic_vectors_are_those_of_a_count_vectorizer(spark, sf):
    """The same counts for each term as CountVectorizer gives, whose ties are numbered otherwise."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import CountVectorizer
    from aisleflow.operators import text
    from aisleflow.sources import adapters
    key, col = "pr_review_id", "pr_content"
    docs = adapters.review_texts(spark, sf).filter(f"{col} IS NOT NULL")
    tf = M.word_counts(docs, key, col)
    vocabulary = text.term_vocabulary(tf)
    names = {r["term_index"]: r["term"] for r in vocabulary.collect()}
    own = {r[key]: {names[int(i)]: v for i, v in zip(r["features"].indices, r["features"].values)}
           for r in M.term_vectors(docs, tf, vocabulary, len(names), key, col).collect()}
    cv = Pipeline(stages=M.words_of(col) + [CountVectorizer(inputCol="words", outputCol="features")]).fit(docs)
    words = cv.stages[-1].vocabulary
    want = {r[key]: {words[int(i)]: v for i, v in zip(r["features"].indices, r["features"].values)}
            for r in cv.transform(docs).collect()}
    assert own == want


def test_topics_above_the_driver_limit_raise_before_the_fit(spark, sf):
    from aisleflow.sources import adapters
    with pytest.raises(ValueError, match="bytes on the driver"):
        M.fit_topics(adapters.review_texts(spark, sf), "pr_review_id", "pr_content", max_bytes=1000)


def test_text_pipeline_scores_raw_texts(spark, sf, tmp_path):
    """The job's pipeline, saved and loaded, on raw reviews: the job's own predictions, and nulls as empty texts."""
    from aisleflow.plans import jobs
    from aisleflow.sources import adapters, sinks
    reviews = adapters.product_reviews(spark, sf)
    for run in (jobs.review_sentiment_bayes, jobs.review_sentiment_logistic):
        out = run(spark, reviews, jobs.ReviewConfig(log=False))
        loaded = sinks.load_model(sinks.save_model(out["pipeline"], str(tmp_path / run.__name__)))
        raw = {r["pr_review_id"]: r["prediction"] for r in M.score_texts(loaded, reviews, "pr_review_id", "pr_content").collect()}
        for r in out["predictions"].collect():
            assert raw[r["pr_review_id"]] == r["prediction"]
        other = spark.createDataFrame([(1, None), (2, "")], "id long, t string")
        a, b = M.score_texts(loaded, other, "id", "t").orderBy("id").collect()
        assert (a["prediction"], a["probability"]) == (b["prediction"], b["probability"])
        # the idf is that of the training side: other labels or texts on the test side change nothing
        out["release"]()


def test_objective_is_the_optimizers(spark):
    """Penalised objective and margins against numpy, and against the last entry of the history."""
    import numpy as np
    from pyspark.ml.linalg import Vectors
    from aisleflow.operators import linear
    from aisleflow.sources import vectors
    rng = np.random.default_rng(3)
    x = rng.normal(size=(80, 6)) * (rng.random((80, 6)) < 0.6)
    for labels, rows in ((3, 3), (2, 1)):
        y = rng.integers(0, labels, 80)
        vector = lambda i, v: Vectors.dense(v) if i % 2 else Vectors.sparse(6, {int(j): float(v[j]) for j in np.flatnonzero(v)})
        data = spark.createDataFrame([(i, float(c), vector(i, v)) for i, (c, v) in enumerate(zip(y, x))], ["id", "label", "features"])
        m = M.logistic_estimator("auto", elasticNetParam=0.3, maxIter=8).fit(data)
        assert m.coefficientMatrix.numRows == rows
        parts = vectors.to_parts(data, "features")
        coef = M.logistic_coefficients(spark, m)
        entries = vectors.entries(parts, "id", "features")
        got = linear.objective(parts.select("id", "label"), entries, coef, "id", 0.1, 0.3).first()
        assert abs(got["objective"] - m.summary.objectiveHistory[-1]) < 1e-10 and got["n"] == 80
        margins = linear.margins(parts.select("id", "label"), entries, coef, "id", rows_per_task=5).orderBy("id").collect()
        b, w = m.interceptVector.toArray(), m.coefficientMatrix.toArray()
        want = x @ w.T + b
        own = np.array([[r[f"m{c}"] for c in range(labels)] for r in margins])
        np.testing.assert_allclose(own if rows == 3 else own[:, 1:], want, atol=1e-10)


def test_tree_nodes_recomputed_by_routing(spark, sf):
    from aisleflow.operators import tree_routing
    data, m = Q.tree_model(spark, sf)
    train = data.filter("split = 'train'")
    nodes = M.tree_nodes(spark, m)
    rows = {r["node"]: r for r in tree_routing.node_statistics(train, nodes, Q.CLICK_FEATURES, [0.0, 1.0]).collect()}
    assert len(rows) == m.numNodes and rows[0]["n"] == train.count()
    for r in rows.values():
        assert abs(r["own_impurity"] - r["impurity"]) < 1e-12 and r["own_prediction"] == r["prediction"]
        assert r["is_leaf"] or abs(r["own_gain"] - r["gain"]) < 1e-12
    # the leaf of a row is where the model predicts from
    routed = tree_routing.route(m.transform(data), nodes, Q.CLICK_FEATURES)
    leaf = {n: r["prediction"] for n, r in rows.items()}
    assert all(leaf[r["path"][-1]] == r["prediction"] for r in routed.select("path", "prediction").collect())


def test_mixture_density_is_the_estimators(spark, sf):
    import numpy as np
    from aisleflow.functions import density
    v, m = Q.gmm_model(spark, sf)
    parts = [density.weighted_density(Q.PIVOT_FEATURES, r["weight"], r["mean"], r["cov"]) for r in M.gmm_components(spark, m).collect()]
    for r in m.transform(v).select("probability", density.mixture_probabilities(parts).alias("p")).collect():
        np.testing.assert_allclose(r["p"], r["probability"].toArray(), atol=1e-9)
    # a covariance of rank 1: the density lives on its one direction
    whitener, logdet = density.whitener(np.array([[4.0, 4.0], [4.0, 4.0]]))
    assert whitener.shape == (1, 2) and abs(logdet - np.log(8)) < 1e-12


def test_chosen_k_is_the_smallest_of_the_best(spark):
    sweep = spark.createDataFrame([(2, 0.5), (3, 0.7), (4, 0.7), (5, 0.1)], "k int, silhouette double")
    assert M.chosen_k(sweep).collect() == [(3, 0.7)]


def test_lda_bound_is_that_of_the_library(spark):
    """The same likelihood and perplexity as the model's own, which infers each document from another random start;
    an empty document and a term of every document change nothing."""
    from pyspark.ml.linalg import Vectors
    rows = [(i, Vectors.sparse(30, sorted({0: 1.0, **{(i * j) % 29 + 1: float(j) for j in range(1, 6)}}.items()))) for i in range(1, 40)]
    features = spark.createDataFrame([*rows, (40, Vectors.sparse(30, []))], ["id", "features"])
    m = M.fit_lda(features, k=3, maxIter=5)
    for spread in (1 << 20, 5):
        bound, words = M.lda_bound(spark, m, features, rows_per_task=spread)
        assert words == sum(sum(v.values) for _, v in rows)
        assert abs(bound / m.logLikelihood(features) - 1) < 1e-4
    q = M.lda_quality(spark, m, features, 30).first()
    assert abs(q["log_perplexity"] / m.logPerplexity(features) - 1) < 1e-4 and q["terms_left_out"] == 0


def test_lda_quality_does_not_ask_the_library_for_the_likelihood(spark, monkeypatch):
    """Which works through the whole topic matrix for each document."""
    from pyspark.ml.linalg import Vectors
    features = spark.createDataFrame([(i, Vectors.sparse(50, [(i, 1.0), (49, 2.0)])) for i in range(20)], ["id", "features"])
    m = M.fit_lda(features, maxIter=1)
    for name in ("logLikelihood", "logPerplexity"):
        monkeypatch.setattr(type(m), name, lambda *_: 1 / 0)
    q = M.lda_quality(spark, m, features, 50).first()
    assert round(-q["log_likelihood"] / q["log_perplexity"]) == 60
