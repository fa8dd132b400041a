"""The nine retail ML jobs as functions: config + DataFrames in, a dict of
DataFrames out, params and metrics appended to the run log.

Inputs are the job-shaped tables (``items``, ``store_sales``, ``clicks``,
``product_reviews``), from :mod:`aisleflow.sources.readers` for raw files or
:mod:`aisleflow.sources.adapters` for the parquet test tables.  Defaults are
the corrected behaviour (customer id not a feature, all 16 classes, correct
category list, contiguous labels, IDF fitted on the training side, hash
split); flags reproduce the original choices.

The text jobs return ``pipeline``: the whole fitted way from raw reviews to a prediction or to topic
shares (``models.score_texts``, ``TopicModel.transform``), which can be saved and loaded.

Every result has ``release``: call it when the frames are no longer read, to uncache
the fit's inputs (they still work afterwards, by recomputation).
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aisleflow.functions import labels as L
from aisleflow.functions.split import with_split
from aisleflow.operators import baskets as B
from aisleflow.operators import evaluate as ev
from aisleflow.operators import pivots
from aisleflow.plans import models as M
from aisleflow.plans.cache import hold, hold_for_fit, in_few_partitions, owned
from aisleflow.sources import sinks


def job(fn):
    """Run ``fn`` with an owner for what it caches; add its ``release`` to the results."""
    @wraps(fn)
    def run(*args, **kwargs) -> dict:
        with owned(keep=True) as owner:
            return {**fn(*args, **kwargs), "release": owner.release}
    return run


@dataclass
class SegmentationConfig:
    k: int = 4
    init_steps: int = 5
    max_iter: int = 20
    tol: float = 0.01
    seed: int = M.DEFAULT_SEED
    category_names: tuple = pivots.DEFAULT_CATEGORY_NAMES
    classes: tuple = pivots.DEFAULT_CLASSES
    features: tuple | None = None        # default: all class columns
    include_key: bool = False            # True: customer id is a feature too
    log: bool = True


def _segment_vectors(sales, items, cfg):
    piv = pivots.class_count_pivot(sales, items, classes=cfg.classes,
                                   category_names=cfg.category_names)
    feats = list(cfg.features or [f"id{c}" for c in cfg.classes])
    if cfg.include_key:
        feats = ["cid"] + feats
    return piv, hold_for_fit(M.assemble(piv, feats)), feats


@job
def customer_segmentation(spark: SparkSession, sales: DataFrame, items: DataFrame,
                          cfg: SegmentationConfig = SegmentationConfig()) -> dict:
    piv, v, feats = _segment_vectors(sales, items, cfg)
    model = M.fit_kmeans(v, seed=cfg.seed, k=cfg.k, initSteps=cfg.init_steps,
                         maxIter=cfg.max_iter, tol=cfg.tol)
    pred = model.transform(v)
    quality = M.kmeans_quality(spark, model, v)
    if cfg.log:
        sinks.log_run(spark, "customer_segmentation", sinks.param_rows(model),
                      {"silhouette": quality.first()["silhouette"]})
    return {"features": piv, "centers": M.kmeans_centers(spark, model, feats),
            "assignment": pred.select("cid", "prediction"), "quality": quality,
            "model": model}


@dataclass
class MixtureConfig(SegmentationConfig):
    k: int = 2
    seed: int = M.GMM["seed"]
    max_iter: int = 100


@job
def customer_mixture(spark: SparkSession, sales: DataFrame, items: DataFrame,
                     cfg: MixtureConfig = MixtureConfig()) -> dict:
    piv, v, _ = _segment_vectors(sales, items, cfg)
    model = M.fit_gmm(v, k=cfg.k, tol=cfg.tol, seed=cfg.seed, maxIter=cfg.max_iter)
    summary = M.gmm_summary(spark, model)
    if cfg.log:
        sinks.log_run(spark, "customer_mixture", sinks.param_rows(model),
                      {"log_likelihood": summary.first()["log_likelihood"]})
    return {"features": piv, "components": M.gmm_components(spark, model),
            "summary": summary, "assignment": model.transform(v).select("cid", "prediction"),
            "model": model}


@dataclass
class ReviewConfig:
    rating_map: dict = field(default_factory=lambda: dict(L.RATING_TO_BAYES))
    bucket_filter: bool = False          # True: keep pmod(id, 5) IN (1, 2, 3)
    train_buckets: int = 6               # 60 / 40 hash split
    log: bool = True


def _labelled_reviews(reviews: DataFrame, cfg: ReviewConfig) -> tuple:
    r = reviews.filter(F.col("pr_content").isNotNull())
    if cfg.bucket_filter:
        r = r.filter(L.bucket_filter(F.col("pr_review_id")))
    r = r.select("pr_review_id", L.rating_label(F.col("pr_rating"), cfg.rating_map).alias("label"),
                 "pr_content").filter(F.col("label").isNotNull())
    r = with_split(r, "pr_review_id", cfg.train_buckets)
    stages, data = M.fit_text_features(r, "pr_content", F.col("split") == "train")
    return stages, in_few_partitions(data)


def _classify_reviews(spark, reviews, cfg, name, estimator):
    stages, data = _labelled_reviews(reviews, cfg)
    model = estimator.fit(data.filter(F.col("split") == "train"))
    out = model.transform(data.filter(F.col("split") == "test"))
    pred = out.select("pr_review_id", "label", "prediction")
    acc = ev.accuracy(pred)
    if cfg.log:
        sinks.log_run(spark, name, sinks.param_rows(model), {"accuracy": acc.first()["accuracy"]})
    return {"predictions": pred, "scores": M.prediction_scores(out, "pr_review_id"), "accuracy": acc, "model": model,
            "pipeline": M.text_pipeline(stages, model)}


@job
def review_sentiment_bayes(spark, reviews, cfg: ReviewConfig = ReviewConfig()) -> dict:
    out = _classify_reviews(spark, reviews, cfg, "review_sentiment_bayes", M.naive_bayes_estimator())
    return {**out, "per_label": ev.per_label_metrics(out["predictions"])}


@job
def review_sentiment_logistic(spark, reviews, cfg: ReviewConfig = ReviewConfig(),
                              family: str = "multinomial") -> dict:
    """``family="auto"`` with ``rating_map=RATING_TO_BINARY`` is the binary model."""
    out = _classify_reviews(spark, reviews, cfg, "review_sentiment_logistic", M.logistic_estimator(family))
    lr = out["model"]
    return {**out, "coefficients": M.logistic_coefficients(spark, lr), "facts": M.logistic_facts(spark, lr),
            "history": M.logistic_history(spark, lr),
            "train_metrics": M.logistic_train_metrics(spark, lr),
            "train_label_metrics": M.logistic_label_metrics(spark, lr),
            "test_metrics": ev.weighted_metrics(out["predictions"])}


@dataclass
class TopicConfig:
    k: int = 4
    max_iter: int = 100
    seed: int = M.DEFAULT_SEED
    bucket_filter: bool = False
    vocab_size: int | None = None        # None: every term; else the most frequent
    log: bool = True


@job
def review_topics(spark, reviews, cfg: TopicConfig = TopicConfig()) -> dict:
    r = reviews.filter(F.col("pr_content").isNotNull())
    if cfg.bucket_filter:
        r = r.filter(L.bucket_filter(F.col("pr_review_id")))
    docs = r.select("pr_review_id", "pr_content")
    topics, features, n_terms = M.fit_topics(docs, "pr_review_id", "pr_content", cfg.vocab_size, k=cfg.k,
                                             maxIter=cfg.max_iter, seed=cfg.seed)
    model = topics.lda
    quality = M.lda_quality(spark, model, features, n_terms)
    if cfg.log:
        q = quality.first()
        sinks.log_run(spark, "review_topics", sinks.param_rows(model),
                      {"log_likelihood": q["log_likelihood"], "log_perplexity": q["log_perplexity"]})
    return {"topics": M.lda_topics(topics),
            "doc_topics": M.lda_doc_topics(model, features, "pr_review_id"),
            "quality": quality, "model": model, "pipeline": topics}


@dataclass
class BasketConfig:
    min_support: float = B.MIN_SUPPORT
    min_confidence: float = B.MIN_CONFIDENCE
    num_partitions: int | None = None    # default: the input's partitioning
    item_col: str | None = None          # e.g. "i_brand"; default the item id
    publish_rules_as: str | None = None  # temp view name for the rules
    log: bool = True


@job
def market_basket(spark, sales, items, cfg: BasketConfig = BasketConfig()) -> dict:
    """``items=None`` builds the baskets from the sales alone."""
    bk = B.hold_alike(B.baskets(sales, items, item_col=cfg.item_col))
    model = B.mined(B.fit_fp_growth(bk, min_support=cfg.min_support,
                                    min_confidence=cfg.min_confidence,
                                    num_partitions=cfg.num_partitions))
    itemsets, rules = B.frequent_itemsets(model), B.association_rules(model)
    if cfg.publish_rules_as:
        sinks.publish(rules, cfg.publish_rules_as)
    if cfg.log:
        sinks.log_run(spark, "market_basket", sinks.param_rows(model), {})
    return {"baskets": bk, "itemsets": itemsets, "rules": rules,
            "recommendations": B.recommend(bk, rules, itemsets), "model": model}


@dataclass
class ClickConfig:
    threshold: float | None = pivots.CLICK_LABEL_THRESHOLD   # None: mean of clicks_in_0
    train_buckets: int = 7
    log: bool = True


def _click_data(clicks, items, cfg):
    piv = pivots.category_click_pivot(clicks, items)
    lab = (pivots.click_label(piv, cfg.threshold) if cfg.threshold is not None
           else pivots.click_label_by_mean(piv))
    feats = [c for c in lab.columns if c.startswith("clicks_in_")]
    data = hold_for_fit(with_split(M.assemble(lab, feats), "wl_customer_id", cfg.train_buckets))
    return data, feats


def _click_job(spark, clicks, items, cfg, name, fit):
    data, feats = _click_data(clicks, items, cfg)
    train, test = data.filter(F.col("split") == "train"), data.filter(F.col("split") == "test")
    model = fit(train, feats)
    pred = model.transform(test).select("wl_customer_id", "label", "prediction")
    acc = ev.regression_metrics(pred)
    if cfg.log:
        a = acc.first()
        sinks.log_run(spark, name, sinks.param_rows(model),
                      {"accuracy": a["accuracy"], "test_error": a["test_error"], "rmse": a["rmse"]})
    return model, pred, acc, feats


@job
def click_interest_tree(spark, clicks, items, cfg: ClickConfig = ClickConfig()) -> dict:
    model, pred, acc, feats = _click_job(spark, clicks, items, cfg, "click_interest_tree",
                                         lambda tr, f: M.fit_tree(tr))
    return {"predictions": pred, "metrics": acc, "facts": M.tree_facts(spark, model),
            "importances": M.tree_importances(spark, model, feats), "model": model}


@job
def click_interest_svc(spark, clicks, items, cfg: ClickConfig = ClickConfig(train_buckets=6)) -> dict:
    model, pred, acc, feats = _click_job(spark, clicks, items, cfg, "click_interest_svc",
                                         lambda tr, f: M.fit_svc(tr))
    return {"predictions": pred, "metrics": acc,
            "coefficients": M.svc_coefficients(spark, model, feats), "model": model}


@job
def click_interest_mlp(spark, clicks, items, cfg: ClickConfig = ClickConfig(train_buckets=6),
                       n_classes: int = 2) -> dict:
    model, pred, acc, _ = _click_job(spark, clicks, items, cfg, "click_interest_mlp",
                                     lambda tr, f: M.fit_mlp(tr, len(f), n_classes))
    return {"predictions": pred, "metrics": acc, "model": model}
