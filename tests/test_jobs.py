"""The nine end-to-end jobs run on sf 0.001 and return their tables."""


from pyspark.sql import functions as F

from aisleflow.plans import jobs
from aisleflow.sources import adapters, sinks


def test_segmentation_and_mixture(spark, sf, tmp_path):
    sales, items = adapters.store_sales(spark, sf), adapters.items(spark, sf)
    out = jobs.customer_segmentation(spark, sales, items)
    assert out["centers"].select("cluster").distinct().count() == 4
    assert out["assignment"].count() == out["features"].count()
    orig = jobs.customer_segmentation(
        spark, sales, items, jobs.SegmentationConfig(
            include_key=True, features=tuple(f"id{c}" for c in range(1, 11)),
            category_names=jobs.pivots.ORIGINAL_CATEGORY_NAMES, log=False))
    assert "cid" in {r["feature"] for r in orig["centers"].collect()}
    mix = jobs.customer_mixture(spark, sales, items)
    assert abs(sum(r["weight"] for r in mix["components"].collect()) - 1) < 1e-9


def test_review_jobs(spark, sf):
    reviews = adapters.product_reviews(spark, sf)
    nb = jobs.review_sentiment_bayes(spark, reviews)
    pred = nb["predictions"].collect()
    a = nb["accuracy"].first()
    # every held-out rated review is predicted once, and the accuracy is that of the rows
    assert len(pred) == a["n"] == len({r["pr_review_id"] for r in pred}) > 0
    assert abs(a["accuracy"] - sum(r["label"] == r["prediction"] for r in pred) / len(pred)) < 1e-12
    best = {}
    for r in nb["scores"].collect():
        best.setdefault(r["pr_review_id"], []).append((r["probability"], -r["class"]))
    assert {k: -max(v)[1] for k, v in best.items()} == {r["pr_review_id"]: int(r["prediction"]) for r in pred}
    binary = jobs.review_sentiment_logistic(spark, reviews, jobs.ReviewConfig(rating_map=dict(jobs.L.RATING_TO_BINARY), log=False), family="auto")
    facts = {r["name"]: r["value"] for r in binary["facts"].collect()}
    assert (facts["num_classes"], facts["coefficient_rows"]) == (2.0, 1.0)
    lr = jobs.review_sentiment_logistic(spark, reviews)
    h = [r["objective"] for r in lr["history"].orderBy("iteration").collect()]
    assert all(b <= a + 1e-9 for a, b in zip(h, h[1:]))
    topics = jobs.review_topics(spark, reviews, jobs.TopicConfig(max_iter=5))
    assert topics["topics"].select("topic").distinct().count() == 4


def test_market_basket_publishes_rules(spark, sf):
    out = jobs.market_basket(spark, adapters.sales_lines(spark, sf), adapters.items(spark, sf),
                             jobs.BasketConfig(item_col="i_brand", min_confidence=0.1,
                                               publish_rules_as="association_rules_view"))
    n = spark.sql("SELECT count(*) FROM association_rules_view").first()[0]
    assert n == out["rules"].count() > 0
    ref = {r["ss_transaction_id"]: sorted(r["prediction"]) for r in out["model"].transform(out["baskets"]).collect() if r["prediction"]}
    assert {r["ss_transaction_id"]: r["prediction"] for r in out["recommendations"].collect()} == ref
    out["release"]()
    sinks.drop_view(spark, "association_rules_view")


def test_click_jobs_and_run_log(spark, sf):
    clicks, items = adapters.clicks(spark, sf), adapters.items(spark, sf)
    tree = jobs.click_interest_tree(spark, clicks, items)
    facts = {r["name"]: r["value"] for r in tree["facts"].collect()}
    assert facts["depth"] <= 7
    svc = jobs.click_interest_svc(spark, clicks, items)
    assert "intercept" in {r["feature"] for r in svc["coefficients"].collect()}
    mlp = jobs.click_interest_mlp(spark, clicks, items, jobs.ClickConfig(threshold=None, train_buckets=6))
    tested = tree["metrics"].first()["n"]
    assert tree["predictions"].count() == tested and mlp["predictions"].count() == mlp["metrics"].first()["n"] > 0
    log = sinks.read_run_log(spark)
    jobs_logged = {r["job"] for r in log.select("job").distinct().collect()}
    assert {"click_interest_tree", "click_interest_svc", "click_interest_mlp"} <= jobs_logged
    # params come from the fitted model's param map, not typed by hand
    depth = log.filter((F.col("job") == "click_interest_tree") & (F.col("name") == "maxDepth"))
    assert depth.first()["value"] == 7.0
