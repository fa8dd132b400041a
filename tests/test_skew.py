"""Hot keys: plans combine map-side before shuffling, and a key holding a
third of the rows gives exact results."""

from collections import Counter

from aisleflow.operators import baskets as B
from aisleflow.operators import pivots


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_partial_aggregation_before_shuffle(spark, sf):
    from aisleflow.plans import queries as Q
    assert "partial_count" in _plan(Q.customer_class_pivot(spark, sf))
    assert "partial_collect_set" in _plan(Q.baskets_q(spark, sf))
    assert "partial_count" in _plan(Q.term_idf(spark, sf))


def test_hot_customer_and_transaction_exact(spark):
    items = spark.createDataFrame(
        [(i, i % 3 + 1, f"cat#{i % 3 + 1:02d}", i % 5 + 1) for i in range(30)],
        "i_item_id long, i_category_id int, i_category_name string, i_class_id int")
    rows = []
    for n in range(3000):                       # customer 1 / transaction 1: a third
        hot = n % 3 == 0
        rows.append((1 if hot else n, 1 if hot else n // 2, n % 30))
    sales = spark.createDataFrame(rows, "ss_transaction_id long, ss_customer_id long, ss_item_id long")
    sales = sales.repartition(17)
    piv = {r["cid"]: r for r in pivots.class_count_pivot(
        sales, items, classes=range(1, 6),
        category_names=["cat#01", "cat#02", "cat#03"]).collect()}
    want = Counter(i % 5 + 1 for t, c, i in rows if c == 1)
    assert {c: piv[1][f"id{c}"] for c in range(1, 6)} == {c: want[c] for c in range(1, 6)}
    bk = {r[0]: r[1] for r in B.baskets(sales).collect()}
    assert bk[1] == sorted({i for t, c, i in rows if t == 1})


def test_durable_intermediates_same_results(spark, sf):
    """Writing reused intermediates to the shared folder gives the same
    results as caching them."""
    from aisleflow.plans import cache as M
    from aisleflow.plans import queries as Q
    ref = sorted(Q.customer_class_pivot(spark, sf).collect())
    spark.conf.set(M.DURABLE_CONF, "true")
    try:
        staged = M.hold(Q.customer_class_pivot(spark, sf))
        files = staged.inputFiles()
        assert files and all(spark.conf.get("spark.checkpoint.dir").split("://")[-1] in f
                             for f in files)
        assert sorted(staged.collect()) == ref
    finally:
        spark.conf.set(M.DURABLE_CONF, "false")
