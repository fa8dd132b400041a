
from aisleflow.operators import pivots


def _items(spark):
    # item 1..4: class 1, 2, 17 (no column), 3; item 5 in an unlisted category
    return spark.createDataFrame(
        [(1, 1, "cat#01", 1), (2, 2, "cat#02", 2), (3, 3, "cat#03", 17),
         (4, 4, "cat#04", 3), (5, 0, "cat#00", 1)],
        "i_item_id long, i_category_id int, i_category_name string, i_class_id int")


def test_class_pivot_having_nulls_and_uncounted_class(spark):
    sales = spark.createDataFrame(
        [(1, 10, 1), (1, 10, 2), (1, 10, 3),                 # customer 10: 3 rows -> dropped
         (2, 20, 1), (2, 20, 1), (2, 20, 3), (2, 20, 4),     # customer 20: 4 rows -> kept
         (3, None, 1), (3, None, 2),                         # NULL customer -> dropped
         (4, 20, 5)],                                        # unlisted category -> not counted
        "ss_transaction_id long, ss_customer_id long, ss_item_id long")
    out = pivots.class_count_pivot(sales, _items(spark)).collect()
    assert len(out) == 1
    r = out[0]
    assert r["cid"] == 20 and r["id1"] == 2 and r["id3"] == 1 and r["id2"] == 0
    assert sum(r[f"id{c}"] for c in range(1, 17)) == 3      # class 17 counted only in HAVING


def test_click_pivot_and_labels(spark):
    clicks = spark.createDataFrame(
        [(7, 1), (7, 1), (7, 2), (8, 4), (None, 1), (8, 99)],
        "wl_customer_id long, wl_item_id long")
    items = _items(spark)
    p = pivots.category_click_pivot(clicks, items, categories=range(5))
    rows = {r["wl_customer_id"]: r for r in p.collect()}
    assert set(rows) == {7, 8}
    assert rows[7]["clicks_in_1"] == 2 and rows[7]["clicks_in_2"] == 1 and rows[8]["clicks_in_4"] == 1
    lab = {r["wl_customer_id"]: r["label"] for r in pivots.click_label(p, 1.5, source="clicks_in_1").collect()}
    assert lab == {7: 1.0, 8: 0.0}
    mean = {r["wl_customer_id"]: r["label"] for r in
            pivots.click_label_by_mean(p, source="clicks_in_1").collect()}
    assert mean == {7: 1.0, 8: 0.0}                          # mean of (2, 0) is 1


def test_results_partition_independent(spark, sf):
    """Tier-S results do not depend on the shuffle partition count."""
    from aisleflow.plans import queries as Q
    names = ["customer_class_pivot", "category_clicks", "baskets", "gini_splits", "tokens"]
    ref = {n: sorted(Q.QUERIES[n](spark, sf).collect()) for n in names}
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for p in ("1", "17"):
            spark.conf.set("spark.sql.shuffle.partitions", p)
            for n in names:
                assert sorted(Q.QUERIES[n](spark, sf).collect()) == ref[n], (n, p)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
