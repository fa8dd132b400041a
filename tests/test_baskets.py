from itertools import combinations


from aisleflow.operators import baskets as B


def _sales(spark):
    rows = [(1, "a"), (1, "b"), (1, "c"), (1, "a"),      # duplicate item
            (2, "a"), (2, "b"), (2, "c"),
            (3, "a"), (3, "b"),
            (4, "d"),                                      # singleton
            (5, "a"), (5, "c"),
            (6, "b"), (6, "c"),
            (7, "a"), (7, "b"), (7, "c"), (7, "d"),
            (8, "e")]
    return spark.createDataFrame(rows, "ss_transaction_id long, ss_item_id string")


def test_baskets_are_sets(spark):
    b = {r[0]: r[1] for r in B.baskets(_sales(spark)).collect()}
    assert b[1] == ["a", "b", "c"] and b[4] == ["d"] and len(b) == 8


def test_itemsets_rules_recommendations(spark):
    bk = B.baskets(_sales(spark))
    model = B.fit_fp_growth(bk, min_support=0.25, min_confidence=0.5)
    sets = {tuple(r["items"]): r["freq"] for r in B.frequent_itemsets(model).collect()}
    assert sets[("a", "b", "c")] == 3                    # the 3-item frequent set
    for s in sets:                                        # downward closure
        for k in range(1, len(s)):
            for sub in combinations(s, k):
                assert sub in sets
    n = bk.count()
    for r in B.association_rules(model).collect():
        union = tuple(sorted(r["antecedent"] + [r["consequent"]]))
        conf = sets[union] / sets[tuple(r["antecedent"])]
        assert abs(r["confidence"] - conf) < 1e-9
        assert abs(r["support"] - sets[union] / n) < 1e-9
    # relational recommendations equal the model's own transform (non-empty ones)
    ref = {r["ss_transaction_id"]: sorted(r["prediction"])
           for r in model.transform(bk).collect() if r["prediction"]}
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    for threshold in (old, "-1"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        try:
            out = B.recommend(bk, B.association_rules(model), B.frequent_itemsets(model))
            assert {r[0]: r[1] for r in out.collect()} == ref
        finally:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_equal_baskets_lie_together_and_often_ones_are_spread(spark):
    from aisleflow.plans import cache
    rows = [(i, ["a", "b"] if i % 3 else ["a", str(i % 30)]) for i in range(300)] + [(None, ["c"]), (None, ["c"]), (7, [])]
    df = spark.createDataFrame(rows, "ss_transaction_id long, items array<string>").repartition(9)
    most = cache.FIT_PARTITIONS_PER_CORE * spark.sparkContext.defaultParallelism
    with cache.owned() as owner:
        for limit, spread in ((1000, 1), (20, 10)):
            alike = B.hold_alike(df, rows_per_task=limit)
            assert owner.frames == [alike] and alike.rdd.getNumPartitions() <= most
            got = alike.rdd.mapPartitionsWithIndex(lambda i, p: [(i, r[0], tuple(r[1])) for r in p]).collect()
            assert sorted(map(str, ((t, b) for _, t, b in got))) == sorted(str((t, tuple(b))) for t, b in rows)
            places = {b: {i for i, _, own in got if own == b} for _, _, b in got}
            assert max(len(v) for b, v in places.items() if b != ("a", "b")) == 1
            assert (len(places["a", "b"]) > 1) == (spread > 1)
            alike.unpersist()
            owner.frames.clear()
        model = B.fit_fp_growth(B.hold_alike(df, rows_per_task=20), min_support=0.3)
        assert {tuple(r["items"]): r["freq"] for r in B.frequent_itemsets(model).collect()} == {("a",): 300, ("b",): 200, ("a", "b"): 200}
