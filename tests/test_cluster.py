import math

import pytest

from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import VectorAssembler

from aisleflow.operators import cluster


def _points(spark):
    return spark.createDataFrame(
        [(1, 0.0, 0.0), (2, 0.0, 1.0), (3, 1.0, 0.0),
         (4, 10.0, 10.0), (5, 10.0, 11.0), (6, 11.0, 10.0),
         (7, 50.0, 50.0)], "k long, x double, y double")


def test_lloyd_steps(spark):
    p = _points(spark)
    init = cluster.initial_centers(p, ["x", "y"], 3, "k")
    assert init == [[0.0, 0.0], [0.0, 1.0], [1.0, 0.0]]
    c = cluster.lloyd(p, ["x", "y"], [[0.0, 0.0], [10.0, 10.0], [50.0, 50.0]], 3)
    assert c[0] == [1 / 3, 1 / 3] and c[1] == [31 / 3, 31 / 3] and c[2] == [50.0, 50.0]
    a = {r["k"]: r["cluster"] for r in cluster.assign(p, ["x", "y"], c).collect()}
    assert a == {1: 0, 2: 0, 3: 0, 4: 1, 5: 1, 6: 1, 7: 2}


def test_ties_go_to_lowest_cluster(spark):
    p = spark.createDataFrame([(1, 5.0)], "k long, x double")
    a = cluster.assign(p, ["x"], [[4.0], [6.0]]).first()["cluster"]
    assert a == 0


def test_silhouette_equals_evaluator_with_singleton(spark):
    p = cluster.assign(_points(spark), ["x", "y"], [[0.0, 0.0], [10.0, 10.0], [50.0, 50.0]])
    mine = cluster.silhouette(p, ["x", "y"]).first()["silhouette"]
    v = VectorAssembler(inputCols=["x", "y"], outputCol="features").transform(p)
    ref = ClusteringEvaluator(predictionCol="cluster").evaluate(v)
    assert math.isclose(mine, ref, rel_tol=1e-12, abs_tol=1e-12)


def test_assign_equals_kmeans_model(spark, sf):
    from aisleflow.plans import models as M
    from aisleflow.plans import queries as Q
    v = M.assemble(Q.customer_class_pivot(spark, sf), Q.PIVOT_FEATURES)
    m = M.fit_kmeans(v)
    centers = [list(map(float, c)) for c in m.clusterCenters()]
    mine = {r["cid"]: r["cluster"] for r in cluster.assign(v, Q.PIVOT_FEATURES, centers).collect()}
    ref = {r["cid"]: r["prediction"] for r in m.transform(v).collect()}
    assert mine == ref
    # more iterations never raise the cost
    c5 = M.fit_kmeans(v, maxIter=5).summary.trainingCost
    c20 = M.fit_kmeans(v, maxIter=20).summary.trainingCost
    assert c20 <= c5 + 1e-9


def test_runs_of_all_k_at_once(spark):
    """One pass a step for several k gives what each run gives alone, a cluster of one point included."""
    import random
    rnd = random.Random(4)
    rows = [(i, rnd.randint(0, 30), rnd.randint(0, 9)) for i in range(200)] + [(200, 900, 900)]
    pts = spark.createDataFrame(rows, "cid long, x long, y long").repartition(5)
    starts = {k: [[float(r[1]), float(r[2])] for r in (rows[:k - 1] + rows[-1:])] for k in (2, 3, 5)}
    alone = {k: cluster.lloyd(pts, ["x", "y"], s, 4) for k, s in starts.items()}
    got = cluster.lloyd_all(pts, ["x", "y"], starts, 4)
    for k in starts:
        for a, b in zip(alone[k], got[k]):
            assert a == pytest.approx(b, abs=1e-9)
    sil = {r["k"]: r["silhouette"] for r in cluster.silhouettes(pts, ["x", "y"], got).collect()}
    for k in starts:
        one = cluster.silhouette(cluster.assign(pts, ["x", "y"], got[k]), ["x", "y"]).first()["silhouette"]
        assert sil[k] == pytest.approx(one, abs=1e-9)
