"""Submitted settings win; caches are owned and released."""

import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _python(code: str, submit: str = "") -> subprocess.CompletedProcess:
    env = dict(os.environ, PYTHONPATH=ROOT, PYSPARK_SUBMIT_ARGS=f"{submit} pyspark-shell")
    return subprocess.run([sys.executable, "-c", code], env=env, capture_output=True, text=True, timeout=180)


def test_submitted_settings_are_kept(tmp_path):
    ours = tmp_path / "operator-dir"
    out = _python(
        "from aisleflow.session import build_session, ensure_checkpoint_dir\n"
        "s = build_session('local[1]', extra={'spark.checkpoint.dir': '/nowhere', 'spark.sql.session.timeZone': 'CET'})\n"
        "print('GOT', ensure_checkpoint_dir(s), s.conf.get('spark.sql.adaptive.enabled'), s.conf.get('spark.sql.session.timeZone'),"
        " build_session('local[2]', extra={'spark.sql.shuffle.partitions': '3'}).conf.get('spark.sql.shuffle.partitions'))\n",
        f"--conf spark.checkpoint.dir=file:{ours} --conf spark.sql.adaptive.enabled=false --conf spark.sql.shuffle.partitions=7")
    assert f"GOT file:{ours} false CET 7" in out.stdout, out.stderr[-2000:]


def test_non_local_master_needs_a_shared_folder():
    from aisleflow import session

    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://somewhere:7077"

        def getConf(self):
            return Conf()

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.scratch_path(Session(), "x")


def _persistent(spark) -> int:
    return spark.sparkContext._jsc.getPersistentRDDs().size()


def test_release_leaves_nothing_cached(spark, sf):
    from aisleflow.plans import cache
    from aisleflow.plans import queries as Q
    cache.clear()
    spark.catalog.clearCache()
    before = _persistent(spark)
    for name in ("doc_tfidf", "frequent_itemsets", "nb_scores", "lloyd_centers", "kmeans_quality", "kmeans_sweep", "gmm_fit",
                 "nb_fit", "logreg_fit", "tree_fit", "svc_fit", "mlp_predictions", "lda_hashed_topics"):
        Q.QUERIES[name](spark, sf).count()
        cache.clear()
        assert _persistent(spark) == before, name


def test_jobs_release_their_inputs(spark, sf):
    from aisleflow.plans import jobs
    from aisleflow.sources import adapters
    before = _persistent(spark)
    out = jobs.click_interest_tree(spark, adapters.clicks(spark, sf), adapters.items(spark, sf), jobs.ClickConfig(log=False))
    assert _persistent(spark) > before
    out["release"]()
    assert _persistent(spark) == before and out["predictions"].count() > 0


def test_held_frames_use_all_cores(spark, sf):
    from aisleflow.plans import cache
    from aisleflow.plans import queries as Q
    with cache.owned():
        held = cache.hold(Q.click_label(spark, sf))
        assert held.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism


def test_memo_is_by_application_and_bounded(spark, sf, monkeypatch):
    from aisleflow.plans import cache
    cache.clear()
    monkeypatch.setattr(cache, "MAX_FITS", 2)
    calls = []
    for name in ("a", "b", "a", "c", "a", "b"):
        cache.memo(name, spark, sf, lambda: calls.append(name))
    assert calls == ["a", "b", "c", "b"]
    assert all(k[0] == spark.sparkContext.applicationId for k in cache._FITS)
    cache.clear()
