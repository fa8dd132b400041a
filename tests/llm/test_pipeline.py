"""The pipeline, each stage against a brute-force version on its own input."""

import collections

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from aisleflow.llm import quality
from aisleflow.llm.common import table
from aisleflow.llm.queries import quality_labels
from test_dedup import brute_hits, expected_components
from test_resharding_mixing import brute_mix, check_law, domain_of


@pytest.fixture(scope="module")
def steps(spark, sf, tmp_path_factory):
    root = tmp_path_factory.mktemp("stages")
    docs, out = table(spark, sf, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        path = str(root / name)
        stage(spark, docs, sf).write.parquet(path)
        after = spark.read.parquet(path)
        out.append((name, docs, after))
        docs = after
    return out


def ids(df):
    return sorted(r[0] for r in df.select("doc_id").collect())


def test_quality_stage(spark, sf, steps):
    name, before, after = steps[0]
    cfg = quality.QualityConfig()
    model = quality.fit(before, quality_labels(spark, sf))
    rows = before.collect()
    score = quality.score_texts([r["text"] for r in rows], model, cfg)
    assert ids(after) == sorted(r["doc_id"] for r, s in zip(rows, score) if s >= 0.7)
    assert 0 < after.count() < before.count() and after.columns == before.columns


def test_near_dedup_stage(steps):
    _, before, after = steps[1]
    want = expected_components([(r["doc_id"], r["text"]) for r in before.collect()])
    assert ids(after) == sorted({c for _, _, c in want}) and after.columns == before.columns


def test_decontamination_stage(spark, sf, steps):
    _, before, after = steps[2]
    items = [tuple(r) for r in table(spark, sf, "benchmark").select("item_id", "text").collect()]
    want = brute_hits([(r["doc_id"], r["text"]) for r in before.collect()], items)
    assert ids(after) == sorted(w[0] for w in want if not w[2]) and after.columns == before.columns


def test_mixing_stage(steps):
    _, before, after = steps[3]
    want, _ = brute_mix([tuple(r) for r in before.select("doc_id", "text", "lang", "source").collect()], corpus_pipeline.MIX, domain_of)
    assert ids(after) == sorted(w[0] for w in want if w[-1]) and after.columns == before.columns


def test_sharding_stage(steps):
    _, before, after = steps[4]
    check_law(after.collect(), before, 40)
    assert ids(after) == ids(before)
    assert set(after.columns) == {*before.columns, "shard", "slot"}


def test_run_gives_the_stages_rows(spark, sf, steps):
    assert ids(corpus_pipeline.run(spark, sf)) == ids(steps[-1][2])


def test_stages_take_awkward_rows(spark, sf, docs, none):
    """Extra columns pass through; empty tables stay empty."""
    sizes = collections.Counter()
    for name, stage in corpus_pipeline.STAGES:
        got = stage(spark, docs, sf)
        sizes[name] = got.count()
        assert set(docs.columns) <= set(got.columns)
        assert stage(spark, none, sf).count() == 0
    assert sizes["sharding"] == docs.count() and sizes["simhash_near_dedup"] < docs.count()
    texts = docs.where(F.col("text").isNotNull()).count()
    assert texts > 0


def test_scratch_is_dropped(spark):
    from aisleflow.llm.common import cut, drop_scratch
    kept = cut(spark.range(3))
    assert kept.count() == 3 and drop_scratch(spark) and not drop_scratch(spark)
