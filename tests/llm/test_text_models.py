"""Language ID and quality classifier."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from aisleflow.llm import langid, quality
from aisleflow.llm.common import held_out, table
from aisleflow.llm.queries import QUERIES, quality_labels


def test_language_of_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    got = QUERIES["op1_language_id"](spark, sf).join(table(spark, sf, "documents").select("doc_id", "lang"), "doc_id").where("held_out")
    right, n = got.agg(F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert n > 200 and right / n > 0.98


def test_language_edge_cases(spark, docs, none):
    model = langid.fit(docs, F.col("lang"), F.lit(True))
    assert model.languages == ["de", "en"]
    rows = langid.predict(docs, model).collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert 0 <= r["score"] <= 1 and r["lang_pred"] in ("de", "en", "und")
    one = langid.score_texts([None, "", " \n", "12345 !!", "été", "x"], model)
    assert one[0][:4] == ["und"] * 4 and list(one[1][:4]) == [0] * 4 and "und" not in one[0][4:]
    assert langid.predict(none, model).count() == 0
    blank = langid.fit(none, F.col("lang"), F.lit(True))
    assert {r["lang_pred"] for r in langid.predict(docs, blank).collect()} == {"und"}


def test_language_score_is_multinomial_naive_bayes(spark):
    """Against a plain computation of the posterior from the matrix."""
    rng = np.random.default_rng(0)
    model = langid.LangIdModel(["a", "b"], np.vstack([rng.normal(size=(64, 2)), np.zeros((1, 2))]), np.log([0.3, 0.7]))
    text = "Ab c, dé"
    padded = " ab c  dé  "
    grams = [padded[i:i + k] for i in range(len(padded) - 2) for k in (2, 3)]
    feats, bounds, letters = langid.gram_features([text, "zz"], 64)
    assert bounds[1] - bounds[0] == len(text) + 1 and list(letters) == [5, 2]
    assert len(grams) == 2 * (len(text) + 1)
    logs = model.log_prior + model.log_prob[feats[:, bounds[0]:bounds[1]].ravel()].sum(axis=0)
    post = np.exp(logs - logs.max())
    name, score = langid.score_texts([text], model)
    assert name == [model.languages[int(post.argmax())]] and abs(score[0] - post.max() / post.sum()) < 1e-9
    # a text's result does not depend on its neighbours in the batch
    assert langid.score_texts(["zz", text, "q"], model)[1][1] == score[0]


@pytest.mark.parametrize("piece", [1, 7, 50])
def test_long_texts_are_counted_in_pieces(monkeypatch, piece):
    """The same grams, letters, names and posteriors as of the whole text."""
    rng = np.random.default_rng(2)
    model = langid.LangIdModel(["a", "b", "c"], np.vstack([rng.normal(size=(64, 3)), np.zeros((1, 3))]), np.log([0.2, 0.3, 0.5]))
    texts = ["Ab c, dé. Straße 12  ΣΑΣ x", "y" * 60, " 12 " * 20, "", None, "a  b", "İstanbul ve ötesi"]
    whole = langid.score_texts(texts, model)
    feats, bounds, letters = langid.gram_features([t or "" for t in texts], 64)
    monkeypatch.setattr(langid, "PIECE_CHARS", piece)
    for d, t in enumerate(texts):
        pieces = list(langid.long_grams(t or "", 64))
        assert np.array_equal(np.hstack([g for g, _ in pieces]), feats[:, bounds[2 * d]:bounds[2 * d + 1]])
        assert sum(n for _, n in pieces) == letters[d]
    got = langid.score_texts(texts, model)
    assert got[0] == whole[0] and np.allclose(got[1], whole[1], atol=1e-12)


def test_memory_of_a_very_long_text_is_bounded():
    import tracemalloc
    model = langid.LangIdModel([str(i) for i in range(100)], np.zeros((65, 100)), np.zeros(100))
    text = "some words of it " * 1_000_000
    langid._letter_table()
    tracemalloc.start()
    langid.score_texts([text, *["short text"] * 5000], model)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 6 * len(text)


def test_quality_of_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    got = QUERIES["op4_quality_classifier"](spark, sf).join(table(spark, sf, "labels"), "doc_id").where("held_out")
    right, n = got.agg(F.sum((F.col("predicted") == F.col("quality")).cast("int")), F.count("*")).first()
    assert n > 60 and right / n > 0.95


def test_quality_edge_cases(spark, docs, none):
    labels = spark.createDataFrame([(i, i % 2 if i != 2 else None) for i in range(24)] + [(None, 1), (7, 1), (500, 0)], "doc_id long, label int")
    model = quality.fit(docs, labels)
    rows = quality.score(docs, model).collect()
    assert len(rows) == docs.count() and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in rows)
    assert quality.score(none, model).count() == 0
    blank = quality.fit(none, labels)
    assert {r["score"] for r in quality.score(docs, blank).collect()} == {0.5}
    kept = quality.keep_good(docs, model)
    assert kept.columns == docs.columns and kept.count() == sum(r["predicted"] for r in rows)


def test_quality_fit_takes_very_long_texts(spark):
    """Counts beyond 16 bits in the sample leave the model finite and right."""
    good, bad = "some plain words of prose. " , "NO!! NO!! $$$ "
    rows = [(i, (good if i % 2 else bad) * (30_000 if i < 4 else 20 + i)) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = quality.fit(docs, spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, label int"), quality.QualityConfig(k=3))
    assert np.isfinite(model.basis).all() and np.isfinite(model.vectors).all()
    assert {r["doc_id"]: r["predicted"] for r in quality.score(docs, model, quality.QualityConfig(k=3)).collect()} == {i: i % 2 for i in range(40)}


def test_labels_of_absent_documents_take_no_place_of_the_bound(spark):
    docs = spark.createDataFrame([(i, f"text {i} " + ("fine prose of words " if i % 2 else "4711 0815 !! ") * 5) for i in range(30)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(3000)], "doc_id long, label int")
    cfg = quality.QualityConfig(k=3, max_neighbours=20)
    model = quality.fit(docs, labels, cfg)
    assert len(model.labels) == 20
    assert {r["doc_id"]: r["predicted"] for r in quality.score(docs, model, cfg).collect()} == {i: i % 2 for i in range(30)}


def test_votes_are_the_exact_nearest_neighbours(spark):
    rng = np.random.default_rng(1)
    cfg = quality.QualityConfig(k=5)
    unit = lambda x: (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)
    model = quality.QualityModel(None, None, unit(rng.normal(size=(60, 6))), rng.integers(0, 2, 60).astype(np.float32), 0.5)
    queries = unit(rng.normal(size=(20, 6)))
    got = quality.vote(queries, model, cfg)
    for q, s in zip(queries, got):
        cos = model.vectors @ q
        near = np.argsort(-cos)[:5]
        w = np.maximum(cos[near], 0).astype(float) ** cfg.power
        assert abs((w * model.labels[near]).sum() / w.sum() - s) < 1e-5


def test_equally_near_neighbours_vote_by_row():
    """Groups of equal vectors with labels of both kinds: the smaller rows vote, whatever the batch."""
    rng = np.random.default_rng(6)
    for case in range(60):
        base = rng.normal(size=(4, 6))
        base /= np.linalg.norm(base, axis=1, keepdims=True)
        own = rng.integers(0, 4, 40)
        model = quality.QualityModel(None, None, base[own].astype(np.float32), rng.integers(0, 2, 40).astype(np.float32), 0.5)
        cfg = quality.QualityConfig(k=int(rng.integers(1, 30)))
        queries = np.vstack([base[rng.integers(0, 4, 3)], rng.normal(size=(4, 6))])
        queries /= np.linalg.norm(queries, axis=1, keepdims=True)
        got = quality.vote(queries, model, cfg)
        for i, (q, s) in enumerate(zip(queries, got)):
            cos = np.round((model.vectors.astype(float) @ q), 5)
            near = np.lexsort([np.arange(40), -cos])[:cfg.k]
            w = np.maximum((model.vectors.astype(float) @ q)[near], 0) ** cfg.power
            assert abs((w * model.labels[near]).sum() / w.sum() - s) < 1e-4 if w.sum() > 1e-9 else True
            assert quality.vote(queries[i:i + 1], model, cfg)[0] == s


def test_score_does_not_hang_on_batch_or_partitions(spark):
    sf = "/root/testdata/sf0.01"
    docs = table(spark, sf, "documents").select("doc_id", "text")
    model = quality.fit(docs, quality_labels(spark, sf))
    some = [r["text"] for r in docs.orderBy("doc_id").limit(120).collect()] + [None, "", "x", "!!"]
    cfg = quality.QualityConfig()
    whole = quality.score_texts(some, model, cfg)
    assert [quality.score_texts([t], model, cfg)[0] for t in some] == list(whole)
    assert list(quality.score_texts(some[::-1], model, cfg)[::-1]) == list(whole)
    first = None
    for parts in (1, 7, 64):
        got = {r["doc_id"]: (r["score"], r["predicted"]) for r in quality.score(docs.repartition(parts), model).collect()}
        first = first or got
        assert got == first


def test_labels_never_come_from_held_out_rows(spark):
    labels = quality_labels(spark, "/root/testdata/sf0.01")
    assert labels.where(held_out(F.col("doc_id"))).count() == 0


def test_too_many_languages_raise(spark, docs):
    with pytest.raises(ValueError, match="languages"):
        langid.fit(docs, F.col("doc_id").cast("string"), F.lit(True), langid.LangIdConfig(max_languages=3))


def test_quality_terms_of_long_texts():
    """Counted in pieces of any length, a text has the counts that it has as a whole."""
    rng = np.random.default_rng(3)
    letters = list("abcABC  \n\t1.,é日\u2003") + ["the ", " the the "]
    texts = ["".join(rng.choice(letters, size=n)) for n in (1, 2, 3, 50, 400)] + ["", " ", "x" * 300, " " * 300, "a b " * 90, "ab\n"]
    for text, whole in zip(texts, quality.term_counts(texts)):
        for piece in (1, 2, 3, 7, 100, 1000):
            np.testing.assert_array_equal(quality.long_term_counts(text, piece).astype(np.float32), whole)
    mixed = ["short one", "word and word " * 40_000, "another"]
    assert len(mixed[1]) > quality.BLOCK_CHARS
    got = quality.term_counts(mixed)
    np.testing.assert_array_equal(got[[0, 2]], quality.term_counts(mixed[::2]))
    np.testing.assert_array_equal(got[1], quality.long_term_counts(mixed[1], 10_000).astype(np.float32))
