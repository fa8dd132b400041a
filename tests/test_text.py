import math

from pyspark.ml.feature import (IDF, CountVectorizer, StopWordsRemover, Tokenizer)
from pyspark.sql import functions as F

from aisleflow.functions.text import STOP_WORDS
from aisleflow.operators import text


def test_stop_words_equal_spark_default(spark):
    assert list(STOP_WORDS) == StopWordsRemover.loadDefaultStopWords("english")


def test_tokens_match_tokenizer(spark):
    docs = spark.createDataFrame(
        [(1, "Hello  World\tFoo\nbar "), (2, ""), (3, "   "), (4, "A,b. c"), (5, None),
         (6, "x\x0by\x0cz\rw")], "doc_id long, text string")
    long = text.token_rows(docs).collect()
    mine = {}
    for r in long:
        mine.setdefault(r["doc_id"], []).append((r["pos"], r["token"]))
    ref = Tokenizer(inputCol="text", outputCol="t").transform(docs.filter(F.col("text").isNotNull()))
    for r in ref.collect():
        want = list(enumerate(r["t"]))
        assert sorted(mine.get(r["doc_id"], [])) == want
    assert 5 not in mine                                # NULL text: no tokens


def test_idf_and_vocabulary_equal_spark(spark):
    docs = spark.createDataFrame(
        [(1, "the cat sat on the mat"), (2, "the dog sat"), (3, "a cat and a dog"), (4, "")],
        "doc_id long, text string")
    tok = text.token_rows(docs).filter("token <> ''")
    tf = text.term_frequencies(tok)
    idf = {r["term"]: r["idf"] for r in text.term_idf(tf, docs).collect()}
    # pyspark.ml on the same tokens (empty tokens removed, as in the long form)
    words = docs.select("doc_id", F.filter(F.split(F.lower("text"), " "), lambda t: t != "").alias("w"))
    cv = CountVectorizer(inputCol="w", outputCol="tf").fit(words)
    m = IDF(inputCol="tf", outputCol="x").fit(cv.transform(words))
    for i, term in enumerate(cv.vocabulary):
        assert math.isclose(idf[term], float(m.idf[i]), rel_tol=1e-12)
    vocab = text.term_vocabulary(tf).orderBy("term_index").collect()
    assert set(r["term"] for r in vocab) == set(cv.vocabulary)
    freqs = [r["freq"] for r in vocab]
    assert freqs == sorted(freqs, reverse=True)


def test_vocabulary_cap_and_min_df(spark):
    docs = spark.createDataFrame([(1, "a a b c"), (2, "a b"), (3, "a")], "doc_id long, text string")
    tf = text.term_frequencies(text.token_rows(docs))
    v = text.term_vocabulary(tf, vocab_size=2).collect()
    assert [(r["term"], r["term_index"]) for r in sorted(v, key=lambda r: r["term_index"])] == [("a", 0), ("b", 1)]
    assert text.term_vocabulary(tf).count() == 3
    v2 = text.term_vocabulary(tf, min_df=2).collect()
    assert sorted(r["term"] for r in v2) == ["a", "b"]


def test_stop_words_removed(spark):
    docs = spark.createDataFrame([(1, "The cat IS on the mat")], "doc_id long, text string")
    toks = [r["token"] for r in text.remove_stop_words(text.token_rows(docs)).orderBy("pos").collect()]
    assert toks == ["cat", "mat"]


def test_vocabulary_numbering_has_no_gaps(spark):
    rows = [(i, " ".join(f"{chr(97 + (i * k) % 26)}{k % 40}" for k in range(60))) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = [(r["freq"], r["term"], r["term_index"]) for r in text.term_vocabulary(text.term_frequencies(text.token_rows(docs))).collect()]
    assert [i for _, _, i in sorted(got, key=lambda x: (-x[0], x[1]))] == list(range(len(got)))


def test_vocabulary_numbering_over_many_partitions(spark):
    """Many terms of one frequency and beginning, over more partitions than rows in some."""
    terms = [(1, f"http://x/{i:05d}", 1) for i in range(3000)] + [(d, "all", 1) for d in range(50)] + [(d, "Z", 2) for d in range(25)]
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        tf = spark.createDataFrame(terms, "doc_id long, term string, tf long").repartition(16)
        got = sorted((r["term_index"], r["term"]) for r in text.term_vocabulary(tf).collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert got == list(enumerate(["Z", "all"] + [f"http://x/{i:05d}" for i in range(3000)]))


def test_hot_term_is_spread_and_exact(spark):
    """One term in half of all rows, broadcast off, 64 partitions: its rows are spread in proportion to their share,
    every other term has one copy, and the results are those of a plain computation."""
    from aisleflow.operators import skew
    names = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled"]
    old = {n: spark.conf.get(n) for n in names}
    for n, v in zip(names, ["-1", "64", "false"]):
        spark.conf.set(n, v)
    try:
        rows = [(i, "hot" if k == 0 else f"t{i}") for i in range(4000) for k in range(2)]
        tf = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, term string, tf long")
        idf = text.term_idf(tf, tf.select("doc_id").distinct())
        per_task = 8000 // 64
        joined = text.weigh(tf, idf, "doc_id", per_task)
        sizes = [r["count"] for r in joined.filter("term = 'hot'").groupBy(skew.SALT).count().collect()]
        assert sum(sizes) == 4000 and len(sizes) == 32 and max(sizes) < 2 * per_task
        # cold terms stand once on the per-term side
        salts = skew.spread_keys(idf, ["term"], "doc_freq", per_task).collect()
        assert [tuple(r) for r in salts] == [("hot", 32)]
        got = {(r["doc_id"], r["term"]): r["tfidf"] for r in text.doc_tfidf(tf, idf, rows_per_task=per_task).collect()}
        assert len(got) == 8000
        assert math.isclose(got[5, "t5"], math.log(4001 / 2)) and abs(got[5, "hot"]) < 1e-12
    finally:
        for n, v in old.items():
            spark.conf.set(n, v)


def test_share_join_with_own_loads_nulls_and_left(spark):
    from aisleflow.operators.skew import share_join
    rows = spark.createDataFrame([(i, None if i % 10 == 0 else i % 3) for i in range(300)], "id long, k long")
    per_key = spark.createDataFrame([(0, "a"), (1, "b"), (None, "n"), (9, "z")], "k long, v string")
    loads = rows.groupBy("k").count()
    want = sorted((i, {0: "a", 1: "b"}.get(i % 3) if i % 10 else None) for i in range(300))
    for per_task in (7, 1000):
        left = share_join(rows, per_key, ["k"], "count", F.col("id"), per_task, "left", loads=loads)
        assert sorted((r["id"], r["v"]) for r in left.collect()) == want
        inner = share_join(rows, per_key, ["k"], "count", F.col("id"), per_task, loads=loads)
        assert sorted((r["id"], r["v"]) for r in inner.collect()) == [w for w in want if w[1]]


def test_spread_keys_are_bounded(spark):
    """However low the rows a task should read, keys that are spread are fewer than the bound."""
    from aisleflow.operators.skew import spread_keys
    loads = spark.range(1000).selectExpr("id AS k", "id + 1 AS load")
    assert spread_keys(loads, ["k"], "load", 1, max_keys=50).count() < 50


def test_packed_documents_have_the_counts_of_their_rows(spark, monkeypatch):
    """Vectors from packs of any size: a key that comes twice has two vectors of its summed counts, a null key empty
    ones, whose words are in the vocabulary none the less; each term comes once a pack."""
    from aisleflow.plans import models as M
    rows = [(1, "a b b the c"), (1, "b d"), (2, None), (3, ""), (4, "  "), (None, "z b  b"), (None, "q"), (5, "the and"), (6, "c a")]
    docs = spark.createDataFrame(rows + [(i, f"w{i % 3} b b") for i in range(7, 30)], "k int, t string").repartition(2, "k")
    tf = M.word_counts(docs, "k", "t")
    want = sorted(map(str, text.term_vocabulary(tf).collect()))
    for limit in (1, 7, 1 << 20):
        monkeypatch.setattr(text, "PACK_ENTRIES", limit)
        packs = M.packed_counts(docs, tf, "k", "t")
        terms = [r["terms"] for r in packs.collect()]
        assert all(len(t) == len(set(t)) for t in terms) and (len(terms) <= 2) == (limit > 7)
        vocabulary = text.term_vocabulary(text.pack_terms(packs))
        assert sorted(map(str, vocabulary.collect())) == want
        names = {r["term_index"]: r["term"] for r in vocabulary.collect()}
        known = vocabulary.filter("term_index != 0")  # b is unknown
        got = [(r["k"], {names[int(i)]: v for i, v in zip(r["features"].indices, r["features"].values)})
               for r in M.pack_vectors(packs, docs, known, len(names), "k").collect()]
        assert len(got) == len(rows) - 1 + 23 and names[0] == "b"
        by_key = {k: [d for x, d in got if x == k] for k, _ in got}
        assert by_key[1] == [{"c": 1.0, "d": 1.0}] * 2 and by_key[None] == [{}] * 2
        assert by_key[3] == [{"": 1.0}] and by_key[4] == by_key[5] == [{}] and by_key[6] == [{"c": 1.0}]
        assert by_key[8] == [{"w2": 1.0}] and 2 not in by_key
