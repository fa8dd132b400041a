"""Phrase mining against plain counting."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from aisleflow.llm import phrases as P
from aisleflow.llm.phrases import PhraseConfig

UPPER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})
COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def pieces(text):
    for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(UPPER)):
        yield re.findall(r"[^\x20\x09]+", piece)


def expected(rows, cfg):
    n, f = Counter(), Counter()
    for lang, text in rows:
        lang = lang or "und" if lang is None else lang
        for ws in pieces(text):
            n[lang] += len(ws)
            for m in range(1, cfg.max_words + 1):
                f.update((lang, tuple(ws[i:i + m])) for i in range(len(ws) - m + 1))
    f = {k: a for k, a in f.items() if a >= cfg.min_count}
    out = {}
    for (lang, ws), a in f.items():
        if len(ws) < 2:
            continue
        longer = [b for (g, x), b in f.items() if g == lang and len(x) > len(ws) and any(x[i:i + len(ws)] == ws for i in range(len(x) - len(ws) + 1))]
        if any(100 * b >= cfg.drop_percent * a for b in longer):
            continue
        score, k = min((1000 * a * n[lang] // (f[lang, ws[:k]] * f[lang, ws[k:]]), k) for k in range(1, len(ws)))
        out.setdefault(lang, []).append((-score, -a, " ".join(ws).encode(), f[lang, ws[:k]], f[lang, ws[k:]]))
    return sorted((lang, i + 1, p.decode(), -a, lf, r, n[lang], -s) for lang, found in out.items()
                  for i, (s, a, p, lf, r) in enumerate(sorted(found)[:cfg.top]))


def corpus():
    rnd = random.Random(9)
    words = ["of", "the", "New", "york", "city", "Straße", "é", "日本", "a|b", "x" * 40, "<|z|>", "in\x00x", "word", "pa\xa0pa"]
    rows = []
    for i in range(150):
        lang = [None, "und", "en", "en", "en", "de"][i % 6]
        parts = []
        for _ in range(rnd.randint(0, 12)):
            parts += rnd.choices(words, k=rnd.randint(1, 6)) + [rnd.choice([".", ",", "\n", "\r\n", ";", "?!", "\x0b"])]
            if rnd.random() < 0.4:
                parts += ["NEW", "York", " city", "of", "\tthe"]
        rows.append((lang, " ".join(parts)))
    rows += [("en", "of the " * 300)] * 40  # one pair of words in most of all places
    rows += [("en", None), ("en", ""), ("de", " \t\n.,"), (None, None), ("fr", "alone")]
    rows.append(("en", " ".join(rnd.choices(words[:6], k=4000))))  # one long piece
    return rows


def frame(spark, rows):
    # ids are null or repeated, and columns carry names of the result
    return spark.createDataFrame([(None if i % 3 else 7, t, lang, 5, "x") for i, (lang, t) in enumerate(rows)],
                                 "doc_id long, text string, lang string, n long, phrase string").repartition(5)


@pytest.mark.parametrize("cfg", [
    PhraseConfig(min_count=8), PhraseConfig(min_count=5, shards=3, chunk_bytes=700, tally_rows=50, top=15),
    PhraseConfig(min_count=30, shards=1, rows_per_task=3), PhraseConfig(min_count=9, max_words=3, drop_percent=60, shards=20)])
def test_mine_is_plain_counting(spark, cfg):
    rows = corpus()
    got = sorted(tuple(r) for r in P.mine(frame(spark, rows), cfg).select(*COLUMNS).collect())
    want = expected(rows, cfg)
    assert got == want and len(want) > 20


def test_with_broadcast_off(spark):
    rows, cfg = corpus(), PhraseConfig(min_count=6, rows_per_task=4, chunk_bytes=300)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert sorted(tuple(r) for r in P.mine(frame(spark, rows), cfg).collect()) == expected(rows, cfg)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_edge_cases(spark, docs, none):
    cfg = PhraseConfig(min_count=3)
    rows = [(r["lang"], r["text"]) for r in docs.select("lang", "text").collect()]
    assert sorted(tuple(r) for r in P.mine(docs, cfg).collect()) == expected(rows, cfg)
    empty = P.mine(none, cfg)
    assert empty.columns == COLUMNS and empty.count() == 0
    assert P.mine(docs.where("text is null"), cfg).count() == 0


def test_small_bitmap_loses_nothing(spark):
    """A full bitmap lets all phrases through; the counts decide."""
    keys = spark.range(1000).selectExpr("id * 7919 as key")
    bitmap = P.bitmap_of(keys, PhraseConfig())
    want = np.arange(1000, dtype=np.uint64) * np.uint64(7919)
    assert P.in_bitmap(bitmap, want).all() and len(bitmap) == 1 << 17
    assert not P.in_bitmap(bitmap, want[:-1] + np.uint64(3)).any()
    assert P.in_bitmap(np.full(1 << 10, 255, np.uint8), want).all()


@pytest.mark.parametrize("size", [16, 33, 200, 5000])
def test_chunks_count_every_phrase_once(size):
    rnd = random.Random(size)
    text = "".join(rnd.choice(["ab", "c", "é", " ", "  ", "\t", "longer", ". " if rnd.random() < 0.1 else " "]) for _ in range(900))
    texts = [None, text.encode(), b"", b"x " * 40, b"y" * 300]
    got, cfg = Counter(), PhraseConfig(chunk_bytes=size)
    for w, rows in P.chunks(texts, cfg):
        for n in range(1, 6):
            for i in range(len(w.start) - n + 1):
                if w.piece[i] == w.piece[i + n - 1] and w.doc[i] == w.doc[i + n - 1] and i + n - 1 >= w.old:
                    got[int(rows[w.doc[i]]), w.text(i, n)] += 1
    want = Counter()
    for row, t in enumerate(texts):
        for ws in pieces((t or b"").decode()):
            for n in range(1, 6):
                want.update((row, " ".join(ws[i:i + n])) for i in range(len(ws) - n + 1))
    assert got == want


def test_sums_where_hashes_meet():
    """Different rows with one hash are summed apart, and the first of equals is named."""
    by = np.array([5, 5, 5, 5, 2, 5], np.uint64)
    own = np.array([1, 3, 1, 3, 1, 2], np.uint64)
    at, total = P._sums(by, [by, own], np.array([1, 10, 100, 1000, 7, 9]))
    assert sorted(zip(at.tolist(), total.tolist())) == [(0, 101), (1, 1010), (4, 7), (5, 9)]


def test_few_tasks_count_the_candidates(spark):
    from aisleflow.llm import phrases as P
    cfg = P.PhraseConfig(min_count=4)
    docs = spark.createDataFrame([(i, "red fox runs. old dog sleeps", "en") for i in range(64)], "doc_id long, text string, lang string").repartition(40)
    asked, sizes, real = [], [], P._map

    def watched(rows, make, bitmap, schema):
        asked.append(schema)
        sizes.append(rows.rdd.getNumPartitions())
        return real(rows, make, bitmap, schema)

    P._map = watched
    try:
        counts, totals = P.phrase_counts(docs, cfg)
        got = {r["phrase"]: r["f"] for r in counts.collect()}
    finally:
        P._map = real
    assert asked[-1].startswith("lang string") and sizes[-1] <= cfg.counting_tasks_per_core * spark.sparkContext.defaultParallelism < 40
    assert got["red fox runs"] == 64 and got["old dog"] == 64 and "runs old" not in got and totals.first()["n"] == 64 * 6
