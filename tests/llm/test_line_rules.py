"""Line-frequency rules against brute force."""

import random
import re

import pytest
from pyspark.sql import functions as F

import nasty
from aisleflow.llm import line_rules
from aisleflow.llm.line_rules import LineRulesConfig

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({**{chr(i): chr(i + 32) for i in range(65, 91)}, **{c: "0" for c in "123456789"}, **{c: None for c in "\x20\t\x0b\f\r"}})


def expected(rows, cfg):
    """rows of (doc_id, text, host) -> sorted result rows, by plain loops."""
    held = {}
    for _, t, host in rows:
        for line in (t or "").split("\n"):
            if WORD.search(line):
                held.setdefault((host, line.translate(LOWER)), set()).add(t)
    out = []
    for i, t, host in rows:
        t = t or ""
        ws = WORD.findall(t)
        grams = {}
        for k in range(len(ws) - 2):
            grams.setdefault(tuple(ws[k:k + 3]), []).append(k)
        covered = {k + j for at in grams.values() if len(at) > 1 for k in at for j in range(3)}
        lines = [x for x in t.split("\n") if WORD.search(x)]
        gone = [x for x in lines if len(held[(host, x.translate(LOWER))]) > cfg.max_docs]
        left = len(ws) - sum(len(WORD.findall(x)) for x in gone)
        failed = len(ws) < cfg.min_words or 100 * len(covered) > cfg.max_repeat_percent * len(ws)
        kept = not failed and left >= cfg.min_words and 100 * left >= cfg.min_left_percent * len(ws)
        out.append((i, len(ws), sum(map(len, ws)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered),
                    failed, len(gone), left, kept))
    return sorted(out, key=str)


COLUMNS = ["doc_id", *line_rules.STATISTICS, "base_failed", "n_lines_removed", "n_words_left", "kept"]


def got(docs, cfg):
    return sorted((tuple(r) for r in line_rules.judge(docs, cfg).select(*COLUMNS).collect()), key=str)


@pytest.fixture(scope="module")
def site(spark):
    """Documents with a menu line, shared passages, copies, and one line in a third of all rows."""
    rnd = random.Random(11)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(1, 7)))
    line = lambda n: " ".join(word() for _ in range(n))
    menu, passage, foot = "Home  News 12 About", line(30), line(40)
    rows = []
    for i in range(240):
        host = None if i % 11 == 0 else "" if i % 13 == 0 else f"h{i % 3}"
        parts = [line(rnd.randint(3, 25)) for _ in range(rnd.randint(1, 6))]
        if i % 2:
            parts.insert(0, menu.replace("12", str(i)))
        if i % 3 == 0:
            parts.append(passage.upper() if i % 2 else passage)
        if i % 4 == 0:
            parts += [foot, "", foot]
        if i % 17 == 0:
            parts += [parts[0]] * 3
        rows.append((i, "\n".join(parts), host))
    rows += [(1000 + i, rows[5][1], "h0") for i in range(120)]  # copies of one text
    rows += [(None, rows[7][1], None), (7, rows[7][1], "h1"), (2000, None, "h1"), (2001, "", None), (2002, " \n\t", "h2"), (2003, "a b a b a b a b", "h2")]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(7)


@pytest.mark.parametrize("cfg", [LineRulesConfig(max_docs=4, min_words=20), LineRulesConfig(max_docs=30),
                                 LineRulesConfig(max_docs=4, min_words=5, rows_per_task=10)])
def test_judge_is_brute_force(spark, site, cfg):
    rows, docs = site
    want = expected(rows, cfg)
    assert got(docs, cfg) == want
    assert any(r[-3] for r in want)  # some lines go


def test_lines_are_spread_with_broadcast_off(spark, site):
    """A line and a text that hold a third of the rows, over tasks of few rows each."""
    rows, docs = site
    cfg = LineRulesConfig(max_docs=4, min_words=20, rows_per_task=8)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert got(docs, cfg) == expected(rows, cfg)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_copies_of_a_text_do_not_wear_it_out(spark):
    text = "\n".join(f"line {chr(97 + i)} of an article with words of its own, quite enough of them" for i in range(8))
    docs = spark.createDataFrame([(i, text, "h") for i in range(300)], "doc_id long, text string, source string")
    assert {(r["kept"], r["n_lines_removed"]) for r in line_rules.judge(docs, LineRulesConfig(max_repeat_percent=100)).collect()} == {(True, 0)}


def test_edge_cases(spark, docs, none):
    cfg = LineRulesConfig(max_docs=1, min_words=3)
    judged = line_rules.judge(docs, cfg)
    assert judged.columns == [*docs.columns, *line_rules.STATISTICS, "base_failed", "n_lines_removed", "n_words_left", "removed", "kept"]
    rows = [(r["doc_id"], r["text"], r["source"]) for r in docs.select("doc_id", "text", "source").collect()]
    assert got(docs, cfg) == expected(rows, cfg)
    assert line_rules.judge(none).count() == 0 and line_rules.clean(none).columns == none.columns
    # columns of the table named as results are replaced
    named = docs.withColumn("kept", F.lit("x")).withColumn("n_words", F.lit("y")).withColumn("removed", F.lit(1))
    assert got(named, cfg) == expected(rows, cfg)


def test_clean_texts(spark, site):
    rows, docs = site
    cfg = LineRulesConfig(max_docs=4, min_words=20)
    keep = {}
    for r in line_rules.judge(docs, cfg).where("kept").collect():
        gone = set(r["removed"])
        keep.setdefault((r["doc_id"], r["source"]), []).append("\n".join(x for i, x in enumerate(r["text"].split("\n")) if i not in gone))
    cleaned = {}
    for r in line_rules.clean(docs, cfg).collect():
        cleaned.setdefault((r["doc_id"], r["source"]), []).append(r["text"])
    assert cleaned == keep and len(keep) > 50
    assert any("\n" in t and "Home" not in t for ts in cleaned.values() for t in ts)


def test_very_long_text(spark):
    rnd = random.Random(3)
    long = " ".join(rnd.choice(["of", "the", "and", "a", "b", "c", "word", "some"]) + str(rnd.randint(0, 60)) for _ in range(400_000))
    rows = [(1, long, "h"), (2, "x" * 5_000_000, "h"), (3, "\n".join(["same line here"] * 100_000), "h")]
    cfg = LineRulesConfig(min_words=2, max_repeat_percent=100)
    assert got(spark.createDataFrame(rows, "doc_id long, text string, source string"), cfg) == expected(rows, cfg)


def test_native_plan(spark, docs):
    """DataFrame operations alone: no Python worker in the plan."""
    plan = line_rules.judge(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
