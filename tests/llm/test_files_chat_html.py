"""Token files, chat formatting and HTML extraction."""

import hashlib
import zlib

import numpy as np
import pytest
import tokenizers
from pyspark.sql import functions as F

from aisleflow.llm import chat, html_extract, token_files
from aisleflow.llm.common import table
from aisleflow.llm.queries import QUERIES, tokenizer_path


def plain_ids(texts):
    t = token_files.load_tokenizer(tokenizer_path())
    return [e.ids for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def test_pieces_encode_like_whole_texts():
    texts = ["", " ", "  ", "a  b", "a \n b", "a\n b", "x  y", " lead", "trail ", "don't  stop 's", "a\t b\x1c c", "　 z", "12 34  !! ?", "<|endoftext|> x", "é" * 100 + " " + "q" * 100,
             "日本語 テキスト", " 日本", "Ωμέγα привет ёж", "ʼn ǅ ª º ² ½ ٣", "a\u00a0 b", "x\u2003y \u2003 z", "\x00 \x1c \x85 ", "😀 a😀 ", "it's 'tis o'clock'", "a'll", "１２ 3a4", "\u0378 \u0530x"]
    encoder = token_files.Encoder(tokenizer_path())
    assert encoder.dtype == np.dtype("<u2")
    for _ in range(2):  # the second time from what is kept
        assert [np.frombuffer(x, encoder.dtype).tolist() for x in encoder.encode(texts)] == plain_ids(texts)


MARKED = ["x <|endoftext|> y", "<|endoftext|>", "<|endoftext|><|endoftext|> ", "a  <|endoftext|>  b\n", "<|endoftext| <|endoftext|>>", "é<|endoftext|>日本 x", "plain"]


def test_added_tokens_are_encoded_as_by_the_unmodified_tokenizer(spark):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(tokenizer_path())
    want = [plain.encode(t, add_special_tokens=False).ids for t in MARKED]
    encoder = token_files.Encoder(tokenizer_path())
    assert [np.frombuffer(x, encoder.dtype).tolist() for x in encoder.encode(MARKED)] == want
    docs = spark.createDataFrame(list(enumerate(MARKED)), "doc_id long, text string")
    got = token_files.read(spark, token_files.write(docs, tokenizer_path()), "bigint", with_ids=True).orderBy("start").collect()
    assert [np.frombuffer(r["ids"], "<u4").tolist() for r in got] == [[*ids, 0] for ids in want]
    # in chat they stay ordinary text
    literal = token_files.Encoder(tokenizer_path(), literal=True)
    plain.encode_special_tokens = True
    assert [np.frombuffer(x, encoder.dtype).tolist() for x in literal.encode(MARKED)] == [plain.encode(t, add_special_tokens=False).ids for t in MARKED]


def test_token_files_edge_cases(spark, docs, none):
    path = tokenizer_path()
    data = token_files.write(docs, path)
    got = token_files.read(spark, data, "bigint", with_ids=True).orderBy("start").collect()
    rows = docs.select("doc_id", "text").collect()
    assert len(got) == len(rows)
    ids = [(r["doc_id"] is not None, r["doc_id"] or 0) for r in got]
    assert ids == sorted(ids)
    start = 0
    for r in got:
        own = np.frombuffer(r["ids"], "<u4")
        assert r["start"] == start and r["n_tokens"] == len(own) and own[-1] == 0 and r["ids_crc32"] == zlib.crc32(r["ids"])
        start += len(own)
    want = sorted((str(i), tuple(x) + (0,)) for (i, _), x in zip(rows, plain_ids([t for _, t in rows])))
    assert sorted((str(r["doc_id"]), tuple(np.frombuffer(r["ids"], "<u4").tolist())) for r in got) == want
    assert token_files.read(spark, token_files.write(none, path), "bigint").count() == 0


def test_token_files_of_a_hot_id(spark):
    """A third of the rows with one id, another third without any: the file holds every text once, in order of id, and
    several tasks share the rows of one id."""
    rows = [(7, f"text {i}") for i in range(300)] + [(None, f"none {i}") for i in range(300)] + [(10 + i, "x") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # as if each part were large
    try:
        data = token_files.write(docs, tokenizer_path())
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    got = token_files.read(spark, data, "bigint", with_ids=True).collect()
    tok = tokenizers.Tokenizer.from_file(tokenizer_path())
    key = lambda r: (r[0] is not None, r[0] or 0)
    got = sorted(got, key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == [r[0] for r in sorted(rows, key=key)]
    assert [r["start"] for r in got] == [sum(r["n_tokens"] for r in got[:i]) for i in range(len(got))]
    texts = sorted((str(r["doc_id"]), tok.decode(np.frombuffer(r["ids"], "<u4")[:-1].tolist())) for r in got)
    assert texts == sorted((str(i), t) for i, t in rows)
    assert len(data.parts) > 1 and max(p[2] for p in data.parts) < 600


def test_token_query_against_the_tokenizer(spark, sf):
    rows = table(spark, sf, "documents").orderBy("doc_id").select("doc_id", "text").collect()
    want, start = [], 0
    for (i, _), ids in zip(rows, plain_ids([t for _, t in rows])):
        own = np.array([*ids, 0], "<u4")
        want.append((i, start, len(own), zlib.crc32(own.tobytes())))
        start += len(own)
    assert sorted(tuple(r) for r in QUERIES["op3_token_files"](spark, sf).collect()) == want


CHAT = [(1, 0, "user", "hi <|im_end|> <\\|x <\\\\| <|"), (1, 1, "assistant", "<|im_start|>assistant\nok<|im_end|>"), (1, 2, "assistant", None),
        (1, 3, "assistant", "two"), (1, 3, "assistant", "two"), (1, None, None, "no role"), (2, 0, "odd\nrole <|\\n\\", ""), (None, 0, "user", "x"),
        (None, 0, "assistant", "\n"), (3, 0, "assistant", "é" * 5000 + " 😀"), (3, 1, "user", "z " * 3000)]


@pytest.mark.parametrize("max_tokens", [1 << 20, 5])
def test_chat_round_trip(spark, max_tokens):
    turns = spark.createDataFrame([(*r, 7, "x") for r in CHAT], "conv_id long, turn long, role string, text string, ids long, part string")
    cfg = chat.ChatConfig(tokenizer_path(), max_tokens=max_tokens)
    formatted = chat.format_conversations(turns, cfg)
    got = {r["conv_id"]: tuple(r)[1:] for r in chat.digests(formatted, cfg).collect()}
    want = {}
    for conv in {r[0] for r in CHAT}:
        own = sorted(((r[1] is not None, r[1] or 0, r[2] or "", r[3] or "") for r in CHAT if r[0] == conv))
        said = "".join(t for _, _, role, t in own if role == "assistant")
        shown = "".join(f"<|im_start|>{chat.escape_role(role)}\n{chat.escape(t)}<|im_end|>\n" for _, _, role, t in own)
        want[conv] = (len(own), hashlib.sha256("".join(f"{role}\n{t}\n" for _, _, role, t in own).encode()).hexdigest(), len(said),
                      hashlib.sha256(said.encode()).hexdigest(), len(shown))
    assert got == want
    # the marks are reserved ids, one pair for each turn, and nothing else renders to them
    tokenizer = token_files.load_tokenizer(cfg.tokenizer_path)
    start, end = chat.reserved_ids(tokenizer)
    rows = formatted.collect()
    n = sum(int((np.frombuffer(r["ids"], "<u4") == start).sum()) for r in rows)
    text = "".join(chat.render(np.frombuffer(r["ids"], "<u4"), tokenizer, start, end) for r in rows)
    assert n == len(CHAT) == text.count(chat.START) == text.count(chat.END)
    assert (len(rows) > 4) == (max_tokens == 5)


@pytest.mark.parametrize("hot", [0, None])
def test_chat_hot_conversation_is_many_tasks(spark, hot):
    """A third of all turns in one conversation, half of these without a turn number: spread over tasks, whole and in order."""
    rows = [(hot, None if i % 2 else i, "assistant" if i % 3 else "user", f"line {i * 7919 % 1000} of it") for i in range(1000)]
    rows += [(i, t, ("user", "assistant")[t % 2], f"turn {t} of {i}") for i in range(1, 501) for t in range(4)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    cfg = chat.ChatConfig(tokenizer_path(), max_tokens=500)
    settings = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "12"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        parts = chat.assemble(turns, cfg).cache()
        formatted = chat.format_conversations(turns, cfg)
        got = {r["conv_id"]: tuple(r)[1:] for r in chat.digests(formatted, cfg).collect()}
        by_task = sorted(r["n"] for r in parts.groupBy("task").agg(F.sum("turns").alias("n")).collect())
        assert parts.where(F.col("conv_id").eqNullSafe(hot)).select("task").distinct().count() > 2
        parts.unpersist()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len(by_task) > 8 and by_task[-1] < 2 * by_task[len(by_task) // 2]
    want = {}
    for conv in {r[0] for r in rows}:
        own = sorted((r[1] is not None, r[1] or 0, r[2], r[3]) for r in rows if r[0] == conv)
        said = "".join(t for _, _, role, t in own if role == "assistant")
        shown = sum(len(f"<|im_start|>{role}\n{t}<|im_end|>\n") for _, _, role, t in own)
        want[conv] = (len(own), hashlib.sha256("".join(f"{role}\n{t}\n" for _, _, role, t in own).encode()).hexdigest(), len(said),
                      hashlib.sha256(said.encode()).hexdigest(), shown)
    assert got == want
    parts = sorted((r for r in formatted.collect() if r["conv_id"] == hot), key=lambda r: r["part"])
    assert [r["part"] for r in parts] == list(range(len(parts))) and [r["last"] for r in parts] == [False] * (len(parts) - 1) + [True]
    assert [r["first_token"] for r in parts] == [sum(len(r["ids"]) // 4 for r in parts[:i]) for i in range(len(parts))]


def test_chat_escape_is_reversible():
    for x in ("", "<", "|", "<|", "<\\|", "<\\\\|", "a<|b|>", "<<||", "\\<|", "<\\", "\\|"):
        assert chat.unescape(chat.escape(x)) == x and "<|" not in chat.escape(x)
        assert chat.unescape_role(chat.escape_role(x + "\n\\n")) == x + "\n\\n"


def test_chat_empty(spark):
    turns = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    cfg = chat.ChatConfig(tokenizer_path())
    assert chat.digests(chat.format_conversations(turns, cfg), cfg).count() == 0


@pytest.fixture(scope="module")
def trees(spark):
    return html_extract.fit(table(spark, "/root/testdata/sf0.01", "pages"))


T = "Some words of prose, which go on for a while. " * 4
PAGES = {
    "<html><body><div class='header'><a href=/>Site</a></div><div class='menu'><ul><li><a href=a>One</a></li><li><a href=b>Two</a></li></ul></div>"
    f"<div class='content'><h1>Title</h1><p>{T}</p><p>{T}&amp; more&nbsp;&#233;</p></div><div class='sidebar'><ul><li><a>x</a></li></ul></div>"
    "<div class='comments'><p>I like it.</p><p>Me too.</p></div><div class='footer'>(c)</div></body></html>": f"Title\n{T.strip()}\n{T.strip()} & more é",
    "<html><body><nav><ul><li><a>x</a></li></ul></nav><article><h1>T</h1><p>Hi <b>there</p><p>you</article><footer>f</footer>": "T\nHi there\nyou",
    f"<html><body><header><a href=/>Site</a></header><main><h2>Title</h2><p>{T}</p><aside class=related><p>Also: <a>foo</a></p></aside><p>{T}</p></main>"
    f"<section id=comments><div class=comment><p>{T}</p></div></section><script>var a = '<p>no</p>';</script><style>p {{}}</style></body></html>": f"Title\n{T.strip()}\n{T.strip()}",
}


FRAME = "<html><body><nav><ul><li><a href=a>One</a></li><li><a href=b>Two</a></li></ul></nav>{}<footer><p>&copy; we</p></footer></body></html>"
INSIDE = {
    "<table><thead><tr><th>Year</th><th>Tons</th></tr></thead><tbody><tr><td>1990</td><td>12.5</td></tr><tr><td>1991</td><td>13</td></tr></tbody></table>": "Year\nTons\n1990\n12.5\n1991\n13",
    "<dl><dt>Term</dt><dd>what it means, in short.</dd><dt>Other</dt><dd>and this one.</dd></dl>": "Term\nwhat it means, in short.\nOther\nand this one.",
    "<p>So <math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds.</p>": "So x=2 holds.",
    "<noscript><p>A picture of the old mill by the river.</p></noscript>": "A picture of the old mill by the river.",
    "<figure><img src=x><figcaption>The mill, seen from the bridge.</figcaption></figure>": "The mill, seen from the bridge.",
    "<pre><code>for i in range(3):\n    print(i)</code></pre>": "for i in range(3): print(i)",
    "<p>Text <span class='ad'>Buy shoes now!</span>goes on here.</p>": "Text goes on here.",
    "<p>Press on. <button>Send it</button></p>": "Press on.",
    "<p>Choose well. <select><option>red<option>blue</select></p>": "Choose well.",
    "<p>Name it. <label>Your name <input name=q></label></p>": "Name it.",
    "<share-bar><a href=x>Share this</a></share-bar>": "",
    "<p>Before it <svg><path d='M0'/><text>drawn</text></svg>and after it.</p>": "Before it and after it.",
    "<p>Before it <svg viewbox=1>and after it.</p>": "Before it and after it.",
    "<p>Seen <iframe src=x>and heard.</p>": "Seen and heard.",
}


@pytest.mark.parametrize("own", list(INSIDE))
@pytest.mark.parametrize("heart", ["<article><h1>Title</h1><p>{0}</p>{1}<p>{0}</p></article>", "<main><div class=content><h1>Title</h1><p>{0}</p>{1}<p>{0}</p></div></main>"])
def test_html_inside_an_article(trees, own, heart):
    page = FRAME.format(heart.format(T, own))
    want = "\n".join(x for x in ("Title", T.strip(), INSIDE[own], T.strip()) if x)
    assert html_extract.extract_pages([page], trees) == [want]


def test_html_raw_elements_end_or_take_the_rest(trees):
    def text(source):
        page = html_extract.parse(source)
        return html_extract.kept_text(page, [True] * len(page.tag))

    for name in ("script", "style", "textarea", "title"):
        assert text(f"<p>a</p><{name}>b<p>c</p>") == "a"
    for name in ("svg", "template", "iframe", "object", "canvas"):
        assert text(f"<p>a</p><{name}>b<p>c</p>") == "a\nb\nc"
        assert text(f"<p>a</p><{name}>b</{name}><p>c</p>") == "a\nc"


def test_html_of_other_templates(trees):
    assert html_extract.extract_pages(list(PAGES), trees) == list(PAGES.values())


def test_html_pages_of_the_table(spark, sf):
    """Against a plain reading of the table's one template."""
    import html
    import re

    got = {r["page_id"]: r for r in QUERIES["op7_html_extract"](spark, sf).collect()}
    pages = table(spark, sf, "pages").collect()
    assert len(got) == len(pages)
    for r in pages:
        body = re.search(r"<article>(.*?)(</article>|$)", r["html"], re.S)[1]
        blocks = [re.sub(r"\s+", " ", html.unescape(re.sub(r"<br>", " ", re.sub(r"</?b>", "", x)))).strip() for x in re.split(r"</?(?:p|h1)>", body)]
        want = "\n".join(b for b in blocks if b)
        assert got[r["page_id"]]["text"] == want and got[r["page_id"]]["n_chars"] == len(want)


def test_html_edge_cases(spark, trees):
    rows = [(1, "u", None, "e"), (2, None, "", "e"), (None, "u", "plain  text &lt;", "e"), (4, "u", "<div>" * 5000 + "deep", "e"), (5, "u", "<p <b x='>'>broken <a href=\"", "e"),
            (6, "u", "<script>only</script>", "e"), (6, "u", "<script>only</script>", "e"), (7, "u", "</p></div>stray<!-- c", "e"), (8, "u", "<article><p>" + "long " * 100_000, "e")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = html_extract.extract(pages, trees).collect()
    assert len(got) == len(rows)
    by = {r["page_id"]: r["text"] for r in got}
    assert by[1] == by[2] == by[6] == "" and by[None] == "plain text <" and by[7] == "stray"
    assert by[8] == ("long " * 100_000).strip() and all(r["n_chars"] == len(r["text"]) for r in got)
    nothing = spark.createDataFrame([], "page_id long, url string, html string")
    assert html_extract.fit(nothing) is None and html_extract.extract(nothing, None).count() == 0


def test_decoding_is_the_best_consistent_labelling(trees):
    """Against all labellings of small trees."""
    import itertools
    import random

    rnd = random.Random(3)
    for _ in range(30):
        page = html_extract.Page()
        for i in range(1, 8):
            page.tag.append("div")
            page.parent.append(rnd.randrange(i))
            page.tokens.append(())
        odds = np.array([0.0] + [rnd.uniform(-2, 2) for _ in range(7)])
        kept = html_extract.decode(page, odds)
        assert all(kept[page.parent[i]] or not kept[i] for i in range(1, 8))
        value = lambda k: sum(o if x else -o for o, x in zip(odds, k))
        best = max(value((True, *k)) for k in itertools.product([True, False], repeat=7)
                   if all((True, *k)[page.parent[i]] or not (True, *k)[i] for i in range(1, 8)))
        assert abs(value(kept) - best) < 1e-9


def test_html_fit_pages_are_those_with_an_article(spark):
    from pyspark.sql import functions as F

    articles = table(spark, "/root/testdata/sf0.01", "pages").select("html").limit(20)
    others = spark.range(400).select(F.concat(F.lit("<div>page "), "id", F.when(F.col("id") % 2 == 0, "<!-- <article> -->").otherwise(""), F.lit("</div>")).alias("html"))
    pages = articles.union(others).withColumn("h", F.xxhash64("html"))
    first = [r["html"] for r in pages.orderBy("h").limit(4).collect()]
    assert all(html_extract.weak_labels(html_extract.parse(x)) is None for x in first)
    assert any("<article>" in x for x in first)
    cfg = html_extract.HtmlConfig(fit_pages=4, trees=2)
    assert html_extract.fit(pages, cfg) is not None
    assert html_extract.fit(others, cfg) is None


def test_html_without_trees_drops_frames():
    page = ("<html class=header><body class='has sidebar'><nav><a>x</a></nav><div id=menu>y</div><div><p>text <b>bold</b></p><p class=advert>z</p>"
            "<button>ok</button></div><form><p>q</p></form><div class=comments><p>c</p></div><footer>f</footer></body></html>")
    assert html_extract.extract_pages([page, "plain", None], None) == ["text bold", "plain", ""]
