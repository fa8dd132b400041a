"""HTML main-text extraction: gradient-boosted trees over DOM nodes.

1. A page is parsed into a tree of element nodes (scripts, styles and comments
   never become text; an element of the page's own is named by the parts of its tag).
2. Every node gets a row of features: tag, tokens of its class, id and role
   attributes, depth, statistics of its subtree (text length, density, share of link
   text, punctuation) and of its siblings and parent.
3. Gradient-boosted trees (``pyspark.ml``) give the log-odds that a node belongs
   to the article or contains it.  They are fitted on a bounded sample of pages,
   whose nodes are labelled by what unambiguous mark-up says (``<article>``, ``<nav>``,
   ``class="cookie-notice"`` ...), once as they are and once rebuilt with other frames
   around the same texts, where half of the frames carry no telling names, so that structure is
   learned too.
4. Hierarchical decoding picks the labelling of the whole tree with the
   greatest total log-odds among those where a dropped node has no kept descendant,
   by one pass from the leaves upwards and one downwards.
5. The kept text is cut into blocks at block-level elements; in each block white
   space becomes one space; blocks are joined by a newline.

The trees (a few hundred nodes) are broadcast as arrays and evaluated in numpy
over the nodes of a batch of pages.

Defined results: null and empty html give the empty text; so does a page without
text outside of scripts and the like.  If no page of the table has an article or main
element, there is nothing to fit on, and elements whose tag or names tell a frame are dropped
(but never html and body).  Unclosed and stray tags are
tolerated; a page without elements is one block of text.  Pages are handled one by
one: repeated pages give repeated rows, and extra columns are not read.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aisleflow.llm.common import ship


@dataclass(frozen=True)
class HtmlConfig:
    #: Pages of the bounded sample on which the trees are fitted.
    fit_pages: int = 120
    #: Rebuilt copies of each of them.
    copies: int = 5
    trees: int = 16
    depth: int = 5
    seed: int = 11


VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
#: Content of these is no mark-up and no text of the page; without an end tag they reach to the end of the page.
RAW = {"script", "style", "textarea", "title"}
#: Content of these is no text of the page; without an end tag, the tag alone is passed over.
APART = {"template", "iframe", "svg", "object", "canvas"}
#: Controls of forms, which the article is without whatever the trees say.
CONTROLS = {"button", "select", "label", "input", "option", "optgroup", "datalist", "output", "progress", "meter"}
BLOCK = {"address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "div", "dl", "dt",
         "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header", "hr", "html",
         "legend", "li", "main", "menu", "nav", "ol", "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th",
         "thead", "tr", "ul"}
#: An opening tag of the key closes open elements of the value up to the next container.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
          "option": {"option"}, "tbody": {"tbody", "thead", "tr", "td", "th"}, "tfoot": {"tbody", "thead", "tr", "td", "th"}}
CONTAINERS = {"ul", "ol", "dl", "table", "select", "menu", "body", "html", "div", "article", "section", "main", "aside", "nav", "#root"}

CONTENT_TAGS = {"article", "main"}
FRAME_TAGS = {"nav", "footer", "aside", "form", "menu", "header", "button", "select", "dialog", "label", "input"}
CONTENT_TOKENS = {"article", "body", "content", "entry", "main", "post", "story", "text"}
FRAME_TOKENS = {"ad", "ads", "advert", "advertisement", "banner", "breadcrumb", "breadcrumbs", "comment", "comments", "consent",
                "cookie", "cookies", "disqus", "footer", "form", "header", "login", "masthead", "menu", "modal", "nav", "navbar",
                "navigation", "newsletter", "notice", "pagination", "popup", "promo", "related", "replies", "reply", "respond",
                "search", "share", "sharing", "sidebar", "signup", "social", "sponsor", "sponsored", "subscribe", "tags",
                "toolbar", "widget"}

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<![^>]*>|<\?[^>]*>|<(/?)([a-zA-Z][^\s/>]*)"
                  r"((?>[^>=]+|=\s*\"[^\"]*\"|=\s*'[^']*'|=)*+)>", re.S)
_ATTRIBUTE = re.compile(r"(?<![\w-])(class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)", re.I)
_TOKEN = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_SPACE = re.compile(r"\s+")
_MARKS = re.compile(r"[.,;!?]")

TAG_FEATURES = ["article", "main", "section", "div", "p", "h1", "h2", "ul", "li", "a", "nav", "header", "footer", "aside", "form",
                "body", "blockquote", "pre", "table", "b"]
HASHED = 8
FEATURES = [f"tag_{t}" for t in TAG_FEATURES] + [
    "content_token", "frame_token", "frame_tag", "under_content", "under_frame", "depth", "log_text", "link_share", "log_elements",
    "text_per_element", "mark_share", "own_text_share", "paragraphs", "headings", "links", "sibling_at", "log_siblings",
    "sibling_text_share", "siblings_of_tag", "share_of_page", "before_share", "holds_content", "holds_h1"] + [f"token_{i}" for i in range(HASHED)]


class Page:
    """The elements of a page in document order; node 0 is the root.  ``pieces``
    are (node, text) and block breaks (node, None), in document order."""

    def __init__(self) -> None:
        self.tag, self.parent, self.tokens, self.pieces = ["#root"], [-1], [()], []


def parse(source: str) -> Page:
    page = Page()
    tags, parents, tokens, pieces = page.tag, page.parent, page.tokens, page.pieces
    stack = [0]
    open_count = {"#root": 1}
    unclosed: set[str] = set()
    at, n = 0, len(source)

    def close_top() -> None:
        t = tags[stack.pop()]
        open_count[t] -= 1
        if t in BLOCK:
            pieces.append((stack[-1], None))

    while at < n:
        m = _TAG.search(source, at)
        begin = m.start() if m else n
        if begin > at:
            pieces.append((stack[-1], source[at:begin]))
        if not m:
            break
        at = m.end()
        name = m[2]
        if name is None:
            continue
        name = name.lower()
        if m[1]:
            if open_count.get(name):
                while tags[stack[-1]] != name:
                    close_top()
                close_top()
            continue
        if name in RAW or name in APART:
            if not m[3].endswith("/") or name in RAW:
                if name not in unclosed:
                    end = re.compile(f"</{name}\\s*>", re.I).search(source, at)
                    if end:
                        at = end.end()
                    elif name in RAW:
                        at = n
                    else:
                        unclosed.add(name)  # nor will another one be closed further on
            continue
        if name in BLOCK and open_count.get("p"):
            # a block ends an open paragraph, with what is open in it
            i = len(stack) - 1
            while tags[stack[i]] not in CONTAINERS and tags[stack[i]] != "p":
                i -= 1
            if tags[stack[i]] == "p":
                while len(stack) > i:
                    close_top()
        closes = CLOSES.get(name)
        if closes:
            i = len(stack) - 1
            while tags[stack[i]] not in CONTAINERS and tags[stack[i]] not in closes:
                i -= 1
            if tags[stack[i]] in closes:
                while len(stack) > i:
                    close_top()
        if name in BLOCK:
            pieces.append((stack[-1], None))
        elif name == "br":
            pieces.append((stack[-1], " "))
        if name in VOID:
            continue
        found = tuple(t.lower() for _, v in _ATTRIBUTE.findall(m[3]) for t in _TOKEN.findall(v)) if m[3] else ()
        if "-" in name:  # an element of the page's own, named by what it is
            found = (*_TOKEN.findall(name), *found)
        tags.append(name)
        parents.append(stack[-1])
        tokens.append(found)
        if not m[3].endswith("/"):
            stack.append(len(tags) - 1)
            open_count[name] = open_count.get(name, 0) + 1
    return page


def _token_slot(token: str) -> int:
    import zlib

    return zlib.crc32(token.encode()) % HASHED


def features(page: Page) -> np.ndarray:
    """(nodes, FEATURES).  Nodes come before their descendants, so sums over
    subtrees are one pass backwards."""
    n = len(page.tag)
    parent = page.parent
    own_text, own_marks, before = np.zeros(n), np.zeros(n), np.zeros(n)
    seen = 0
    for node, text in page.pieces:
        if text:
            k = len(text.strip())
            if k:
                own_text[node] += k
                own_marks[node] += len(_MARKS.findall(text))
    tag, tokens = page.tag, page.tokens
    text, marks, elements = own_text.copy(), own_marks.copy(), np.ones(n)
    links, paragraphs, headings, anchors, with_h1, holds = (np.zeros(n) for _ in range(6))
    kids: list[list[int]] = [[] for _ in range(n)]
    is_content, is_frame, frame_tag = np.zeros(n), np.zeros(n), np.zeros(n)
    for i in range(n):
        own = tokens[i]
        is_content[i] = tag[i] in CONTENT_TAGS or any(t in CONTENT_TOKENS for t in own)
        is_frame[i] = any(t in FRAME_TOKENS for t in own)
        frame_tag[i] = tag[i] in FRAME_TAGS
    for i in range(n - 1, 0, -1):
        t, up = tag[i], parent[i]
        if t == "a":
            links[i] = text[i]
            anchors[i] += 1
        elif t == "p":
            paragraphs[i] += 1
        elif t in ("h1", "h2", "h3"):
            headings[i] += 1
            with_h1[i] += t == "h1"
        for s in (text, marks, elements, links, paragraphs, headings, anchors, with_h1):
            s[up] += s[i]
        holds[up] += holds[i] + (tag[i] in CONTENT_TAGS)
        kids[up].append(i)
    depth, under_content, under_frame = np.zeros(n), np.zeros(n), np.zeros(n)
    sibling_at, siblings, sibling_text, of_tag = np.zeros(n), np.ones(n), np.ones(n), np.ones(n)
    for i in range(n):
        run = before[i]
        own = kids[i][::-1]
        total = text[i]
        count: dict[str, int] = {}
        for k in own:
            count[tag[k]] = count.get(tag[k], 0) + 1
        for at, k in enumerate(own):
            depth[k] = depth[i] + 1
            under_content[k] = under_content[i] or is_content[i]
            under_frame[k] = under_frame[i] or is_frame[i] or frame_tag[i]
            sibling_at[k] = at / len(own)
            siblings[k] = len(own)
            sibling_text[k] = text[k] / total if total else 0
            of_tag[k] = count[tag[k]] / len(own)
            before[k] = run
            run += text[k]
    page_text = max(1.0, text[0])
    whole = np.maximum(1.0, text)
    columns = [[t == x for t in tag] for x in TAG_FEATURES] + [
        is_content, is_frame, frame_tag, under_content, under_frame, np.minimum(depth, 20), np.log1p(text), links / whole, np.log(elements),
        np.log1p(text / elements), marks / whole, own_text / whole, np.log1p(paragraphs), np.log1p(headings), np.log1p(anchors), sibling_at,
        np.log(siblings), sibling_text, of_tag, text / page_text, before / page_text, holds > 0, with_h1 > 0]
    hashed = np.zeros((HASHED, n))
    for i, own in enumerate(tokens):
        for t in own:
            hashed[_token_slot(t), i] = 1
    return np.vstack([np.array(columns, float), hashed]).T


# ------------------------------------------------------------------- training

def weak_labels(page: Page) -> list[int] | None:
    """What unambiguous mark-up says of each node: 1 article or around it, 0
    frame; None for a page without an article element."""
    n = len(page.tag)
    hearts = [i for i in range(n) if page.tag[i] == "article"] or [i for i in range(n) if page.tag[i] == "main"]
    if not hearts:
        return None
    out = [0] * n
    frame, inside = [False] * n, [False] * n
    hearts_set = set(hearts)
    for i in range(n):
        up = page.parent[i]
        inside[i] = i in hearts_set or up >= 0 and inside[up]
        titled = page.tag[i] == "header" and inside[i]  # the article's own title
        frame[i] = up >= 0 and frame[up] or (page.tag[i] in FRAME_TAGS and not titled) \
            or (i not in hearts_set and any(t in FRAME_TOKENS for t in page.tokens[i]))
        out[i] = int(inside[i] and not frame[i])
    for i in hearts:
        while i >= 0 and not frame[i]:
            out[i] = 1
            i = page.parent[i]
    return out


def reframed(page: Page, labels: list[int], rng) -> tuple[Page, list[int]]:
    """The same blocks of text in another frame, and the labels of its nodes."""
    blocks, frame, links = [], [], []
    text_of: dict[int, str] = {}
    for node, text in page.pieces:
        if text and text.strip():
            text_of[node] = text_of.get(node, "") + text
    for node, text in text_of.items():
        up = node
        while up > 0 and page.tag[up] not in BLOCK:
            up = page.parent[up]
        (blocks if labels[node] else links if page.tag[node] == "a" else frame).append((page.tag[up], text))
    if not blocks:
        return page, labels
    pick = lambda *x: x[rng.integers(len(x))]
    chance = lambda p: rng.random() < p
    telling = chance(0.7)
    name = lambda *x: f' {pick("class", "class", "id")}="{pick(*x) if telling else f"c{rng.integers(99)}"}"'
    spare = [html.escape(t[1]) for t in frame] or ["Copyright"]
    sentence = lambda top=200: pick(*spare)[: int(rng.integers(5, top))]
    some = [html.escape(t[1]) for t in links] or ["home", "news", "about"]
    link = lambda: f'<a href="/x">{pick(*some)}</a>'
    menu = lambda: pick("<ul>" + "".join(f"<li>{link()}</li>" for _ in range(rng.integers(2, 10))) + "</ul>",
                        "".join(link() + pick(" ", " | ") for _ in range(rng.integers(2, 8))))
    if chance(0.4):  # a short article
        blocks = [(t, x[: int(rng.integers(3, 120))].strip() or x) for t, x in blocks[: int(rng.integers(1, 5))]]
    title = pick("h1", "h2")
    blocks = [(title if t == "h1" else t, x) for t, x in blocks]
    words = html.escape(" ".join(b[1] for b in blocks)).split()
    quote = lambda: " ".join(words[(k := int(rng.integers(max(1, len(words) - 12)))):k + int(rng.integers(3, 40))])
    kept = ("h1", "h2", "h3", "blockquote", "pre")
    known = [x for _, x in blocks]

    def parts(text: str) -> list[str]:
        """The text in cells of a few words, each known as the article's."""
        own, step = text.split(), int(rng.integers(1, 8))
        cells = [" ".join(own[i:i + step]) for i in range(0, len(own), step)]
        known.extend(cells)
        return [html.escape(c) for c in cells]

    def in_table(text: str) -> str:
        cells, width = parts(text), int(rng.integers(1, 5))
        rows = ["".join(f"<td>{c}</td>" for c in cells[i:i + width]) for i in range(0, len(cells), width)]
        return f"<table>{pick('', '<tbody>')}" + "".join(f"<tr>{r}</tr>" for r in rows) + "</table>"

    def in_list(text: str) -> str:
        cells = parts(text)
        return "<dl>" + "".join(f"<{'dd' if i % 2 else 'dt'}>{c}</{'dd' if i % 2 else 'dt'}>" for i, c in enumerate(cells)) + "</dl>"

    def as_block(t: str, text: str) -> str:
        t, x = t if t in kept else "p", html.escape(text)
        if t == "p" and text.split() and chance(0.25):
            return pick(in_table, in_list, lambda _: f"<figure><img src='/i'><figcaption>{x}</figcaption></figure>",
                        lambda _: f"<pre>{x}</pre>", lambda _: f"<pre><code>{x}</code></pre>")(text)
        if t == "p" and chance(0.1):  # an advert inside the line
            return f"<p><span{name('ad', 'advert', 'promo', 'share', 'sponsored')}>{sentence(40)}</span>{x}</p>"
        return f"<{t}>{x}</{t}>"

    written = [as_block(t, x) for t, x in blocks]
    if chance(0.3) and written[0].startswith("<h"):
        written[0] = f"<header>{written[0]}</header>"
    if chance(0.3):
        written[-1] = "<ul>" + "".join(f"<li>{html.escape(x)}</li>" for x in [blocks[-1][1]]) + "</ul>"
    ad = lambda: f"<{(t := pick('div', 'aside', 'section'))}{name('ad', 'advert', 'sponsored', 'promo', 'ads')}>{pick('', '<p>')}{sentence()}</{t}>"
    form = lambda: f"<form{name('newsletter', 'search', 'login', 'subscribe')}><label>{sentence(30)}</label><input name='q'>{pick('', '<p>' + sentence(60) + '</p>')}<button>{sentence(12)}</button></form>"
    notice = lambda: f"<div{name('cookie-notice', 'consent', 'banner', 'notice', 'popup')}>{pick('', '<p>')}{sentence()}{pick('', '<button>OK</button>')}</div>"
    related = lambda: f"<{(t := pick('aside', 'div', 'section'))}{name('related', 'sidebar', 'widget', 'related-posts')}><h3>{sentence(20)}</h3>{pick(menu(), '<p>' + sentence() + link() + '</p>', menu() + '<p>' + quote() + '</p>')}</{t}>"
    share = lambda: f"<div{name('share', 'social', 'tags')}>{menu()}</div>"

    def comments() -> str:
        t, item = pick("section", "div", "ol"), pick("div", "li", "p", "article")
        own = "".join(f"<{item}{pick(name('comment', 'reply'), '')}>" + (f"<b>{sentence(10)}</b><p>{quote()}</p>" if item in ("div", "article") and chance(0.7) else quote())
                      + f"</{item}>" for _ in range(rng.integers(1, 7)))
        return f"<{t}{name('comments', 'comment-list', 'replies', 'responses', 'disqus')}>{pick('', f'<h3>{sentence(15)}</h3>')}{own}{pick('', form())}</{t}>"

    inner = [x() for x in (ad, form, related, share, notice) if chance(0.2)]
    for x in inner:
        written.insert(int(rng.integers(1, len(written) + 1)), x)
    if chance(0.25):
        written.append(comments())
    heart = "".join(written)
    wrap = pick(f"<article>{heart}</article>", f"<article{name('post', 'article', 'entry')}><div{name('entry-content', 'article-body', 'text')}>{heart}</div></article>",
                f"<main>{heart}</main>", f"<main><div>{heart}</div></main>", f"<div{name('post-content', 'entry', 'story', 'content', 'main-content')}>{heart}</div>")
    top, menus = pick("header", "div"), pick("nav", "div")
    before = [f"<{top}{name('header', 'site-header', 'masthead')}>{pick('', '<h1>', '<h1>')}{pick(link(), sentence(30))}{pick('', '<p>' + sentence(60) + '</p>')}</{top}>",
              f"<{menus}{name('navbar', 'menu', 'main-menu', 'navigation', 'breadcrumbs')}>{menu()}</{menus}>", notice(), ad(), form(), related()]
    bottom = pick("footer", "div")
    after = [related(), comments(), share(), ad(), notice(), f"<{bottom}{name('footer', 'site-footer')}>{pick('', '<p>')}&copy; {sentence()}{pick('', menu())}</{bottom}>"]
    marked = "".join(x for x in before if chance(0.45)) + wrap + "".join(x for x in after if chance(0.45))
    if chance(0.5):
        marked = f"<div{name('wrapper', 'page', 'container')}>{marked}</div>"
    out = parse(f"<html><body>{marked}</body></html>")
    return out, _heart_labels(out, known)


def _heart_labels(page: Page, texts: list[str]) -> list[int]:
    """Labels of a rebuilt page: nodes that hold the article's blocks, and all above them."""
    known = {t for t in texts}
    out = [0] * len(page.tag)
    for node, text in page.pieces:
        if text and html.unescape(text) in known:
            i = node
            while i >= 0 and not out[i]:
                out[i] = 1
                i = page.parent[i]
    return out


@dataclass
class Trees:
    """Boosted trees as arrays, one row a tree: split feature (-1: leaf),
    threshold, children, and values already scaled to log-odds."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray

    def log_odds(self, rows: np.ndarray) -> np.ndarray:
        out = np.zeros(len(rows))
        every = np.arange(len(rows))
        for f, t, l, r, v in zip(self.feature, self.threshold, self.left, self.right, self.value):
            at = np.zeros(len(rows), np.int64)
            while True:
                split = f[at]
                inner = split >= 0
                if not inner.any():
                    break
                goes_left = rows[every, np.maximum(split, 0)] <= t[at]
                at = np.where(inner, np.where(goes_left, l[at], r[at]), at)
            out += v[at]
        return out


def _trees(model) -> Trees:
    """The node tables of a fitted ``GBTClassificationModel``."""
    tables = []
    for tree, weight in zip(model.trees, model.treeWeights):
        rows: list[list] = []

        def walk(node, rows=rows, weight=weight) -> int:
            at = len(rows)
            rows.append([-1, 0.0, 0, 0, 2.0 * weight * node.prediction()])
            if node.subtreeDepth() > 0:
                split = node.split()
                rows[at][:2] = [split.featureIndex(), split.threshold()]
                rows[at][2] = walk(node.leftChild())
                rows[at][3] = walk(node.rightChild())
            return at

        walk(tree._call_java("rootNode"))
        tables.append(rows)
    size = max(map(len, tables))
    cube = np.array([rows + [[-1, 0.0, 0, 0, 0.0]] * (size - len(rows)) for rows in tables], float)
    return Trees(cube[..., 0].astype(np.int64), cube[..., 1], cube[..., 2].astype(np.int64), cube[..., 3].astype(np.int64), cube[..., 4])


def fit(pages: DataFrame, cfg: HtmlConfig = HtmlConfig()) -> Trees | None:
    """Fit on at most ``fit_pages`` pages (of those that ``weak_labels`` finds an
    article in, the ones with the smallest hash of the html).  None if there is none."""
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.functions import array_to_vector

    spark = pages.sparkSession
    ship(spark)
    seed, copies = cfg.seed, cfg.copies
    chosen = pages.select("html", F.xxhash64("html").alias("h")).where("html is not null and html <> ''")
    # may hold one of CONTENT_TAGS; whether it does only the parser can tell
    likely = chosen.where(F.col("html").rlike("(?i)<(article|main)"))

    def labelled(batches):
        import pyarrow as pa

        for batch in batches:
            own = [h for source, h in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) if any(weak_labels(parse(source)) or ())]
            yield pa.RecordBatch.from_arrays([pa.array(own, pa.int64())], names=["h"])

    # the smallest hashes first; while pages are missing, eight times the range of hashes
    lowest, highest = -(1 << 63), (1 << 63) - 1
    bound = likely.select("h").distinct().orderBy("h").limit(cfg.fit_pages).agg(F.max("h")).first()[0]
    below, found = None, []
    while bound is not None:
        some = likely.where(F.col("h") <= bound) if below is None else likely.where((F.col("h") > below) & (F.col("h") <= bound))
        found += [r["h"] for r in some.mapInArrow(labelled, "h long").distinct().orderBy("h").limit(cfg.fit_pages - len(found)).collect()]
        if len(found) >= cfg.fit_pages or bound == highest:
            break
        below, bound = bound, min(highest, lowest + 8 * (bound - lowest + 1))
    if not found:
        return None

    def rows(batches):
        import pyarrow as pa

        for batch in batches:
            xs, ys = [], []
            for source, h in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                page = parse(source)
                labels = weak_labels(page)
                if labels is None:
                    continue
                rng = np.random.default_rng([seed, h & 0x7FFFFFFF])
                for p, y in [(page, labels)] + [reframed(page, labels, rng) for _ in range(copies)]:
                    x = features(p)
                    xs.append(x)
                    ys.append(np.array(y, float))
            if xs:
                x = np.vstack(xs)
                values = pa.ListArray.from_arrays(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32), x.ravel())
                yield pa.RecordBatch.from_arrays([values, pa.array(np.concatenate(ys))], names=["x", "label"])

    # equal pages count once
    one = chosen.where(F.col("h").isin(found)).groupBy("h").agg(F.first("html").alias("html")).select("html", "h")
    nodes = one.mapInArrow(rows, "x array<double>, label double").select(array_to_vector("x").alias("features"), "label").persist()
    try:
        kinds = nodes.select("label").distinct().count()
        if kinds < 2:
            return None
        boosted = GBTClassifier(featuresCol="features", labelCol="label", maxIter=cfg.trees, maxDepth=cfg.depth, stepSize=0.3,
                                maxBins=32, seed=cfg.seed).fit(nodes)
        return _trees(boosted)
    finally:
        nodes.unpersist()


# ------------------------------------------------------------------- decoding

def decode(page: Page, odds: np.ndarray) -> list[bool]:
    """The labelling with the greatest total log-odds in which no kept node is
    below a dropped one.  Inline elements follow the block they are in, but for those that
    tag or names call a frame, which have their own odds; controls are dropped."""
    n = len(page.tag)
    keep_gain, drop_gain = [0.0] * n, [0.0] * n
    for i in range(n - 1, -1, -1):
        t = page.tag[i]
        if t in CONTROLS:
            s = -1e6
        elif t in BLOCK or t in FRAME_TAGS or any(x in FRAME_TOKENS for x in page.tokens[i]):
            s = float(odds[i])
        else:
            s = 0.0
        keep_gain[i] += s
        drop_gain[i] -= s
        if i:
            up = page.parent[i]
            keep_gain[up] += max(keep_gain[i], drop_gain[i])
            drop_gain[up] += drop_gain[i]
    kept = [True] * n
    for i in range(1, n):
        kept[i] = kept[page.parent[i]] and (keep_gain[i] >= drop_gain[i] or page.tag[i] == "html")
    return kept


def without_frames(page: Page) -> list[bool]:
    """Without trees: all but the elements that tag or tokens call a frame, and what is in them."""
    kept = [True] * len(page.tag)
    for i in range(1, len(kept)):
        frame = page.tag[i] in FRAME_TAGS or any(t in FRAME_TOKENS for t in page.tokens[i])
        kept[i] = kept[page.parent[i]] and (not frame or page.tag[i] in ("html", "body"))
    return kept


def kept_text(page: Page, kept: list[bool]) -> str:
    out, block = [], []

    def end() -> None:
        text = _SPACE.sub(" ", html.unescape("".join(block))).strip()
        if text:
            out.append(text)
        block.clear()

    for node, text in page.pieces:
        if text is None:
            end()
        elif kept[node]:
            block.append(text)
    end()
    return "\n".join(out)


def extract_pages(sources: list, trees: Trees | None) -> list[str]:
    pages = [parse(s or "") for s in sources]
    if trees is None:
        return [kept_text(p, without_frames(p)) for p in pages]
    rows = [features(p) for p in pages]
    odds = np.split(trees.log_odds(np.vstack(rows)), np.cumsum([len(r) for r in rows])[:-1]) if rows else []
    return [kept_text(p, decode(p, o)) for p, o in zip(pages, odds)]


def extract(pages: DataFrame, trees: Trees | None) -> DataFrame:
    """page_id, url, text, n_chars for every row."""
    spark: SparkSession = pages.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(trees)
    schema = ", ".join(f"{c} {pages.schema[c].dataType.simpleString()}" for c in ("page_id", "url")) + ", text string, n_chars long"

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for i in range(0, batch.num_rows, 200):
                part = batch.slice(i, 200)
                texts = extract_pages(part.column(2).to_pylist(), shared.value)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                                                 names=["page_id", "url", "text", "n_chars"])

    return pages.select("page_id", "url", "html").mapInArrow(run, schema)
