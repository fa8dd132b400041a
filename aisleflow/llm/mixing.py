"""Mixing sources to target weights by hierarchical budgeting.

The corpus is a tree of domains, languages and sources.  Every node has an
integer weight among its siblings, and a capacity: the tokens of its leaves
times ``max_epochs``.  From the root downwards a node's budget is shared among
its children in proportion to their weights; a child whose capacity is below its
share gets its capacity, and what it leaves goes to its siblings by weight.
As a node never gets more than its subtree can hold, a shortage is made good
among siblings first, and only what they all cannot take goes to the siblings
of their parent.  The arithmetic is in integers; the tokens that rounding leaves go one
each to the first unsaturated children by name.

A leaf with budget b and t tokens takes ``b div t`` whole epochs, and of the
next one the longest prefix of documents whose tokens fit in the rest, in the
order of ``md5(seed:epoch:id)``, the id, and the md5 of the text.  The prefix ends at
a key, which is found by two-level sums: over 4096 hash buckets of the leaf,
then over the rows of the one bucket in which the prefix ends.  So no leaf is
ever sorted as a whole, and documents are chosen by comparing their key with their
leaf's, in a join with one row a leaf.  That join moves no text while the leaves are few enough for
Spark to broadcast them; with more leaves than that, texts are shuffled by leaf, and
AQE splits the parts of a hot one.

Defined results: null parts of the tree are the name ``(none)``.  Null and empty
texts have no tokens; they are chosen like others where the prefix reaches
them, and a leaf without tokens gives none.  Rows with the same id
and text share a key and are taken together.  Null ids count as the empty text.
Of columns named like the internal ones (``__...``) none may exist in the input.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from aisleflow.llm.common import cut

NONE = "(none)"
LEAF = ["domain", "lang", "source"]
_KEY = ["__md5", "__id", "__text"]


@dataclass(frozen=True)
class MixConfig:
    seed: int = 17
    max_epochs: int = 4
    #: Tokens to take, as a share of the corpus in thousandths.
    budget_permille: int = 600
    #: Weights among siblings by name; a name that is not listed has weight 1.
    domain_weights: dict = field(default_factory=lambda: {"web": 5, "books": 3, "forums": 2, "reference": 4})
    lang_weights: dict = field(default_factory=lambda: {"en": 4, "de": 2, "fr": 2, "es": 2})
    source_weights: dict = field(default_factory=dict)


def word_tokens(text: Column) -> Column:
    """Words separated by white space."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^ \t\n\r\f\x0B]+")), F.lit(0)).cast("long")


def source_domain(source: Column) -> Column:
    """Domain of a source by the number that ends its name."""
    number = F.coalesce(F.regexp_extract(source, r"([0-9]+)$", 1), F.lit(""))
    rest = F.pmod(F.when(number == "", F.lit("0")).otherwise(number).cast("decimal(38,0)"), F.lit(4))
    out = F.lit(None).cast("string")
    for i, name in enumerate(("web", "books", "forums", "reference")):
        out = F.when((number != "") & (rest == i), F.lit(name)).otherwise(out)
    return out


def _weight(name: Column, weights: dict) -> Column:
    out = F.lit(1)
    for k, w in weights.items():
        if w < 1:
            raise ValueError(f"the weight of {k} is {w}; weights are positive integers")
        out = F.when(name == k, F.lit(int(w))).otherwise(out)
    return out.cast("long")


def share_out(nodes: DataFrame, parent: list[str], name: str, weights: dict) -> DataFrame:
    """Budgets of siblings.  ``nodes``: the columns of ``parent``, ``name``,
    ``capacity``, and ``parent_budget``; adds ``budget``.  Windows run over the
    children of one node."""
    big = "decimal(38,0)"
    nodes = nodes.withColumn("w", _weight(F.col(name), weights))
    ratio = F.col("capacity").cast("double") / F.col("w")
    by = Window.partitionBy(*parent) if parent else Window.partitionBy(F.lit(0))
    up = by.orderBy(ratio, name)
    nodes = nodes.withColumns({
        "before": F.coalesce(F.sum("capacity").over(up.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        "rest_w": F.sum("w").over(up.rowsBetween(0, Window.unboundedFollowing))})
    full = F.col("capacity").cast("decimal(19,0)") * F.col("rest_w").cast("decimal(19,0)") <= \
        (F.col("parent_budget") - F.col("before")).cast("decimal(19,0)") * F.col("w").cast("decimal(19,0)")
    nodes = nodes.withColumn("full", full).withColumns({
        "left": F.col("parent_budget") - F.coalesce(F.sum(F.when(F.col("full"), F.col("capacity"))).over(by), F.lit(0)),
        "open_w": F.sum(F.when(~F.col("full"), F.col("w"))).over(by)})
    part = F.expr(f"cast((cast(`left` as decimal(19,0)) * cast(w as decimal(19,0))) div cast(open_w as {big}) as bigint)")
    nodes = nodes.withColumn("part", F.when(F.col("full"), F.col("capacity")).otherwise(part))
    spare = F.col("left") - F.sum(F.when(~F.col("full"), F.col("part"))).over(by)
    nth = F.row_number().over(by.orderBy("full", name))
    return nodes.withColumns({"spare": spare, "nth": nth}).withColumn(
        "budget", F.when(F.col("full"), F.col("part")).otherwise(F.col("part") + (F.col("nth") <= F.col("spare")).cast("int"))) \
        .drop("w", "before", "rest_w", "full", "left", "open_w", "part", "spare", "nth")


def leaf_budgets(leaves: DataFrame, cfg: MixConfig) -> DataFrame:
    """``leaves``: domain, lang, source, tokens.  Adds budget, epochs, rest."""
    cap = F.sum(F.col("tokens") * cfg.max_epochs)
    total = leaves.agg(F.coalesce(F.sum(F.col("tokens").cast("decimal(38,0)")), F.lit(0)).alias("n")).first()["n"]
    total = int(total) * cfg.budget_permille // 1000  # exact, also beyond 2^53
    domains = share_out(leaves.groupBy("domain").agg(cap.alias("capacity")).withColumn("parent_budget", F.lit(total).cast("long")),
                        [], "domain", cfg.domain_weights).select("domain", F.col("budget").alias("parent_budget"))
    langs = share_out(leaves.groupBy("domain", "lang").agg(cap.alias("capacity")).join(domains, "domain"),
                      ["domain"], "lang", cfg.lang_weights).select("domain", "lang", F.col("budget").alias("parent_budget"))
    own = share_out(leaves.withColumn("capacity", F.col("tokens") * cfg.max_epochs).join(langs, ["domain", "lang"]),
                    ["domain", "lang"], "source", cfg.source_weights)
    epochs = F.when(F.col("tokens") > 0, F.expr("budget div tokens")).otherwise(F.lit(0)).cast("long")
    return own.select(*LEAF, "tokens", "budget", epochs.alias("epochs"), (F.col("budget") - epochs * F.col("tokens")).alias("rest"))


def leaf_columns(docs: DataFrame, domain: Column) -> dict[str, Column]:
    return {"__domain": F.coalesce(domain, F.lit(NONE)), "__lang": F.coalesce(F.col("lang").cast("string"), F.lit(NONE)),
            "__source": F.coalesce(F.col("source").cast("string"), F.lit(NONE))}


_LEAF = ["__domain", "__lang", "__source"]


def select_epochs(docs: DataFrame, domain: Column, tokens: Column, cfg: MixConfig = MixConfig()) -> tuple[DataFrame, DataFrame]:
    """(rows, leaves).  ``rows`` is ``docs`` with ``__copies``, the number of epochs
    in which a row is taken (0: in none), its leaf (``__domain``, ``__lang``,
    ``__source``) and ``__tokens``; ``leaves`` has the budgets."""
    md5_text = F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary"))
    marked = docs.withColumns({**leaf_columns(docs, domain), "__tokens": tokens,
                               "__id": F.coalesce(F.col("doc_id").cast("string"), F.lit(""))})
    slim = cut(marked.select(*_LEAF, "__tokens", "__id", md5_text.alias("__text")), "mix-rows")
    sums = slim.groupBy(*_LEAF).agg(F.sum("__tokens").alias("tokens"))
    leaves = cut(leaf_budgets(sums.select(*[F.col(c).alias(n) for c, n in zip(_LEAF, LEAF)], "tokens"), cfg), "mix-leaves")

    own = leaves.select(*[F.col(n).alias(c) for c, n in zip(_LEAF, LEAF)], "epochs", "rest")
    key = F.md5(F.concat_ws(":", F.lit(cfg.seed), F.col("epochs"), F.col("__id")).cast("binary"))
    # sums over the buckets of each leaf that has a partial epoch
    keyed = slim.join(own.where("rest > 0"), _LEAF).withColumn("__md5", key).withColumn("__bucket", F.substring("__md5", 1, 3))
    buckets = keyed.groupBy(*_LEAF, "rest", "__bucket").agg(F.sum("__tokens").alias("n"))
    upto = Window.partitionBy(*_LEAF).orderBy("__bucket")
    ends = buckets.withColumn("end", F.sum("n").over(upto)).withColumn("begin", F.col("end") - F.col("n"))
    # the bucket in which the prefix ends: the first whose end is beyond the rest
    last = ends.where("end > rest").groupBy(*_LEAF, "rest").agg(F.min(F.struct("__bucket", "begin")).alias("b")).select(
        *_LEAF, F.col("b.__bucket").alias("__bucket"), F.col("b.begin").alias("begin"))
    inside = keyed.join(last, [*_LEAF, "__bucket"])
    run = Window.partitionBy(*_LEAF).orderBy(*_KEY).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    cuts = inside.withColumn("end", F.col("begin") + F.sum("__tokens").over(run)).where("end > rest") \
        .groupBy(*_LEAF).agg(F.min(F.struct(*_KEY)).alias("__first_out"))
    own = cut(own.join(cuts, _LEAF, "left"), "mix-cuts")
    # a prefix leaves out something, as rest < tokens; so a leaf with a rest has a first row outside
    taken = F.struct(key.alias("__md5"), F.col("__id"), md5_text.alias("__text")) < F.col("__first_out")
    copies = F.col("epochs") + F.when((F.col("rest") > 0) & taken, F.lit(1)).otherwise(F.lit(0))
    rows = marked.join(own, _LEAF).withColumn("__copies", copies).drop("epochs", "rest", "__first_out", "__id")
    return rows, leaves


def mix(docs: DataFrame, domain: Column, tokens: Column, cfg: MixConfig = MixConfig()) -> DataFrame:
    """The mixed corpus: the columns of ``docs``; a row is there once for each
    epoch in which it is taken."""
    rows, _ = select_epochs(docs, domain, tokens, cfg)
    taken = rows.where("__copies > 0")
    if cfg.max_epochs > 1:
        taken = taken.withColumn("__epoch", F.explode(F.sequence(F.lit(1), F.col("__copies"))))
    return taken.select(*docs.columns)
