"""Quality rules by the frequency of lines across documents, in DataFrame operations only.

Lines are normalised (A-Z lower-cased, digits to 0, white space left out) and hashed with
their host.  A line that stands in more than ``max_docs`` distinct documents of its host is
boilerplate: it is removed from every document of the host.  A document that keeps fewer than
``min_words`` words, or less than ``min_left_percent`` of its words, is depleted and rejected.
Copies of one text are one document here, so a much copied article does not wear itself out.

Base rules look at the text alone: fewer than ``min_words`` words, or more than
``max_repeat_percent`` of the words inside 3-word windows that the text holds twice or more.

Plan: one pass over the texts gives the statistics of every row; another reduces each distinct
(host, text) to the hashes and word counts of its lines (one row, written as a table), from
which the lines are counted and joined back.  What is shuffled is hashes, not texts.  A
line or a text that holds a third of all rows is spread by its count
(:mod:`aisleflow.operators.skew`); counts are combined before the shuffle.

Identity of texts and lines is by 128 and 64 bits of XXH64.  Within a
text nothing is hashed: repeated windows are found by sorting the words themselves, and a hash
only tells apart the texts that have none.

Defined results: a null text has no words and no lines, and fails the base rules.  Null
hosts are one host, apart from the empty name.  Repeated rows and repeated or null
ids are kept, each with the verdict of its text.  Lines without a word count nowhere.  A line met twice in one
document counts once for the limit and is removed in both places.  An empty table
gives an empty result.  Other columns of the table stay as they are; a column named as one of the results
is replaced by it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aisleflow.llm.common import cut
from aisleflow.operators.skew import ROWS_PER_TASK, share_join

# The contract's white space and symbols.
SPACES = "\x20\t\n\x0b\f\r"
WORD_CLASS = "[^\\x20\\x09-\\x0D]"
SYMBOL_CLASS = "[#*$%&|<>]"

_UPPER = "".join(map(chr, range(65, 91)))

STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class LineRulesConfig:
    #: Column of the host whose documents are compared.
    host: str = "source"
    #: Distinct documents of a host that may hold a line.
    max_docs: int = 20
    min_words: int = 50
    max_repeat_percent: int = 50
    #: Share of its words that a document must keep.
    min_left_percent: int = 50
    rows_per_task: int = ROWS_PER_TASK


def _once(df: DataFrame, **columns: Column) -> DataFrame:
    """``df`` with ``columns`` computed once per row: a generator of one row, through which
    the optimizer does not copy them into the lambda functions that read them."""
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))


def normal_line(text: Column) -> Column:
    """A-Z lower-cased, digits 0, white space left out; line breaks stay."""
    gone = SPACES.replace("\n", "")
    return F.translate(text, _UPPER + "123456789" + gone, _UPPER.lower() + "0" * 9)


#: Bits of a window's position in the sorted keys; the rest are of its hash.
_AT_BITS = 24


def _window_keys(words: Column) -> Column:
    """Sorted (hash, position) of every 3-word window, each in one number."""
    n, mask = F.size(words), (1 << _AT_BITS) - 1
    key = lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)).bitwiseAND(F.lit(~mask)).bitwiseOR(i.cast("long"))
    return F.when((n >= 3) & (n <= mask), F.sort_array(F.transform(F.sequence(F.lit(0), n - 3), key)))


def _suspects(words: Column, keys: Column) -> Column:
    """Positions of the windows whose hash bits are met again; of all windows in texts too long for the keys."""
    n, mask = F.size(words), F.lit((1 << _AT_BITS) - 1)
    pairs = F.filter(F.arrays_zip(keys.alias("own"), F.slice(keys, 2, n).alias("next")),
                     lambda x: F.shiftright(x["own"], _AT_BITS) == F.shiftright(x["next"], _AT_BITS))
    at = lambda k: k.bitwiseAND(mask).cast("int")
    met = F.array_distinct(F.flatten(F.transform(pairs, lambda x: F.array(at(x["own"]), at(x["next"])))))
    return F.when(n < 3, F.array().cast("array<int>")).when(keys.isNull(), F.sequence(F.lit(0), n - 3)).otherwise(met)


def _repeat_words(words: Column, suspects: Column) -> Column:
    """Words covered by the windows that occur more than once: suspects are sorted by their words, compared with
    both neighbours, and the positions of the repeated ones, in order, cover 3 words each, less where the next is nearer."""
    same = lambda x, y: (x["a"] == y["a"]) & (x["b"] == y["b"]) & (x["c"] == y["c"])
    order = F.sort_array(F.transform(suspects, lambda i: F.struct(
        F.get(words, i).alias("a"), F.get(words, i + 1).alias("b"), F.get(words, i + 2).alias("c"), i.alias("i"))))
    missing = F.array(F.lit(None).cast("struct<a:string,b:string,c:string,i:int>"))
    beside = F.arrays_zip(order.alias("own"), F.concat(missing, order).alias("before"), F.concat(F.slice(order, 2, F.size(order)), missing).alias("after"))
    again = F.filter(beside, lambda x: F.coalesce(same(x["own"], x["before"]), F.lit(False)) | F.coalesce(same(x["own"], x["after"]), F.lit(False)))
    at = F.sort_array(F.transform(again, lambda x: x["own"]["i"]))
    steps = F.arrays_zip(at.alias("at"), F.slice(at, 2, F.size(at)).alias("next"))
    return F.aggregate(steps, F.lit(0).cast("long"), lambda n, s: n + F.coalesce(F.least(s["next"] - s["at"], F.lit(3)), F.lit(3)))


def with_statistics(docs: DataFrame, cfg: LineRulesConfig = LineRulesConfig()) -> DataFrame:
    """``docs`` with the statistics of each text and ``base_failed``; nothing is shuffled."""
    own = docs.drop(*STATISTICS, "base_failed")
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = _once(own, __words=F.regexp_extract_all(text, F.lit(WORD_CLASS + "+"), F.lit(0)))
    words = F.col("__words")
    rows = _once(rows, __keys=_window_keys(words))
    rows = _once(rows, __suspects=_suspects(words, F.col("__keys")))
    rows = _once(rows, __lines=F.filter(F.split(text, "\n", -1), lambda line: F.ltrim(line, F.lit(SPACES)) != ""))
    repeat = F.when(F.size("__suspects") > 0, _repeat_words(words, F.col("__suspects"))).otherwise(F.lit(0).cast("long"))
    n_symbols = F.char_length(F.regexp_replace(text, "[^#*$%&|<>]+", ""))
    rows = rows.select(
        *own.columns, F.size(words).cast("long").alias("n_words"), F.char_length(F.array_join(words, "")).cast("long").alias("word_chars"),
        n_symbols.cast("long").alias("n_symbols"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"), repeat.alias("n_repeat_words"))
    failed = (F.col("n_words") < cfg.min_words) | (100 * F.col("n_repeat_words") > cfg.max_repeat_percent * F.col("n_words"))
    return rows.withColumn("base_failed", failed)


def _text_key(cfg: LineRulesConfig) -> list[Column]:
    """Two 64-bit hashes of (host, text); a null host takes no part in them."""
    return [F.xxhash64(F.lit(seed), F.col(cfg.host), F.coalesce(F.col("text"), F.lit(""))).alias(name) for seed, name in ((1, "__t1"), (2, "__t2"))]


def distinct_documents(docs: DataFrame, cfg: LineRulesConfig = LineRulesConfig()) -> DataFrame:
    """(__t1, __t2, copies, lines) of every distinct (host, text); ``lines`` holds position, hash and
    number of words of each line with a word, in order."""
    text = F.coalesce(F.col("text"), F.lit(""))
    # the normalised text has the same line breaks
    both = F.arrays_zip(F.split(normal_line(text), "\n", -1).alias("norm"), F.split(text, "\n", -1).alias("line"))
    host = F.col(cfg.host)
    hashed = F.transform(both, lambda x, i: F.struct(i.alias("at"), F.xxhash64(host, x["norm"]).alias("line"),
                                                     F.regexp_count(x["line"], F.lit(WORD_CLASS + "+")).alias("words")))
    return docs.select(*_text_key(cfg), F.filter(hashed, lambda x: x["words"] > 0).alias("lines")).groupBy("__t1", "__t2").agg(
        F.count(F.lit(1)).alias("copies"), F.first("lines").alias("lines"))


def frequent_lines(distinct: DataFrame, cfg: LineRulesConfig = LineRulesConfig()) -> DataFrame:
    """(line, docs, occurrences) of the lines above the limit."""
    met = F.transform("lines", lambda x: F.struct(x["line"].alias("line"), F.lit(0).alias("docs"), F.lit(1).alias("occurrences")))
    held = F.transform(F.array_distinct(F.transform("lines", lambda x: x["line"])),
                       lambda x: F.struct(x.alias("line"), F.lit(1).alias("docs"), F.lit(0).alias("occurrences")))
    return distinct.select(F.inline(F.concat(met, held))).groupBy("line").agg(
        F.sum("docs").alias("docs"), F.sum("occurrences").alias("occurrences")).where(F.col("docs") > cfg.max_docs)


def removals(distinct: DataFrame, frequent: DataFrame, cfg: LineRulesConfig = LineRulesConfig()) -> DataFrame:
    """(__t1, __t2, copies, removed, words_removed) of the texts that lose lines; ``removed`` are
    the positions of these lines."""
    rows = distinct.select("__t1", "__t2", "copies", F.inline("lines"))
    return share_join(rows, frequent, ["line"], "occurrences", F.col("__t1"), cfg.rows_per_task).groupBy("__t1", "__t2").agg(
        F.first("copies").alias("copies"), F.collect_list("at").alias("removed"), F.sum("words").cast("long").alias("words_removed"))


def _lost(docs: DataFrame, cfg: LineRulesConfig) -> DataFrame:
    distinct = cut(distinct_documents(docs, cfg), "distinct-documents")
    return cut(removals(distinct, cut(frequent_lines(distinct, cfg), "frequent-lines"), cfg), "removals")


def judge(docs: DataFrame, cfg: LineRulesConfig = LineRulesConfig()) -> DataFrame:
    """``docs`` with the statistics, ``base_failed``, ``n_lines_removed``, ``n_words_left``,
    ``removed`` (positions of the removed lines) and ``kept``."""
    lost = _lost(docs, cfg)
    rows = with_statistics(docs.drop("n_lines_removed", "n_words_left", "removed", "kept"), cfg).select("*", *_text_key(cfg))
    rows = share_join(rows, lost, ["__t1", "__t2"], "copies", F.monotonically_increasing_id(), cfg.rows_per_task, "left")
    n, left = F.col("n_words"), F.col("n_words") - F.coalesce(F.col("words_removed"), F.lit(0))
    depleted = (left < cfg.min_words) | (100 * left < cfg.min_left_percent * n)
    gone = F.coalesce(F.col("removed"), F.array().cast("array<int>"))
    return rows.select(*[c for c in rows.columns if not c.startswith("__") and c not in ("copies", "removed", "words_removed")],
                       F.size(gone).cast("long").alias("n_lines_removed"), left.cast("long").alias("n_words_left"),
                       gone.alias("removed"), (~F.col("base_failed") & ~depleted).alias("kept"))


def clean(docs: DataFrame, cfg: LineRulesConfig = LineRulesConfig()) -> DataFrame:
    """The documents that are kept, without the removed lines, with the columns of ``docs``."""
    rows = judge(docs, cfg).where("kept")
    rows = _once(rows, __lines=F.split("text", "\n", -1))
    stay = F.array_except(F.sequence(F.lit(0), F.size("__lines") - 1), F.col("removed"))
    text = F.array_join(F.transform(stay, lambda i: F.get("__lines", i)), "\n")
    return rows.withColumn("text", F.when(F.size("removed") == 0, F.col("text")).otherwise(text)).select(*docs.columns)
