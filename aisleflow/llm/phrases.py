"""Phrase collocations by SON partitioning.

Texts (A-Z lower-cased) are cut at ``[.,;:!?`` and line ends ``]`` into pieces, pieces at spaces and tabs into words.
Per language, a candidate is a phrase of 2 to ``max_words`` words with a = f(phrase) >= ``min_count``.

1. Documents are dealt over ``shards`` logical shards.  Each shard is mined completely, by
   length: a phrase is counted where both its parts that are one word shorter were locally frequent.  The local
   support of a language is its share of the global one, ceil(min_count * n_shard / n): a phrase that is below it in every shard
   is below ``min_count`` in all.  A shard is not a task: it is counted by all tasks that
   read its rows, and its counts meet in a shuffle.  So the number of shards stays fixed when the
   corpus grows and the local support does not sink to 1.
2. The union of the locally frequent phrases is counted over all texts, by the phrases themselves,
   not by hashes.  Counts below ``min_count`` then fall away.
3. Cuts, drops and ranks are joins and windows over the counted candidates.

In step 1 phrases are 64-bit hashes, and the locally frequent ones of the length before
are looked up in a bitmap of one bit a hash.  A collision there adds a candidate and never loses
one; step 2 counts it exactly.  The bitmaps are broadcast and hold at most ``max_bits`` bits; with more
candidates than that they let more phrases through to be counted, and nothing else changes.

Counts are added up in each task before the shuffle, in at most ``tally_rows`` rows.  Texts are
read in chunks of ``chunk_bytes``; a longer text is cut between pieces, or between words of a piece with
the words before the cut repeated but not counted.  Joins spread frequent words and languages by their
counts (:mod:`aisleflow.operators.skew`), and the first rows of a language are found in salted windows before one window sees them.

Defined results: null texts are empty, a null language is ``und`` (one with texts that say ``und``).  Repeated
rows count each; ids only deal rows over shards, so null and repeated ones change nothing.
Ties of score and count are ordered by the phrase's bytes.  A language without candidates, and an empty table, give no rows.
Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aisleflow.llm.common import binary_values, cut, ship
from aisleflow.operators.skew import ROWS_PER_TASK, share_join


@dataclass(frozen=True)
class PhraseConfig:
    max_words: int = 5
    min_count: int = 100
    #: A candidate inside a longer one with at least this share of its count is dropped.
    drop_percent: int = 100
    #: Phrases kept of each language.
    top: int = 2000
    shards: int = 4
    chunk_bytes: int = 1 << 20
    tally_rows: int = 1 << 19
    #: Bits of a bitmap: 16 for each candidate, at most this many.
    max_bits: int = 1 << 29
    rows_per_task: int = ROWS_PER_TASK
    #: Tasks for each core that count the candidates, at most: each of them sends every candidate that it meets.
    counting_tasks_per_core: int = 2


# --- inside tasks: words and phrases of a chunk of text as arrays ------------------------

#: Classes of bytes: 0 of words, 1 between words, 2 between pieces.
_CLASS = bytes(1 if b in b" \t" else 2 if b in b".,;:!?\n\x0b\x0c\r" else 0 for b in range(256))
_LOWER = bytes(b + 32 if 65 <= b < 91 else b for b in range(256))

_M1, _M2, _M3 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer of SplitMix64."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


#: Seeds of the two hashes of a word, and the bytes that are hashed in steps of 8; longer words go to XXH64.
_SEEDS = (np.uint64(0x2545F4914F6CDD1D), np.uint64(0xD6E8FEB86659FD93))
_STEPPED = 64
_KEEP = np.array([(1 << 8 * k) - 1 for k in range(8)] + [2**64 - 1], np.uint64)


@dataclass
class Words:
    """The words of a chunk: byte ranges, piece numbers, and the document of each; the first ``old`` are there
    for the phrases that they begin and were counted before."""

    data: bytes
    start: np.ndarray
    end: np.ndarray
    piece: np.ndarray
    doc: np.ndarray
    old: int = 0

    def text(self, at: int, n: int) -> str:
        return " ".join(self.data[self.start[i]:self.end[i]].decode("utf-8", "replace") for i in range(at, at + n))

    def hashes(self, which: int) -> np.ndarray:
        """64-bit hash of each word's bytes."""
        length = self.end - self.start
        padded = self.data + bytes(8)
        eight = np.ndarray((len(self.data) + 1,), "<u8", padded, strides=(1,))  # the 8 bytes from each byte on
        h = length.astype(np.uint64) * _M3 ^ _SEEDS[which]
        own = np.flatnonzero(length <= _STEPPED)
        for lo in range(0, _STEPPED, 8):
            own = own[length[own] > lo]
            if not len(own):
                break
            part = eight[self.start[own] + lo] & _KEEP[np.minimum(length[own] - lo, 8)]
            h[own] = mix(h[own] ^ part) * _M3
        for i in np.flatnonzero(length > _STEPPED):
            h[i] = xxhash.xxh64_intdigest(self.data[self.start[i]:self.end[i]], which)
        return mix(h)


def words_of(data: bytes, doc_starts: np.ndarray, old: int = 0) -> Words:
    """The words of lower-cased ``data``; document i begins at byte ``doc_starts[i]`` (after a line end)."""
    kind = np.frombuffer(data.translate(_CLASS), np.uint8)
    word = np.concatenate([[0], (kind == 0).view(np.int8), [0]])
    step = np.diff(word)
    start, end = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    cuts = np.flatnonzero(kind == 2)
    return Words(data, start, end, np.searchsorted(cuts, start), np.searchsorted(doc_starts, start, "right") - 1, old)


def lower(text: bytes) -> bytes:
    return text.translate(_LOWER)


def _long_chunks(text: bytes, size: int, context: int) -> Iterator[tuple[bytes, int]]:
    """(chunk, words repeated from the chunk before) of a text longer than ``size``."""
    at, repeat = 0, b""
    while at < len(text):
        stop = min(at + size, len(text))
        whole = stop == len(text)
        while stop < len(text):
            kind = np.frombuffer(text[at:stop].translate(_CLASS), np.uint8)
            ends, gaps = np.flatnonzero(kind == 2), np.flatnonzero(kind == 1)
            if len(ends):
                stop, whole = at + int(ends[-1]) + 1, True
                break
            if len(gaps):
                stop, whole = at + int(gaps[-1]) + 1, False
                break
            stop = min(stop + size, len(text))  # a word longer than a chunk
            whole = stop == len(text)
        chunk = repeat + text[at:stop]
        yield chunk, len(repeat.split())
        if whole:
            repeat = b""
        else:
            own = words_of(chunk, np.zeros(1, np.int64))
            same = own.piece == (own.piece[-1] if len(own.piece) else 0)
            tail = [chunk[s:e] for s, e in zip(own.start[same][-context:], own.end[same][-context:])]
            repeat = b" ".join(tail) + b" " if tail and context else b""
        at = stop


def chunks(texts: list, cfg: PhraseConfig) -> Iterator[tuple[Words, np.ndarray]]:
    """Words of the texts (bytes or None) in chunks, with the row numbers of the chunk's documents."""
    held: list[bytes] = []
    rows: list[int] = []
    size = 0

    def take():
        starts = np.concatenate([[0], np.cumsum([len(t) + 1 for t in held])[:-1]]) if held else np.zeros(0, np.int64)
        return words_of(lower(b"\n".join(held)), starts.astype(np.int64)), np.array(rows)

    for row, text in enumerate(texts):
        if not text:
            continue
        if len(text) > cfg.chunk_bytes:
            for part, repeated in _long_chunks(text, cfg.chunk_bytes, cfg.max_words - 1):
                yield words_of(lower(part), np.zeros(1, np.int64), repeated), np.array([row])
            continue
        if size + len(text) > cfg.chunk_bytes and held:
            yield take()
            held, rows, size = [], [], 0
        held.append(text)
        rows.append(row)
        size += len(text) + 1
    if held:
        yield take()


def phrase_hashes(first: np.ndarray, shorter: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the phrases of ``n`` words, from those of their first n - 1 words and of the words."""
    return mix(shorter[:len(first) - n + 1] * _M3 + first[n - 1:]) if len(first) >= n else np.zeros(0, np.uint64)


def in_bitmap(bitmap: np.ndarray, key: np.ndarray) -> np.ndarray:
    at = key & np.uint64(len(bitmap) * 8 - 1)
    return (bitmap[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


def shard_salts(shards: int) -> np.ndarray:
    """What a shard's number adds to the hash that its bitmap is asked for."""
    return mix(np.arange(1, shards + 1, dtype=np.uint64) * _M3)


def _sums(by: np.ndarray, same: list[np.ndarray], counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(an index of each distinct row of ``same``, sum of its counts); the index is of the first of equals.
    Rows are sorted by the hash ``by``, and by ``same`` too where that is one number for different rows."""
    if not len(by):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)

    def changes(order):
        return np.any([k[order][1:] != k[order][:-1] for k in same], axis=0)

    order = np.argsort(by, kind="stable")
    new = changes(order)
    if np.any(new & (by[order][1:] == by[order][:-1])):
        order = np.lexsort([*same, by])
        new = changes(order)
    at = np.flatnonzero(np.concatenate([[True], new]))
    return order[at], np.add.reduceat(counts[order], at)


def _local_rows(n: int, bitmap: np.ndarray | None, salts: np.ndarray, cfg: PhraseConfig):
    """Function of Arrow batches (text, lang_key, shard) -> (shard, lang_key, key, cnt): phrases of ``n`` words whose
    two parts of n - 1 words are in ``bitmap``."""
    import pyarrow as pa

    def batch(parts):
        shard, lang, key, count = (np.concatenate(x) for x in zip(*parts))
        at, total = _sums(key ^ salts[shard], [key, shard], count)
        return shard[at], lang[at], key[at], total

    def out(rows):
        shard, lang, key, total = rows
        return pa.RecordBatch.from_pydict({"shard": pa.array(shard, pa.int32()), "lang_key": pa.array(lang), "key": pa.array(key.view(np.int64)), "cnt": pa.array(total)})

    def run(batches):
        held, size = [], 0
        for b in batches:
            lang_of, shard_of = (b.column(i).to_numpy() for i in (1, 2))
            for w, rows in chunks(binary_values(b.column(0)), cfg):
                doc = rows[w.doc]
                lang, shard = lang_of[doc], shard_of[doc]
                first = mix(w.hashes(0) ^ lang.view(np.uint64))
                key = first
                ok = np.arange(len(first)) >= w.old
                for m in range(2, n + 1):
                    if m == n:
                        known = in_bitmap(bitmap, key ^ salts[shard[:len(key)]])
                        size_n = max(0, len(first) - n + 1)
                        ok = (w.piece[:size_n] == w.piece[n - 1:]) & known[:size_n] & known[1:size_n + 1] & (np.arange(n - 1, n - 1 + size_n) >= w.old)
                    key = phrase_hashes(first, key, m)
                key, at = key[ok], np.flatnonzero(ok)
                if not len(at):
                    continue
                one = batch([(shard[at], lang[at], key, np.ones(len(at), np.int64))])
                held.append(one)
                size += len(one[2])
                if size >= cfg.tally_rows:
                    all_held = batch(held)
                    held, size = [all_held], len(all_held[2])
                    if size >= cfg.tally_rows // 2:
                        yield out(all_held)
                        held, size = [], 0
        if held:
            yield out(batch(held))

    return run


def _global_rows(bitmap: np.ndarray, cfg: PhraseConfig):
    """Function of Arrow batches (text, lang_key, lang) -> (lang, phrase, cnt) of the phrases in ``bitmap``, of 1 to
    ``max_words`` words; a null phrase has the number of all words."""
    import pyarrow as pa

    schema = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("cnt", pa.int64())])

    def merge(parts):
        h, g, lang, phrase, count = (np.concatenate(x) for x in zip(*parts))
        at, total = _sums(h, [h, g], count)
        return h[at], g[at], lang[at], phrase[at], total

    def out(rows):
        return pa.RecordBatch.from_arrays([pa.array(rows[2], pa.string()), pa.array(rows[3], pa.string()), pa.array(rows[4], pa.int64())], schema=schema)

    def run(batches):
        totals: dict = {}
        # sums so far, and the sums of chunks since; the phrase's text is held in the first of them alone
        none = np.zeros(0, np.uint64)
        whole = (none, none, none.astype(object), none.astype(object), none.astype(np.int64))
        held, size = [], 0
        for b in batches:
            lang_of, names = b.column(1).to_numpy(), np.array(b.column(2).to_pylist(), dtype=object)
            for w, rows in chunks(binary_values(b.column(0)), cfg):
                doc = rows[w.doc]
                lang = lang_of[doc].view(np.uint64)
                counted, words = np.unique(doc[w.old:], return_counts=True)
                for d, c in zip(counted, words):
                    totals[names[d]] = totals.get(names[d], 0) + int(c)
                first = [mix(w.hashes(i) ^ lang) for i in (0, 1)]
                keys, ok = list(first), np.ones(len(first[0]), bool)
                for n in range(1, cfg.max_words + 1):
                    if n > 1:
                        keys = [phrase_hashes(f, k, n) for f, k in zip(first, keys)]
                        m = len(keys[0])
                        ok = ok[:m] & ok[1:m + 1] & (w.piece[:m] == w.piece[n - 1:][:m])
                    ok = ok.copy()
                    ok[ok] = in_bitmap(bitmap, keys[0][ok])
                    at = np.flatnonzero(ok & (np.arange(n - 1, n - 1 + len(ok)) >= w.old))
                    if not len(at):
                        continue
                    h, g = keys[0][at], keys[1][at]
                    index, total = _sums(h, [h, g], np.ones(len(at), np.int64))
                    h, g, at = h[index], g[index], at[index]
                    phrase = np.full(len(at), None, dtype=object)
                    place = np.minimum(np.searchsorted(whole[0], h), max(len(whole[0]) - 1, 0))
                    new = np.flatnonzero((whole[0][place] != h) | (whole[1][place] != g)) if len(whole[0]) else range(len(at))
                    for i in new:
                        phrase[i] = w.text(at[i], n)
                    held.append((h, g, names[doc[at]], phrase, total))
                    size += len(h)
                if size >= max(cfg.tally_rows // 8, len(whole[0])):
                    whole, held, size = merge([whole, *held]), [], 0
                    if len(whole[0]) >= cfg.tally_rows:
                        yield out(whole)
                        whole = tuple(x[:0] for x in whole)
        if held or len(whole[0]):
            yield out(merge([whole, *held]))
        if totals:
            yield pa.RecordBatch.from_arrays([pa.array(list(totals), pa.string()), pa.array([None] * len(totals), pa.string()), pa.array(list(totals.values()), pa.int64())], schema=schema)

    return run


# --- on the cluster --------------------------------------------------------------------


def bitmap_of(keys: DataFrame, cfg: PhraseConfig) -> np.ndarray:
    """Bitmap of the column ``key``: one row of 4096 bytes for each run of 2^15 bits, at most
    ``max_bits`` bits in all."""
    n = keys.count()
    bits = 1 << 20
    while bits < min(16 * n, cfg.max_bits):
        bits *= 2
    at = F.col("key").bitwiseAND(F.lit(bits - 1))
    rows = keys.select(F.shiftright(at, 15).cast("int").alias("run"), at.bitwiseAND(F.lit((1 << 15) - 1)).alias("bit")) \
        .groupBy("run").agg(F.bitmap_construct_agg("bit").alias("bits"))
    bitmap = np.zeros(bits // 8, np.uint8)
    for r in rows.toLocalIterator():
        bitmap[r["run"] * 4096:(r["run"] + 1) * 4096] = np.frombuffer(r["bits"], np.uint8)
    return bitmap


def _map(rows: DataFrame, make, bitmap, schema: str) -> DataFrame:
    """``rows.mapInArrow`` of ``make(bitmap)``, the bitmap broadcast once an executor."""
    if bitmap is None:
        return rows.mapInArrow(make(None), schema)
    shared = rows.sparkSession.sparkContext.broadcast(bitmap)

    def run(batches):
        yield from make(shared.value)(batches)

    return rows.mapInArrow(run, schema)


def locally_frequent(docs: DataFrame, cfg: PhraseConfig) -> DataFrame:
    """(key) of the phrases of 1 to ``max_words`` words that are frequent in some shard; a phrase may come
    from several shards.  ``docs`` has text, lang_key and shard."""
    salts = shard_salts(cfg.shards)
    salt = F.get(F.lit([int(s) for s in salts.view(np.int64)]), F.col("shard"))
    found, bitmap, units = [], None, None
    for n in range(1, cfg.max_words + 1):
        counts = _map(docs.select("text", "lang_key", "shard"), lambda bm, n=n: _local_rows(n, bm, salts, cfg), bitmap,
                      "shard int, lang_key long, key long, cnt long").groupBy("shard", "lang_key", "key").agg(F.sum("cnt").alias("cnt"))
        if units is None:
            counts = cut(counts, "words-by-shard")
            own = cut(counts.groupBy("shard", "lang_key").agg(F.sum("cnt").alias("n_unit")), "units")
            total = own.groupBy("lang_key").agg(F.sum("n_unit").alias("n"))
            # a unit has no more rows in the joins below than words
            support = F.expr(f"cast((cast(n_unit as decimal(38,0)) * {cfg.min_count} + n - 1) div n as bigint)")
            units = cut(own.join(total, "lang_key").select("shard", "lang_key", "n_unit", F.greatest(support, F.lit(1)).alias("support")), "support")
        often = share_join(counts, units, ["shard", "lang_key"], "n_unit", F.col("key"), cfg.rows_per_task).where("cnt >= support")
        often = cut(often.select("shard", "key"), f"frequent-{n}")
        found.append(often)
        if n < cfg.max_words:
            bitmap = bitmap_of(often.select(F.col("key").bitwiseXOR(salt).alias("key")), cfg)
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out.select("key")


def shard_of(docs: DataFrame, id_col: str, shards: int) -> Column:
    """Number of a document's shard.  Shards are equal ranges of the ids, as rows that lie together mostly have
    near ids and are then added up before the shuffle; any dealing would do.  Ids that are not numbers are hashed."""
    own = F.col(id_col)
    if docs.schema[id_col].dataType.simpleString() not in ("tinyint", "smallint", "int", "bigint"):
        return F.pmod(F.xxhash64(own.cast("string")), F.lit(shards)).cast("int")
    low, high = docs.agg(F.min(own).cast("double"), F.max(own).cast("double")).first()
    if low is None:
        return F.lit(0)
    place = F.floor((own.cast("double") - F.lit(low)) * F.lit(shards / (high - low + 1)))
    return F.least(F.greatest(F.coalesce(place, F.lit(0)), F.lit(0)), F.lit(shards - 1)).cast("int")


def phrase_counts(docs: DataFrame, cfg: PhraseConfig = PhraseConfig(), id_col: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """((lang, phrase, words, f) of all phrases of 1 to ``max_words`` words with f >= min_count, (lang, n))."""
    ship(docs.sparkSession)
    lang = F.coalesce(F.col("lang"), F.lit("und"))
    rows = docs.select("text", F.xxhash64(lang).alias("lang_key"), lang.alias("lang"), shard_of(docs, id_col, cfg.shards).alias("shard"))
    bitmap = bitmap_of(locally_frequent(rows, cfg).distinct(), cfg)
    # few long tasks: what they send grows with the candidates times the tasks, not with the texts
    tasks = cfg.counting_tasks_per_core * docs.sparkSession.sparkContext.defaultParallelism
    counted = _map(rows.select("text", "lang_key", "lang").coalesce(tasks), lambda bm: _global_rows(bm, cfg), bitmap, "lang string, phrase string, cnt long")
    counts = cut(counted.groupBy("lang", "phrase").agg(F.sum("cnt").alias("f")).where(F.col("phrase").isNull() | (F.col("f") >= cfg.min_count)), "phrase-counts")
    words = F.size(F.split("phrase", " ", -1)).alias("words")
    return counts.where("phrase is not null").select("lang", "phrase", words, "f"), counts.where("phrase is null").select("lang", F.col("f").alias("n"))


def _part(first, n):
    return F.array_join(F.slice(F.split("phrase", " ", -1), first, n), " ")


def collocations(counts: DataFrame, totals: DataFrame, cfg: PhraseConfig = PhraseConfig()) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) of the first ``top`` candidates of each language."""
    candidates = counts.where("words >= 2").withColumnRenamed("f", "a")
    # a longer candidate with the share holds one that is a single word longer and has it too
    inside = candidates.where("words >= 3").select("lang", "a", F.explode(F.array(_part(F.lit(1), F.col("words") - 1), _part(F.lit(2), F.col("words") - 1))).alias("phrase"))
    longest = inside.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = candidates.join(longest, ["lang", "phrase"], "left").where(F.coalesce(100 * F.col("longer") < cfg.drop_percent * F.col("a"), F.lit(True)))
    k = F.col("k")
    cuts = kept.select("lang", "phrase", "a", "words", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k")).select(
        "lang", "phrase", "a", "k", _part(F.lit(1), k).alias("left"), _part(k + 1, F.col("words") - k).alias("right"))
    # candidates that begin (or end) with a part occur min_count times each, at different places for each length
    load = F.ceil(F.col("f") * cfg.max_words / cfg.min_count).alias("load")
    own = lambda part, f: counts.select("lang", F.col("phrase").alias(part), F.col("f").alias(f), load)
    scored = share_join(cuts, own("left", "l"), ["lang", "left"], "load", F.col("phrase"), cfg.rows_per_task).drop("__salt", "load")
    scored = share_join(scored, own("right", "r"), ["lang", "right"], "load", F.col("phrase"), cfg.rows_per_task).drop("__salt", "load")
    scored = share_join(scored, totals, ["lang"], "n", F.col("phrase"), cfg.rows_per_task)
    # 38 digits hold 1000 * a * n up to 10^17 words
    whole = lambda c: f"cast({c} as decimal(17,0))"
    score = F.expr(f"cast((cast(1000 as decimal(4,0)) * ({whole('a')} * {whole('n')})) div ({whole('l')} * {whole('r')}) as bigint)")
    best = scored.withColumn("score", score).groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r", "n")).alias("b"))
    rows = best.select("lang", "phrase", "a", "b.l", "b.r", "b.n", "b.score")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    tasks = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    part = F.pmod(F.xxhash64("phrase"), F.lit(tasks))
    first = rows.withColumn("__part", part).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "__part").orderBy(*order))).where(F.col("rank") <= cfg.top)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= cfg.top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def mine(docs: DataFrame, cfg: PhraseConfig = PhraseConfig(), id_col: str = "doc_id") -> DataFrame:
    """Collocations of the ``text`` of ``docs`` by ``lang``."""
    return collocations(*phrase_counts(docs, cfg, id_col), cfg)
