"""Benchmark decontamination: prefix-filtered set join of documents and items.

Records are the windows of the benchmark items (``window`` consecutive words,
or the whole item when it has fewer) and the documents; their tokens are word
shingles of ``shingle`` words (of the whole window when it is shorter).  A
window occurs in a document only if all its shingles do (containment 1), so the
necessary prefix of a window is its one rarest shingle.

1. Items become a table of distinct (item, window) rows with the 64-bit keys of their shingles.
2. One pass over all documents counts the shingles whose key is in a Bloom filter of the
   benchmark's keys (three probes, at most ``max_bits`` bits, broadcast): their rarity.  A task adds up in at most ``tally_rows`` rows.
3. A join by key gives each window its rarest shingle and that shingle's offset.  Windows with a shingle that
   no document has cannot occur and are left out.  Two shingles with one key share a count, which
   can change which shingle is taken for the rarest, but no result.
4. Windows are indexed under the words of their rarest shingle; documents look their shingles up.  A hit proposes
   ``start = position - offset``; the positional bound ``start >= 0`` and the length bound ``start +
   len(window) <= n_words`` must hold, and then the words are compared one by
   one, so every reported occurrence is exact.

Steps 1 to 3 are tables on the cluster.  The items are a stated query set: in step 4 their windows are taken in
blocks of about ``block_bytes``, by a hash of (item, window), so that neither a long item nor a window of many items
makes a block larger.  Only the index of one block is on the driver and in a task at a time, whatever the size of the
benchmark.  Each block is a pass over all documents.  Between passes the
documents are written to the shared folder with the hits so far, which later passes extend.
A benchmark of one block (the usual case) is one pass after that of step 2 and writes no documents.

Defined results: null and empty texts have no words and no hits.  Items without
words have no windows; rows with a null item id still mark words as hit but are
not listed.  Repeated item rows count once, repeated documents are each reported.
Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aisleflow.llm.common import binary_values, cut, ship
from aisleflow.llm.phrases import bitmap_of, in_bitmap, phrase_hashes
from aisleflow.operators.skew import ROWS_PER_TASK, share_join


@dataclass(frozen=True)
class DecontaminateConfig:
    window: int = 10
    shingle: int = 3
    #: Bound of the windows in one block (about ten times as much in memory).
    block_bytes: int = 16 << 20
    #: Bits of the filter of shingle keys: 48 for each key, at most this many (2^27 or fewer).
    max_bits: int = 1 << 27
    #: Distinct shingles that a task counts before it passes their counts on.
    tally_rows: int = 1 << 19
    rows_per_task: int = ROWS_PER_TASK


_WORD = set(range(48, 58)) | set(range(97, 123)) | set(range(128, 256))
#: Bytes to the lower-cased byte where it belongs to a word, else to a space.
_TABLE = bytes(b if b in _WORD else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


def words(text: bytes | None) -> list[bytes]:
    return text.translate(_TABLE).split() if text else []


#: Words whose hash a task keeps, and the length of a kept word.
_MAX_WORDS, _MAX_WORD = 200_000, 48


class WordHashes(dict):
    """XXH64 of words, made when first asked for."""

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh64_intdigest(word)
        if len(word) <= _MAX_WORD:
            if len(self) >= _MAX_WORDS:
                self.clear()
            self[word] = value
        return value

    def of(self, many: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, many), np.uint64, len(many))


def shingle_keys(hashes: np.ndarray, sizes) -> dict[int, np.ndarray]:
    """{size: 64-bit keys of the shingles of that many words, by first word}"""
    out, keys = {}, hashes
    for n in range(1, max(sizes, default=0) + 1):
        if n > 1:
            keys = phrase_hashes(hashes, keys, n)
        if n in sizes:
            out[n] = keys
    return out


def shingle_index(entries) -> dict:
    """{first word: [(number of further words, {further words: values})]}"""
    out: dict[bytes, dict] = {}
    for shingle, value in entries:
        out.setdefault(shingle[0], {}).setdefault(len(shingle) - 1, {}).setdefault(shingle[1:], []).append(value)
    return {first: list(by_size.items()) for first, by_size in out.items()}


def lookups(doc: list[bytes], index: dict):
    """(position, value) for each shingle of the index that begins at a position."""
    if index.keys().isdisjoint(doc):
        return
    for at, by_size in enumerate(map(index.get, doc)):
        if by_size is not None:
            for size, rests in by_size:
                for value in rests.get(tuple(doc[at + 1:at + 1 + size]), ()):
                    yield at, value


def item_windows(items: DataFrame, cfg: DecontaminateConfig) -> DataFrame:
    """Distinct (item_id, window as words between spaces, size of its shingles, their keys in order)."""
    ship(items.sparkSession)

    def run(batches):
        import pyarrow as pa

        hashes = WordHashes()
        rows: list = []

        def taken():
            ids, texts, sizes, keys = zip(*rows)
            return pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.string()), pa.array(texts, pa.binary()), pa.array(sizes, pa.int32()), pa.array(keys, pa.list_(pa.int64()))],
                names=["item_id", "window", "size", "keys"])

        for batch in batches:
            for item_id, text in zip(batch.column(0).to_pylist(), binary_values(batch.column(1))):
                item = words(text)
                if not item:
                    continue
                n = min(cfg.window, len(item))
                k = min(cfg.shingle, n)
                keys = shingle_keys(hashes.of(item), {k})[k].view(np.int64)
                for i in range(len(item) - n + 1):
                    rows.append((item_id, b" ".join(item[i:i + n]), k, keys[i:i + n - k + 1]))
                    if len(rows) >= 4096:
                        yield taken()
                        rows = []
        if rows:
            yield taken()

    rows = items.select(F.col("item_id").cast("string"), F.col("text").cast("string")).where("text is not null").distinct()
    return rows.mapInArrow(run, "item_id string, window binary, size int, keys array<long>").distinct()


#: Probes of the filter: the key without so many of its lowest bits.
_PROBES = (0, 18, 37)


def rarity(docs: DataFrame, loads: DataFrame, sizes: set[int], cfg: DecontaminateConfig) -> DataFrame:
    """(key, n): how often the shingles with the keys of ``loads`` occur over all documents.  The
    filter lets some other shingles through, whose counts meet nothing."""
    spark = docs.sparkSession
    probes = F.array(*(F.shiftrightunsigned("key", n) for n in _PROBES))
    bitmap = spark.sparkContext.broadcast(bitmap_of(loads.select(F.explode(probes).alias("key")), cfg))

    def count(batches):
        import pyarrow as pa

        hashes = WordHashes()
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def added():
            key, counts = (np.concatenate(x) for x in zip(*held))
            whole, where = np.unique(key, return_inverse=True)
            return whole, np.bincount(where, counts, len(whole)).astype(np.int64)

        def out(whole):
            return pa.RecordBatch.from_arrays([pa.array(whole[0].view(np.int64)), pa.array(whole[1])], names=["key", "n"])

        for batch in batches:
            for text in binary_values(batch.column(0)):
                if not text:
                    continue
                for keys in shingle_keys(hashes.of(words(text)), sizes).values():
                    for n in _PROBES:
                        keys = keys[in_bitmap(bitmap.value, keys >> np.uint64(n))]
                    if len(keys):
                        held.append((keys, np.ones(len(keys), np.int64)))
                        size += len(keys)
                if size >= 2 * cfg.tally_rows:
                    held = [added()]
                    size = len(held[0][0])
                    if size >= cfg.tally_rows:
                        yield out(held[0])
                        held, size = [], 0
        if held:
            yield out(added())

    return docs.select("text").mapInArrow(count, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))


def prefixes(windows: DataFrame, docs: DataFrame, cfg: DecontaminateConfig) -> DataFrame:
    """(item_id, window, size, offset of the rarest shingle, deal) of the windows that can occur; ``deal`` is a hash
    of the row, in order of which blocks are cut."""
    shingles = windows.select("item_id", "window", "size", F.size("keys").alias("n_keys"), F.posexplode("keys").alias("offset", "key"))
    loads = windows.select(F.explode("keys").alias("key")).groupBy("key").agg(F.count("*").alias("load"))
    sizes = set(windows.agg(F.collect_set("size")).first()[0])
    counts = rarity(docs, loads, sizes, cfg)
    met = share_join(shingles, counts, ["key"], "load", F.struct("item_id", "window"), cfg.rows_per_task, loads=loads)
    rarest = met.groupBy("item_id", "window", "size", "n_keys").agg(F.count("*").alias("met"), F.min(F.struct("n", "offset")).alias("rarest"))
    return rarest.where("met = n_keys").select("item_id", "window", "size", F.col("rarest.offset").alias("offset"),
                                               F.xxhash64("item_id", "window").alias("deal"))


def prefix_index(block: DataFrame) -> dict:
    """The windows of a block under the words of their rarest shingle: (offset, window, item ids)."""
    owners: dict[tuple, set] = {}
    for item_id, window, size, offset in block.select("item_id", "window", "size", "offset").toLocalIterator():
        owners.setdefault((bytes(window), size, offset), set()).add(item_id)
    same: dict[bytes, bytes] = {}  # one object for each word
    entries = []
    for (window, size, offset), ids in sorted(owners.items()):
        w = [same.setdefault(x, x) for x in window.split(b" ")]
        entries.append((tuple(w[offset:offset + size]), (offset, w, frozenset(ids))))
    return shingle_index(entries)


def occurrences(doc: list[bytes], index: dict) -> tuple[list[tuple[int, int]], set]:
    """Merged word ranges hit by windows, and the items whose windows occur."""
    found, items = [], set()
    for at, (offset, window, owners) in lookups(doc, index):
        start = at - offset
        end = start + len(window)
        if start >= 0 and end <= len(doc) and doc[start:end] == window:
            found.append((start, end))
            items |= owners
    return merge(found), items


def merge(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(ranges):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def passes(docs: DataFrame, items: DataFrame, cfg: DecontaminateConfig):
    """(broadcast prefix index, whether it is the last) of every block of the items;
    at least one, if only of no items."""
    spark = docs.sparkSession
    windows = cut(item_windows(items, cfg), "windows")
    ready = cut(prefixes(windows, docs, cfg).sortWithinPartitions("deal"), "prefixes")
    total = ready.agg(F.sum(F.octet_length("window") + F.coalesce(F.octet_length("item_id"), F.lit(0)))).first()[0] or 0
    n = max(1, -(-total // cfg.block_bytes))
    for i in range(n):
        least, most = (-(1 << 63) + (j << 64) // n for j in (i, i + 1))
        block = ready.where(F.col("deal").between(least, most - 1))
        yield spark.sparkContext.broadcast(prefix_index(block)), i == n - 1


_RANGES = "array<struct<start: int, end: int>>"


def _extend(docs: DataFrame, index, last: bool) -> DataFrame:
    """One pass: ``docs`` (doc_id, text, hit_ranges, item_ids) with the block's hits added;
    the last pass leaves the text out and adds n_words."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    text = "n_words long" if last else "text string"

    def run(batches):
        import pyarrow as pa

        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        for batch in batches:
            sizes, hits, ids = [], [], []
            before = zip(binary_values(batch.column(1)), batch.column(2).to_pylist(), batch.column(3).to_pylist())
            for text, old, known in before:
                doc = words(text)
                ranges, owners = occurrences(doc, index.value)
                sizes.append(len(doc))
                hits.append([{"start": a, "end": b} for a, b in merge(ranges + [(x["start"], x["end"]) for x in old])])
                ids.append(sorted({i for i in owners if i is not None} | set(known)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()) if last else batch.column(1), pa.array(hits, kind), pa.array(ids, pa.list_(pa.string()))],
                names=["doc_id", "n_words" if last else "text", "hit_ranges", "item_ids"])

    return docs.mapInArrow(run, f"doc_id {id_type}, {text}, hit_ranges {_RANGES}, item_ids array<string>")


def find(docs: DataFrame, items: DataFrame, cfg: DecontaminateConfig = DecontaminateConfig()) -> DataFrame:
    """One row per document: doc_id, n_words, hit_ranges (word ranges
    [start, end)), item_ids (distinct, sorted as strings)."""
    found = docs.select("doc_id", "text", F.expr(f"cast(array() as {_RANGES})").alias("hit_ranges"),
                        F.expr("cast(array() as array<string>)").alias("item_ids"))
    for index, last in passes(docs, items, cfg):
        found = _extend(found, index, last) if last else cut(_extend(found, index, last), "hits")
    return found


def remove_contaminated(docs: DataFrame, items: DataFrame, cfg: DecontaminateConfig = DecontaminateConfig()) -> DataFrame:
    """The documents in which no window occurs, whole and with all their columns."""
    at = docs.columns.index("text")
    kept = docs
    for index, last in passes(docs, items, cfg):
        def run(batches, index=index):
            import pyarrow as pa

            for batch in batches:
                yield batch.filter(pa.array([not occurrences(words(t), index.value)[0] for t in binary_values(batch.column(at))], pa.bool_()))

        kept = kept.mapInArrow(run, docs.schema)
        if not last:
            kept = cut(kept, "clean")
    return kept
