"""Text features in long form: one row per (document, token) or (term).

The ``pyspark.ml`` text stages (Tokenizer, StopWordsRemover, HashingTF, IDF,
CountVectorizer) keep whole vectors per row; the long form here keeps the
same numbers as rows so joins, aggregates and a SQL engine can check them.
Work is spread by (document, term): a very long document is exploded inside
one task but its tokens are shuffled by term, and per-term aggregates use
map-side partial aggregation, so frequent terms never gather in one reducer
as raw rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from aisleflow.functions.text import STOP_WORDS, tokens
from aisleflow.operators.skew import ROWS_PER_TASK, share_join
from aisleflow.plans.cache import stage_durable
from aisleflow.sources.vectors import PARTS

def token_rows(docs: DataFrame, key: str = "doc_id", text: str = "text", *,
               positions: bool = True) -> DataFrame:
    """(key, pos, token) for every token, empty ones included; NULL text yields none.
    ``positions=False`` gives (key, token) and skips numbering."""
    if positions:
        return docs.select(key, F.posexplode(tokens(F.col(text))).alias("pos", "token"))
    return docs.select(key, F.explode(tokens(F.col(text))).alias("token"))


def remove_stop_words(tok: DataFrame, stop_words=STOP_WORDS) -> DataFrame:
    """Drop stop words (tokens are already lower case)."""
    return tok.filter(~F.col("token").isin(list(stop_words)))


def term_frequencies(tok: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, term, tf): occurrences of each term per document."""
    return tok.groupBy(key, F.col("token").alias("term")).agg(F.count(F.lit(1)).alias("tf"))


def term_idf(tf: DataFrame, docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """(term, doc_freq, idf) with idf = ln((m + 1) / (doc_freq + 1)).

    ``m`` counts every document in ``docs`` (also those without tokens), as
    the IDF estimator does; it is a scalar subquery, not a join.
    """
    return idf_of(tf.groupBy("term").agg(F.count(F.lit(1)).alias("doc_freq")), docs)


def idf_of(doc_freqs: DataFrame, docs: DataFrame) -> DataFrame:
    """``doc_freqs`` (term, doc_freq) with the ``idf`` of ``term_idf``."""
    m = docs.select(F.count(F.lit(1))).scalar()
    return doc_freqs.withColumn("idf", F.log((m + F.lit(1)) / (F.col("doc_freq") + F.lit(1))))


def weigh(tf: DataFrame, idf: DataFrame, key: str = "doc_id", rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """``tf`` (key, term, ...) with the ``idf`` of each term, from ``idf`` (term, doc_freq, idf); terms
    missing there are dropped.  A term that stands in many documents is spread by its document frequency."""
    return share_join(tf, idf.select("term", "doc_freq", "idf"), ["term"], "doc_freq", F.col(key), rows_per_task)


def doc_tfidf(tf: DataFrame, idf: DataFrame, key: str = "doc_id", rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """(key, term, tf, tfidf).  Terms missing from ``idf`` are dropped."""
    return weigh(tf, idf, key, rows_per_task).select(key, "term", "tf", (F.col("tf") * F.col("idf")).alias("tfidf"))


def term_statistics(tf: DataFrame, min_df: float = 1.0, n_docs=None) -> DataFrame:
    """(term, freq, doc_freq) of terms with ``doc_freq >= min_df`` (a share of
    ``n_docs`` when ``min_df < 1``).  A row is one document's, or those of as many as its ``doc_freq``."""
    held = F.sum("doc_freq") if "doc_freq" in tf.columns else F.count(F.lit(1))
    stats = tf.groupBy("term").agg(F.sum("tf").alias("freq"), held.alias("doc_freq"))
    if min_df < 1.0:
        if n_docs is None:
            raise ValueError("fractional min_df needs n_docs")
        return stats.filter(F.col("doc_freq") >= F.lit(min_df) * n_docs)
    return stats.filter(F.col("doc_freq") >= F.lit(min_df))


#: Bits of ``monotonically_increasing_id`` that number the rows of a partition.
ROW_BITS = 33


def term_vocabulary(tf: DataFrame, vocab_size: int | None = None,
                    min_df: float = 1.0, n_docs=None) -> DataFrame:
    """(term, term_index, freq, doc_freq): all terms numbered by falling
    frequency, ties by term; only the first ``vocab_size`` if the caller bounds it.

    Terms are range-partitioned and sorted by (falling frequency, term) and written with
    their place (partition, row); a partition's first index is the number of terms in
    the partitions before it, a prefix sum over one number a partition.
    """
    stats = term_statistics(tf, min_df, n_docs)
    order = [F.desc("freq"), F.asc("term")]
    placed = stage_durable(stats.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(
        "place", F.monotonically_increasing_id()), "vocabulary")
    part = F.shiftright("place", ROW_BITS)
    sizes = placed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"))
    base = sizes.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("base"))
    within = F.col("place").bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    out = placed.withColumn("part", part).join(base, "part").select(
        "term", (F.col("base") + within).cast("long").alias("term_index"), "freq", "doc_freq")
    return out if vocab_size is None else out.filter(F.col("term_index") < vocab_size)


#: Entries (document, term) of one pack, about; a longer document stays whole.
PACK_ENTRIES = 1 << 20


def packed(tf: DataFrame, docs: DataFrame, key: str) -> DataFrame:
    """(pack, words, terms, tf, doc_freq): many documents in a row, written to files.

    ``terms`` are the pack's different terms, with their sums; ``words`` has the documents (key, times, entries) over places
    in ``terms``.  What follows joins and moves each term once a pack, not once a document.  ``docs`` has a row for each
    time that a key's vector is wanted; a key of ``tf`` that is not there has terms and no vector, as a null key has."""
    limit = PACK_ENTRIES

    def pack(batches):
        import pickle
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext
        number = TaskContext.get().partitionId() << ROW_BITS
        for batch in batches:
            lists, tfs = batch.column("terms"), batch.column("tfs")
            ends, at = np.asarray(lists.offsets, dtype=np.int64), np.asarray(tfs.offsets, dtype=np.int64)
            lo = 0
            while lo < batch.num_rows:
                hi = max(lo + 1, int(np.searchsorted(ends, ends[lo] + limit, side="right")) - 1)
                words = lists.values[ends[lo]:ends[hi]].dictionary_encode()
                ids, counts = np.asarray(words.indices), np.asarray(tfs.values[at[lo]:at[hi]])
                n = len(words.dictionary)
                freq = np.zeros(n, np.int64)
                np.add.at(freq, ids, counts)
                sink = pa.BufferOutputStream()
                named = batch.select(["key", "times"]).slice(lo, hi - lo)
                with pa.ipc.new_stream(sink, named.schema) as out:
                    out.write_batch(named)
                small = counts.astype(np.min_scalar_type(int(counts.max()))) if n else counts
                blob = pickle.dumps((sink.getvalue().to_pybytes(), ends[lo:hi + 1] - ends[lo], ids, small, n))
                one = lambda x: pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), x)
                yield pa.record_batch([pa.array([number], pa.int64()), pa.array([blob], pa.binary()), one(words.dictionary), one(pa.array(freq)),
                                       one(pa.array(np.bincount(ids, minlength=n).astype(np.int64)))], names=["pack", "words", "terms", "tf", "doc_freq"])
                number, lo = number + 1, hi

    own = tf.groupBy(key).agg(F.collect_list(F.struct("term", "tf")).alias("t"))
    times = docs.groupBy(key).agg(F.count(F.lit(1)).alias("times"))
    t = F.coalesce("t", F.array().cast("array<struct<term:string,tf:bigint>>"))
    rows = times.join(own, key, "full").select(F.col(key).alias("key"), F.coalesce("times", F.lit(0).cast("long")).alias("times"),
                                               t["term"].alias("terms"), t["tf"].alias("tfs"))
    kind = "pack long, words binary, terms array<string>, tf array<long>, doc_freq array<long>"
    return stage_durable(rows.mapInArrow(pack, kind), "packs")


def pack_terms(packs: DataFrame) -> DataFrame:
    """(term, tf, doc_freq) of each pack, for ``term_statistics``."""
    return packs.select(F.inline(F.arrays_zip(F.col("terms").alias("term"), "tf", "doc_freq")))


def pack_vectors(packs: DataFrame, vocabulary: DataFrame, width: int, key: StructField) -> DataFrame:
    """(key, features): a row for each time of each document, its counts at the terms' numbers as the struct of a
    sparse vector; terms missing from ``vocabulary`` drop out."""
    def vectors(batches):
        import pickle
        import numpy as np
        import pyarrow as pa
        for batch in batches:
            for blob, places, found in zip(batch.column("words"), batch.column("at"), batch.column("term_index")):
                named, ends, ids, counts, n = pickle.loads(blob.as_buffer())
                named = pa.ipc.open_stream(named).read_all().combine_chunks()
                number = np.full(n, -1, np.int64)
                if places.is_valid:
                    number[np.asarray(places.values)] = np.asarray(found.values)
                index, doc = number[ids], np.repeat(np.arange(len(ends) - 1), np.diff(ends))
                known = index >= 0
                index, doc, values = index[known], doc[known], counts[known].astype(float)
                order = np.lexsort((index, doc))
                sizes = np.bincount(doc, minlength=len(ends) - 1)
                times = np.asarray(named.column("times"))
                again = np.repeat(np.arange(len(times)), times)  # of documents
                if not len(again):
                    continue
                lengths = sizes[again]
                first = np.cumsum(lengths) - lengths
                order = order[np.repeat((np.cumsum(sizes) - sizes)[again] - first, lengths) + np.arange(lengths.sum())]
                offsets = pa.array(np.append(first, lengths.sum()).astype(np.int32))
                parts = [pa.array(np.zeros(len(again), np.int8)), pa.array(np.full(len(again), width, np.int32)),
                         pa.ListArray.from_arrays(offsets, pa.array(index[order].astype(np.int32))), pa.ListArray.from_arrays(offsets, pa.array(values[order]))]
                yield pa.record_batch([named.column("key").combine_chunks().take(pa.array(again)), pa.StructArray.from_arrays(parts, PARTS.names)],
                                      names=[key.name, "features"])

    terms = packs.select("pack", F.posexplode("terms").alias("at", "term"))
    known = share_join(terms, vocabulary.select("term", "term_index", "doc_freq"), ["term"], "doc_freq", F.col("pack"))
    own = known.groupBy("pack").agg(F.collect_list(F.struct("at", "term_index")).alias("n"))
    rows = packs.select("pack", "words").join(own, "pack", "left").select("words", F.col("n.at").alias("at"), F.col("n.term_index").alias("term_index"))
    return rows.mapInArrow(vectors, StructType([StructField(key.name, key.dataType), StructField("features", PARTS)]))


def vocabulary_size(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(vocab_size): number of distinct terms, stop words left out; nothing is numbered."""
    terms = remove_stop_words(token_rows(docs, key, text, positions=False)).select("token").distinct()
    return terms.agg(F.count(F.lit(1)).alias("vocab_size"))
