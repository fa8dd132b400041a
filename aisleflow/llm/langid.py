"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training counts the hashed 2- and 3-grams of labelled texts by language inside
the tasks, sums them with one ``groupBy`` and turns them into a matrix of log
probabilities (features x languages), which is broadcast: its size is
``n_features`` x languages doubles, whatever the corpus.  Scoring is the product
of the sparse count matrix of a batch of documents with that matrix, done as a
gather and a segmented sum in numpy.  A long text is counted in pieces, and blocks are smaller with
many languages, so memory beyond the text itself is bounded.

Defined results: a null text, or one without a letter, gives language ``und``
with score 0.  With no labelled row at all every document gives ``und``.
Ties of the posterior go to the language that sorts first.  Rows are scored one
by one: repeated rows give repeated results, extra columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aisleflow.llm.common import ship

BLOCK_CHARS = 400_000
#: A text longer than this is counted piece by piece.
PIECE_CHARS = 200_000


@dataclass(frozen=True)
class LangIdConfig:
    n_features: int = 1 << 16
    smoothing: float = 0.05
    #: About this many labelled documents of each language are fitted; a
    #: language with fewer gives all of them.  Chosen by a hash of the id.
    fit_docs_per_language: int = 6000
    #: More labels than this are taken for a wrong column (the matrix has a column for each).
    max_languages: int = 500


@dataclass
class LangIdModel:
    languages: list[str]
    log_prob: np.ndarray  # (n_features + 1, languages); the last row is zero
    log_prior: np.ndarray


@lru_cache(maxsize=1)
def _letter_table() -> np.ndarray:
    """By code point: the point itself for letters, a space for all else."""
    table = np.full(0x110000, 32, np.uint32)
    letters = np.fromiter((i for i in range(0x110000) if chr(i).isalpha()), np.uint32)
    table[letters] = letters
    return table


def _points(padded: str) -> np.ndarray:
    return _letter_table()[np.frombuffer(padded.encode("utf-32-le", "surrogatepass"), np.uint32)]


def _grams(points: np.ndarray, n_features: int) -> np.ndarray:
    """Numbers of the 2-grams and 3-grams (two rows) from each position but the last two; a gram of spaces
    alone has the number ``n_features``."""
    a, b, c = points[:-2], points[1:-1], points[2:]
    two = a * np.uint32(0x9E3779B1) ^ b * np.uint32(0x85EBCA6B)
    three = two * np.uint32(0x01000193) ^ c * np.uint32(0xC2B2AE35)
    shift = np.uint32(32 - int(n_features).bit_length() + 1)
    out = np.stack([(two * np.uint32(0x27D4EB2F)) >> shift, (three * np.uint32(0x165667B1)) >> shift]).astype(np.int32)
    blank2 = (a == 32) & (b == 32)
    out[0][blank2] = n_features
    out[1][blank2 & (c == 32)] = n_features
    return out


def long_grams(text: str, n_features: int):
    """(grams, letters) of pieces of a text, which together are those of ``gram_features``: each
    piece holds the two characters after it, so no gram is lost or counted twice."""
    padded = f" {text.lower()}  "
    last = len(padded) - 2
    for lo in range(0, last, PIECE_CHARS):
        hi = min(lo + PIECE_CHARS, last)
        points = _points(padded[lo:hi + 2])
        yield _grams(points, n_features), int((points[:hi - lo] != 32).sum())


def _block_chars(languages: int) -> int:
    """Characters of a block: fewer with many languages, as each character gathers a number for each."""
    return max(PIECE_CHARS // 16, BLOCK_CHARS * 8 // max(8, languages))


def gram_features(texts: list[str], n_features: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashed 2- and 3-grams of a batch: (features, segment bounds, letters).

    ``features`` has two rows, of 2-grams and 3-grams by starting position; a
    gram of spaces alone has the number ``n_features``, which weighs nothing.
    ``bounds`` are start and end of each document's positions, alternating.
    """
    lowered = [t.lower() for t in texts]
    joined = "".join(f" {t}  " for t in lowered)
    points = _points(joined)
    lengths = np.fromiter((len(t) for t in lowered), np.int64, len(lowered))
    starts = np.concatenate(([0], np.cumsum(lengths + 3)[:-1]))
    bounds = np.empty(2 * len(lowered), np.int64)
    bounds[0::2], bounds[1::2] = starts, starts + lengths + 1
    out = _grams(points, n_features)
    is_letter = points != 32
    letters = np.add.reduceat(np.append(is_letter, False).astype(np.int64), bounds)[0::2]
    return out, bounds, letters


def blocks(texts: list, size: int, per_text: int = 3):
    """Index ranges of a batch whose texts hold about ``size`` characters,
    where each text counts as ``per_text`` more."""
    begin, total = 0, 0
    for i, t in enumerate(texts):
        total += len(t) + per_text
        if total >= size:
            yield begin, i + 1
            begin, total = i + 1, 0
    if begin < len(texts):
        yield begin, len(texts)


def _segment_sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    pad = np.zeros((1, *values.shape[1:]), values.dtype)
    return np.add.reduceat(np.concatenate([values, pad]), bounds, axis=0)[0::2]


def fit(docs: DataFrame, lang: Column, train: Column, cfg: LangIdConfig = LangIdConfig()) -> LangIdModel:
    """Fit on the rows where ``train`` holds and ``lang`` is not null."""
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(F.col("doc_id").cast("string").alias("id"), "text", lang.cast("string").alias("lang")).where(
        train & lang.isNotNull() & F.col("text").isNotNull())
    n_docs = {r["lang"]: r["n"] for r in docs.where(train & lang.isNotNull()).groupBy(
        lang.cast("string").alias("lang")).agg(F.count("*").alias("n")).limit(cfg.max_languages + 1).collect()}
    if len(n_docs) > cfg.max_languages:
        raise ValueError(f"more than {cfg.max_languages} languages")
    languages = sorted(n_docs)
    if not languages:
        return LangIdModel([], np.zeros((cfg.n_features + 1, 0)), np.zeros(0))
    share = F.lit(1.0)
    for k in languages:
        if n_docs[k] > cfg.fit_docs_per_language:
            share = F.when(F.col("lang") == k, F.lit(cfg.fit_docs_per_language / n_docs[k])).otherwise(share)
    draw = F.pmod(F.xxhash64("id"), F.lit(1 << 30)) / float(1 << 30)
    n_features = cfg.n_features

    def count(batches):
        import pyarrow as pa

        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            texts, langs = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for d in [d for d, t in enumerate(texts) if len(t) > PIECE_CHARS]:
                own = sums.setdefault(langs[d], np.zeros(n_features + 1, np.int64))
                for grams, _ in long_grams(texts[d], n_features):
                    own += np.bincount(grams.ravel(), minlength=n_features + 1)
            short = [d for d, t in enumerate(texts) if len(t) <= PIECE_CHARS]
            texts, langs = [texts[d] for d in short], [langs[d] for d in short]
            for i, j in blocks(texts, BLOCK_CHARS):
                feats, bounds, _ = gram_features(texts[i:j], n_features)
                for d, k in enumerate(langs[i:j]):
                    part = feats[:, bounds[2 * d]:bounds[2 * d + 1]].ravel()
                    own = sums.setdefault(k, np.zeros(n_features + 1, np.int64))
                    own += np.bincount(part, minlength=n_features + 1)
        for k, own in sums.items():
            at = np.flatnonzero(own[:n_features])
            yield pa.RecordBatch.from_pydict({"lang": pa.array([k] * len(at), pa.string()),
                                              "feature": pa.array(at.astype(np.int32)), "n": pa.array(own[at])})

    counted = rows.where(draw < share).select("text", "lang").mapInArrow(count, "lang string, feature int, n long") \
        .groupBy("lang", "feature").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros((n_features, len(languages)))
    index = {k: i for i, k in enumerate(languages)}
    cols = np.fromiter((index[k] for k in counted.column("lang").to_pylist()), np.int64, counted.num_rows)
    counts[counted.column("feature").to_numpy(), cols] = counted.column("n").to_numpy()
    smooth = counts + cfg.smoothing
    log_prob = np.vstack([np.log(smooth) - np.log(smooth.sum(axis=0)), np.zeros((1, len(languages)))])
    prior = np.array([n_docs[k] for k in languages], float)
    return LangIdModel(languages, log_prob, np.log(prior / prior.sum()))


def score_texts(texts: list, model: LangIdModel) -> tuple[list[str], np.ndarray]:
    """Language and posterior of each text of a batch."""
    names, scores = ["und"] * len(texts), np.zeros(len(texts))
    if not model.languages:
        return names, scores
    n_features = len(model.log_prob) - 1
    whole = [t or "" for t in texts]
    for d in [d for d, t in enumerate(whole) if len(t) > PIECE_CHARS]:
        counts, letters = np.zeros(n_features + 1, np.int64), 0
        for grams, n in long_grams(whole[d], n_features):
            counts += np.bincount(grams.ravel(), minlength=n_features + 1)
            letters += n
        if letters:
            logs = model.log_prior + counts @ model.log_prob
            names[d], scores[d] = model.languages[int(logs.argmax())], 1.0 / np.exp(logs - logs.max()).sum()
        whole[d] = ""
    for i, j in blocks(whole, _block_chars(len(model.languages))):
        feats, bounds, letters = gram_features(whole[i:j], n_features)
        logs = model.log_prior + sum(_segment_sums(model.log_prob[f], bounds) for f in feats)
        best = logs.argmax(axis=1)
        post = 1.0 / np.exp(logs - logs.max(axis=1, keepdims=True)).sum(axis=1)
        for d in np.flatnonzero(letters):
            names[i + d], scores[i + d] = model.languages[best[d]], post[d]
    return names, scores


def predict(docs: DataFrame, model: LangIdModel) -> DataFrame:
    """doc_id, lang_pred, score for every row; only doc_id and text are read."""
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(model)
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            names, scores = score_texts(batch.column(1).to_pylist(), shared.value)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.string()), pa.array(scores)],
                                             names=["doc_id", "lang_pred", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {id_type}, lang_pred string, score double")
