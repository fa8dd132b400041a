"""Quality classifier: nearest-neighbour voting in a latent-semantic space.

Each text becomes a sparse vector of hashed terms (n-grams of the sequence of
character classes, letter 3-grams, and shares of repeated words), weighted by
tf-idf.  A truncated singular value decomposition of the
vectors of a bounded labelled sample gives the latent space.  The sample's unit
vectors and labels (``max_neighbours`` x ``dims`` floats, independent of the
corpus) are broadcast; every document's cosine with every one of them is one
blocked matrix product, and the ``k`` nearest vote with the weight
``similarity ** power``.

Defined results: null and empty texts are scored like a text without terms,
whose vector is zero and whose score is the sample's share of good labels; so is
a text none of whose neighbours has a positive cosine.  Without any labelled row the
score is 0.5.  Ties of similarity go to the neighbour with the smaller row of
the sample, which is ordered by a hash of the id.

A text's score does not hang on the texts that are scored with it, nor on the partitioning: the entries of
both matrix products are first rounded to whole multiples of a power of two, small
enough that every sum of products is exact in doubles, in whatever order it is added.  A text longer than
``BLOCK_CHARS`` is counted in pieces, with the same counts.  Extra columns are not read by ``score``;
``keep_good`` passes them through.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aisleflow.llm.common import ship
from aisleflow.llm.langid import blocks

BLOCK_CHARS = 400_000
SHAPE_SLOTS = 1024
LETTER_SLOTS = 1024
EXTRA_SLOTS = 8
N_TERMS = SHAPE_SLOTS + LETTER_SLOTS + EXTRA_SLOTS


@dataclass(frozen=True)
class QualityConfig:
    #: Bound of the labelled sample that is fitted and votes.
    max_neighbours: int = 3000
    dims: int = 48
    k: int = 25
    power: float = 8.0
    #: Weight of letter n-grams against that of character-class n-grams.
    letter_weight: float = 0.35
    threshold: float = 0.7


@dataclass
class QualityModel:
    idf: np.ndarray          # (N_TERMS,)
    basis: np.ndarray        # (N_TERMS, dims)
    vectors: np.ndarray      # (neighbours, dims), unit length
    labels: np.ndarray       # (neighbours,)
    prior: float


@lru_cache(maxsize=1)
def _class_table() -> np.ndarray:
    """Character class by code point, below 0x250; the last entry is for the rest."""
    out = np.zeros(0x251, np.uint32)
    for i in range(0x250):
        c = chr(i)
        out[i] = (1 if c.islower() else 2 if c.isupper() else 3 if c.isdigit() else 5 if c == "\n"
                  else 4 if c.isspace() else 6 if c.isalpha() else 16 + i % 48)
    out[0x250] = 7
    return out


#: (classes, multiplier) of the n-grams of classes.
_SHAPES = ((2, 0x9E3779B1), (4, 0x85EBCA6B))


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _kinds(points: np.ndarray) -> np.ndarray:
    return _class_table()[np.minimum(points, 0x250)]


def _shape_slots(kinds: np.ndarray, size: int, salt: int) -> np.ndarray:
    """Slots of the n-grams of ``size`` classes; runs of one class are collapsed already."""
    m = max(0, len(kinds) - size + 1)
    h = np.zeros(m, np.uint32)
    for i in range(size):
        h = h * np.uint32(67) + kinds[i:m + i]
    return (size // 4) * 512 + ((h * np.uint32(salt)) >> np.uint32(23)).astype(np.int64)


def _letter_slots(points: np.ndarray, kind: np.ndarray) -> np.ndarray:
    """Slots of the letter 3-grams, whatever their case."""
    low = np.where(kind == 2, points | 32, points)
    h = (low[:-2] * np.uint32(0x9E3779B1) ^ low[1:-1] * np.uint32(0x85EBCA6B)) * np.uint32(0x01000193) ^ low[2:]
    return ((h * np.uint32(0x27D4EB2F)) >> np.uint32(22)).astype(np.int64)


def _word_shares(words: int, twice: int, distinct: int) -> tuple[float, float]:
    """Shares as counts out of 100, so that the length of a text does not hide them."""
    return 100.0 * twice / words, 100.0 * (words >= 8) * max(0.0, 0.5 - distinct / words)


def word_runs(parts):
    """The words of a text, given as parts in order, in one list for each part (and the last word)."""
    open_word: list[str] = []
    for part in parts:
        words = part.split()
        if open_word and part and (not words or part[0].isspace()):
            yield ["".join(open_word)]
            open_word = []
        if not words:
            continue
        goes_on = not part[-1].isspace()
        if open_word:
            open_word.append(words[0])
            if len(words) == 1 and goes_on:
                continue
            words[0], open_word = "".join(open_word), []
        if goes_on:
            open_word = [words.pop()]
        yield words
    if open_word:
        yield ["".join(open_word)]


def long_term_counts(text: str, piece: int = BLOCK_CHARS) -> np.ndarray:
    """The row of ``term_counts`` of one text, counted in pieces of ``piece`` characters: grams that begin in
    the piece before are completed from its last classes and characters.  Of a word only its hash is kept."""
    out = np.zeros(N_TERMS)
    last, context = np.zeros(0, np.uint32), ""
    words = twice = kept = 0
    before, hashes, room = None, [], 1 << 20
    parts = [(lo, min(lo + piece, len(text))) for lo in range(0, max(len(text), 1), piece)]
    for lo, hi in parts:
        new = text[lo:hi] + ("\n" if hi == len(text) else "")
        kind = _kinds(_points(new))
        kind = kind[np.append(not len(last) or kind[0] != last[-1], kind[1:] != kind[:-1])]
        run = np.append(last, kind)
        for size, salt in _SHAPES:
            begin = max(0, len(last) - size + 1)
            out[:SHAPE_SLOTS] += np.bincount(_shape_slots(run[begin:], size, salt), minlength=SHAPE_SLOTS)
        last = run[-(max(size for size, _ in _SHAPES) - 1):]
        points = _points(context + new)
        if len(points) >= 3:
            out[SHAPE_SLOTS:SHAPE_SLOTS + LETTER_SLOTS] += np.bincount(_letter_slots(points, _kinds(points)), minlength=LETTER_SLOTS)
        context = (context + new)[-2:]
    for run_of_words in word_runs(text[lo:hi] for lo, hi in parts):
        if not run_of_words:
            continue
        words += len(run_of_words)
        twice += sum(map(str.__eq__, run_of_words[1:], run_of_words)) + (run_of_words[0] == before)
        before = run_of_words[-1]
        hashes.append(np.unique(np.fromiter((xxhash.xxh64_intdigest(w.encode("utf-8", "surrogatepass")) for w in run_of_words), np.uint64)))
        kept += len(hashes[-1])
        if kept > room:
            hashes = [np.unique(np.concatenate(hashes))]
            kept = len(hashes[0])
            room = max(room, 2 * kept)
    if words:
        out[SHAPE_SLOTS + LETTER_SLOTS:][:2] = _word_shares(words, twice, len(np.unique(np.concatenate(hashes))))
    return out


def term_counts(texts: list[str]) -> np.ndarray:
    """(texts, N_TERMS) counts of a block of texts; a text longer than a block is counted in pieces."""
    long = [i for i, t in enumerate(texts) if len(t) > BLOCK_CHARS]
    if long:
        out = np.zeros((len(texts), N_TERMS), np.float32)
        rest = [i for i, t in enumerate(texts) if len(t) <= BLOCK_CHARS]
        if rest:
            out[rest] = term_counts([texts[i] for i in rest])
        for i in long:
            out[i] = long_term_counts(texts[i])
        return out
    n = len(texts)
    out = np.zeros((n, N_TERMS), np.float32)
    lengths = np.fromiter((len(t) + 1 for t in texts), np.int64, n)
    points = _points("".join(t + "\n" for t in texts))
    doc = np.repeat(np.arange(n, dtype=np.int64), lengths)
    kind = _kinds(points)

    # n-grams of the sequence of classes, with runs of one class collapsed
    turn = np.append(True, (kind[1:] != kind[:-1]) | (doc[1:] != doc[:-1]))
    k, d = kind[turn], doc[turn]
    for size, salt in _SHAPES:
        if len(k) >= size:
            same = d[:len(k) - size + 1] == d[size - 1:]
            slot = d[:len(same)][same] * SHAPE_SLOTS + _shape_slots(k, size, salt)[same]
            out[:, :SHAPE_SLOTS] += np.bincount(slot, minlength=n * SHAPE_SLOTS).reshape(n, SHAPE_SLOTS)
    if len(points) >= 3:
        same = doc[:-2] == doc[2:]
        slot = doc[:-2][same] * LETTER_SLOTS + _letter_slots(points, kind)[same]
        out[:, SHAPE_SLOTS:SHAPE_SLOTS + LETTER_SLOTS] = np.bincount(slot, minlength=n * LETTER_SLOTS).reshape(n, LETTER_SLOTS)

    extra = SHAPE_SLOTS + LETTER_SLOTS
    for i, t in enumerate(texts):
        words = t.split()
        if words:
            out[i, extra:extra + 2] = _word_shares(len(words), sum(map(str.__eq__, words[1:], words)), len(set(words)))
    return out


def weigh(logs: np.ndarray, idf: np.ndarray, letter_weight: float) -> np.ndarray:
    """Sublinear tf x idf from the logarithms of the counts, each family of terms
    scaled to unit length."""
    w = logs * idf
    out = np.empty_like(w)
    for begin, end, scale in ((0, SHAPE_SLOTS, 1.0), (SHAPE_SLOTS, SHAPE_SLOTS + LETTER_SLOTS, letter_weight)):
        part = w[:, begin:end]
        norm = np.linalg.norm(part, axis=1, keepdims=True)
        out[:, begin:end] = scale * np.divide(part, norm, out=np.zeros_like(part), where=norm > 0)
    out[:, SHAPE_SLOTS + LETTER_SLOTS:] = 0.25 * logs[:, SHAPE_SLOTS + LETTER_SLOTS:]
    return out


#: Steps of 1 / 2^n to which the entries of a product's factors are rounded: terms x basis, unit x unit
#: vectors.  Entries are below 1 or little more, so sums of up to 2056 products stay below 2^53.
TERM_BITS, BASIS_BITS, UNIT_BITS = 18, 22, 22


def _whole(x: np.ndarray, bits: int) -> np.ndarray:
    return np.rint(np.asarray(x, np.float64) * float(1 << bits))


def project(counts: np.ndarray, model: QualityModel, letter_weight: float) -> np.ndarray:
    return project_logs(np.log1p(counts), model, letter_weight)


def project_logs(logs: np.ndarray, model: QualityModel, letter_weight: float) -> np.ndarray:
    latent = _whole(weigh(logs, model.idf, letter_weight), TERM_BITS) @ _whole(model.basis, BASIS_BITS)
    norm = np.sqrt((latent * latent).sum(axis=1, keepdims=True))
    return np.divide(latent, norm, out=np.zeros_like(latent), where=norm > 0)


def fit(docs: DataFrame, labels: DataFrame, cfg: QualityConfig = QualityConfig()) -> QualityModel:
    """Fit on the texts of ``docs`` (doc_id, text) that ``labels`` (doc_id, label)
    marks 0 or 1; null labels and ids are left out.

    At most ``max_neighbours`` labels of ids in ``docs`` are used, those with the smallest hash of
    the id (a repeated id is one row: its smallest label, and of its texts
    the one with the smallest hash).  Their ids are broadcast, and vectors of fixed width come back.
    """
    spark = docs.sparkSession
    ship(spark)
    # only labels of documents that are there count towards the bound
    known = labels.where("label is not null and doc_id is not null").join(docs.select("doc_id"), "doc_id", "left_semi")
    chosen = known.groupBy("doc_id").agg(F.min(F.col("label").cast("int")).alias("label")) \
        .withColumn("draw", F.xxhash64(F.col("doc_id").cast("string"))).orderBy("draw", "doc_id").limit(cfg.max_neighbours)
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "draw", "label").agg(
        F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("first")).select("draw", "first.text", "label")

    def count(batches):
        import pyarrow as pa

        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for i, j in blocks(texts, BLOCK_CHARS, 800):
                # logarithms fit 16 bits however long a text is; counts do not
                rows = np.log1p(term_counts(texts[i:j])).astype(np.float16)
                part = batch.slice(i, j - i)
                yield pa.RecordBatch.from_arrays(
                    [part.column("draw"), part.column("label"), pa.array([r.tobytes() for r in rows], pa.binary())],
                    names=["draw", "label", "logs"])

    got = rows.mapInArrow(count, "draw long, label int, logs binary").toArrow()
    if not got.num_rows:
        return QualityModel(np.zeros(N_TERMS, np.float32), np.zeros((N_TERMS, 1), np.float32),
                            np.zeros((0, 1), np.float32), np.zeros(0, np.float32), 0.5)
    order = np.argsort(got.column("draw").to_numpy(), kind="stable")
    logs = np.frombuffer(b"".join(got.column("logs").to_pylist()), np.float16).reshape(-1, N_TERMS)[order].astype(np.float32)
    labels = got.column("label").to_numpy()[order].astype(np.float32)
    seen = (logs > 0).sum(axis=0)
    idf = (np.log((1 + len(logs)) / (1 + seen)) + 0.3).astype(np.float32)
    weights = weigh(logs, idf, cfg.letter_weight)
    values, vectors = np.linalg.eigh(weights.T.astype(np.float64) @ weights)
    dims = min(cfg.dims, len(values))
    model = QualityModel(idf, vectors[:, ::-1][:, :dims].astype(np.float32), np.zeros((0, dims), np.float32),
                         labels, float(labels.mean()))
    model.vectors = project_logs(logs, model, cfg.letter_weight).astype(np.float32)
    return model


def vote(latent: np.ndarray, model: QualityModel, cfg: QualityConfig) -> np.ndarray:
    """Scores of unit vectors by their exact nearest neighbours, of equally near ones the smaller rows."""
    if not len(model.vectors):
        return np.full(len(latent), model.prior)
    cosine = _whole(latent, UNIT_BITS) @ _whole(model.vectors, UNIT_BITS).T
    n = cosine.shape[1]
    k = min(cfg.k, n)
    # the k-th greatest, then the first rows of those that equal it
    least = np.partition(cosine, n - k, axis=1)[:, n - k, None]
    above, equal = cosine > least, cosine == least
    room = k - above.sum(axis=1, keepdims=True)
    near = np.nonzero(above | (equal & (np.cumsum(equal, axis=1) <= room)))[1].reshape(len(latent), k)
    w = np.maximum(np.take_along_axis(cosine, near, axis=1) / float(1 << 2 * UNIT_BITS), 0) ** cfg.power
    total = w.sum(axis=1)
    good = (w * model.labels[near]).sum(axis=1)
    return np.where(total > 0, np.divide(good, total, out=np.zeros_like(good), where=total > 0), model.prior)


def score_texts(texts: list, model: QualityModel, cfg: QualityConfig) -> np.ndarray:
    whole = [t or "" for t in texts]
    parts = [vote(project(term_counts(whole[i:j]), model, cfg.letter_weight), model, cfg)
             for i, j in blocks(whole, BLOCK_CHARS, 800)]
    return np.clip(np.concatenate(parts), 0, 1) if parts else np.zeros(0)


def score(docs: DataFrame, model: QualityModel, cfg: QualityConfig = QualityConfig()) -> DataFrame:
    """doc_id, score, predicted for every row."""
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(model)
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            s = score_texts(batch.column(1).to_pylist(), shared.value, cfg)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(s), pa.array((s >= cfg.threshold).astype(np.int32))],
                names=["doc_id", "score", "predicted"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {id_type}, score double, predicted int")


def keep_good(docs: DataFrame, model: QualityModel, cfg: QualityConfig = QualityConfig()) -> DataFrame:
    """The rows predicted good, whole and with all their columns."""
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            s = score_texts(batch.column(at).to_pylist(), shared.value, cfg)
            yield batch.filter(pa.array(s >= cfg.threshold))

    return docs.mapInArrow(run, docs.schema)
