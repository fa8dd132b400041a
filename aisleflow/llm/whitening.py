"""Whitening components of embeddings by shifted CholeskyQR.

The rows of the centred matrix A are never moved.  Each pass reads them where they lie, brings a
block through the triangular solves of the factors found so far, Q = A R1^-1 R2^-1 ..., and sums
the Gram matrix Q'Q; partial sums are added by a shuffle of d x d numbers a task.  The driver
factors this d x d matrix.  The first factor is of the shifted matrix (Q'Q + sI, so that it exists however
ill-conditioned A is), the next ones make the columns orthonormal to working precision.
R = ... R2 R1 then satisfies A = QR, and the SVD of R gives the eigenvectors (its right
singular vectors) and eigenvalues (its squared singular values over n) of the covariance without
squaring the condition of A in the result.

Entries are fixed-point numbers x = floor(scale * c) + offset.  Counts, sums and deviations are
exact integers (decimal sums over tasks, Python integers where 64 bits don't do); only the centred
entries are doubles: (x - m) - r/n with S = m n + r, no digits of which are lost.

Memory: a block of ``block_rows`` rows and the factors, at most ``max_dims`` squared doubles each.
Passes repeat from the table if an executor is lost; nothing is cached.

Defined results: vectors that are null, empty, or hold a null or a non-finite entry are dropped, as are
those that differ in length from most others (of equally frequent lengths the greater one counts).
Repeated rows count each; null and repeated ids are kept.  Directions without variance (singular
values below ``rank_tolerance`` of the greatest) are not components, so constant or single vectors,
like an empty table, give no rows.  The sign of a component is such that its
greatest entry in absolute value (the first of equals) is positive.  A deviation beyond 64
bits is an error of the query's cast, not a wrong number.  Other columns of the table are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aisleflow.llm.common import ship


@dataclass(frozen=True)
class WhiteningConfig:
    components: int = 8
    #: Fixed-point form of an entry c: floor(scale * c) + offset.
    scale: int = 1024
    offset: int = 100_000
    #: Rows brought through the solves at once.
    block_rows: int = 8192
    #: Orthogonality (largest entry of Q'Q - I) at which the passes end, and their number at most.
    tolerance: float = 1e-13
    max_passes: int = 6
    rank_tolerance: float = 1e-12
    max_dims: int = 4096


@dataclass
class Whitening:
    """The fit: exact moments, and per component a unit vector and its eigenvalue."""

    dims: int = 0
    n: int = 0
    sums: list[int] = field(default_factory=list)
    vectors: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))  # dims x components
    eigenvalues: np.ndarray = field(default_factory=lambda: np.zeros(0))
    trace: float = 0.0
    identity_error: float = 0.0
    passes: int = 0
    orthogonality: float = 0.0


# --- inside tasks ---------------------------------------------------------------


def valid_rows(column, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """(positions, entries as doubles) of the vectors of length ``dims`` whose entries are all finite."""
    import pyarrow.compute as pc

    length = pc.list_value_length(column).fill_null(-1).to_numpy(zero_copy_only=False)
    at = np.flatnonzero(length == dims)
    own = column.take(_arrow_index(at)).flatten()
    x = own.cast("double").to_numpy(zero_copy_only=False).reshape(len(at), dims)  # a null entry becomes NaN
    good = np.isfinite(x).all(axis=1)
    return at[good], x[good]


def _arrow_index(at: np.ndarray):
    import pyarrow as pa

    return pa.array(at.astype(np.int64))


def fixed_point(x: np.ndarray, scale: int, offset: int) -> np.ndarray:
    """floor(scale * x) + offset: int64, or Python integers where these don't do."""
    low = np.floor(x * float(scale))
    if low.size == 0 or np.abs(low).max() < 2**53:
        return low.astype(np.int64) + offset
    from fractions import Fraction
    from math import floor
    exact = [floor(Fraction(float(v)) * scale) + offset for v in x.ravel()]
    return np.array(exact, dtype=object).reshape(x.shape)


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """x - S/n in doubles, with the whole part subtracted in integers."""
    whole, rest = zip(*[divmod(s, n) for s in sums])
    small = x.dtype != object and max(map(abs, whole)) < 2**62
    part = x - np.array(whole, dtype=np.int64 if small else object)
    return part.astype(np.float64) - np.array([r / n for r in rest])


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int]:
    """Sum over the dimensions of (n x - S)^2, exactly."""
    if x.dtype != object and x.size:
        top = n * int(np.abs(x).max()) + max(map(abs, sums))
        if top < 2**62:
            gap = n * x - np.array(sums, dtype=np.int64)
            if x.shape[1] * int(np.abs(gap).max()) ** 2 < 2**63:
                return (gap * gap).sum(axis=1).tolist()
    return [sum((n * int(v) - s) ** 2 for v, s in zip(row, sums)) for row in x]


def through_solves(a: np.ndarray, factors: list[np.ndarray]) -> np.ndarray:
    """A R1^-1 R2^-1 ...: triangular solves, one after the other."""
    q = a.T
    for r in factors:
        q = solve_upper_transposed(r, q)
    return q.T


def solve_upper_transposed(r: np.ndarray, b: np.ndarray) -> np.ndarray:
    """y with R'y = b, forward substitution in blocks of rows."""
    d, step = len(r), 32
    y = np.array(b, dtype=np.float64)
    for lo in range(0, d, step):
        hi = min(lo + step, d)
        if lo:
            y[lo:hi] -= r[:lo, lo:hi].T @ y[:lo]
        for i in range(lo, hi):
            if i > lo:
                y[i] -= r[lo:i, i] @ y[lo:i]
            y[i] /= r[i, i]
    return y


# --- passes ---------------------------------------------------------------------


def _blocks(batches: Iterator, dims: int, cfg: WhiteningConfig) -> Iterator:
    """(batch, positions, fixed-point entries) in blocks of rows."""
    for batch in batches:
        for lo in range(0, batch.num_rows, cfg.block_rows):
            part = batch.slice(lo, cfg.block_rows)
            at, x = valid_rows(part.column(part.schema.get_field_index("embedding")), dims)
            yield part, at, fixed_point(x, cfg.scale, cfg.offset)


def _moments(rows: DataFrame, dims: int, cfg: WhiteningConfig) -> tuple[int, list[int]]:
    """Number of valid vectors and the exact sum of each dimension."""
    import pyarrow as pa

    def partial(batches):
        n, total = 0, [0] * dims
        for _, at, x in _blocks(batches, dims, cfg):
            n += len(at)
            # a block's sum stays below 2^53 * block_rows, so the high and low halves are summed apart
            if x.dtype == object:
                total = [t + int(v) for t, v in zip(total, x.sum(axis=0))] if len(at) else total
            else:
                high, low = (x >> 20).sum(axis=0), (x & (2**20 - 1)).sum(axis=0)
                total = [t + (int(h) << 20) + int(v) for t, h, v in zip(total, high, low)]
        if n:
            yield pa.RecordBatch.from_pydict({"dim": pa.array(range(dims), pa.int32()), "n": pa.array([n] * dims, pa.int64()),
                                              "s": pa.array([str(t) for t in total])})

    parts = rows.mapInArrow(partial, "dim int, n long, s string")
    got = {r["dim"]: r for r in parts.groupBy("dim").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect()}
    return (int(got[0]["n"]), [int(got[i]["s"]) for i in range(dims)]) if got else (0, [0] * dims)


def _gram(rows: DataFrame, dims: int, n: int, sums: list[int], factors: list[np.ndarray], project: np.ndarray | None,
          cfg: WhiteningConfig) -> np.ndarray:
    """Q'Q of the centred rows brought through ``factors``, then through ``project``: the upper triangle of
    each task's sum is added by entry."""
    import pyarrow as pa

    width = dims if project is None else project.shape[1]
    up = np.triu_indices(width)

    def partial(batches):
        g = np.zeros((width, width))
        for _, at, x in _blocks(batches, dims, cfg):
            q = through_solves(centred(x, n, sums), factors) if len(at) else np.zeros((0, dims))
            q = q if project is None else q @ project
            g += q.T @ q
        yield pa.RecordBatch.from_pydict({"at": np.arange(len(up[0]), dtype=np.int32), "v": g[up]})

    out = np.zeros((width, width))
    values = rows.mapInArrow(partial, "at int, v double").groupBy("at").agg(F.sum("v").alias("v")).toArrow()
    at = values.column("at").to_numpy()
    out[up[0][at], up[1][at]] = values.column("v").to_numpy()
    return out + np.triu(out, 1).T


def _factor(gram: np.ndarray, n: int, shifted: bool) -> np.ndarray:
    """Upper R with R'R = gram + sI, where s is 0 or the shift that rounding errors can't outweigh."""
    d = len(gram)
    unit = np.finfo(np.float64).eps / 2
    shift = 11.0 * (d * min(n, 1 << 40) + d * (d + 1)) * unit * max(np.linalg.norm(gram, 2), np.finfo(np.float64).tiny)
    # summed in blocks, a Gram matrix is far better than that bound, which also may not exceed the matrix itself
    shift = min(shift, 1e-8 * max(np.linalg.norm(gram, 2), np.finfo(np.float64).tiny)) if shifted else 0.0
    while True:
        try:
            return np.linalg.cholesky(gram + shift * np.eye(d)).T
        except np.linalg.LinAlgError:
            shift = max(10 * shift, 100 * unit * d * np.linalg.norm(gram, 2))


def usual_length(vectors: DataFrame) -> int:
    """The most frequent length of the vectors that are not null or empty; 0 without any."""
    sizes = vectors.select(F.size("embedding").alias("d")).where("d > 0").groupBy("d").count()
    top = sizes.agg(F.max_by("d", F.struct("count", "d")).alias("d")).first()
    return int(top["d"] or 0)


def fit(vectors: DataFrame, cfg: WhiteningConfig = WhiteningConfig()) -> Whitening:
    """Whitening of the ``embedding`` column of ``vectors``."""
    ship(vectors.sparkSession)
    rows = vectors.select("embedding")
    dims = usual_length(rows)
    if dims > cfg.max_dims:
        raise ValueError(f"vectors of {dims} entries; the factors are held whole up to {cfg.max_dims} (max_dims)")
    n, sums = _moments(rows, dims, cfg) if dims else (0, [])
    fitted = Whitening(dims=dims, n=n, sums=sums)
    if n == 0:
        return fitted
    factors: list[np.ndarray] = []
    r = np.eye(dims)
    while True:
        gram = _gram(rows, dims, n, sums, factors, None, cfg)
        if factors:
            # directions without variance shrink from pass to pass; all others must reach 1
            values, basis = np.linalg.eigh(gram)
            fitted.orthogonality = float(np.minimum(np.abs(values - 1), np.abs(values)).max())
            if fitted.orthogonality < cfg.tolerance * dims or len(factors) >= cfg.max_passes:
                break
        elif not np.any(gram):
            return fitted
        factors.append(_factor(gram, n, shifted=not factors))
        r = factors[-1] @ r
    fitted.passes = len(factors)
    # R of the directions that Q has; of the others it holds nothing but shifts
    _, singular, vt = np.linalg.svd(basis[:, values > 0.5].T @ r)
    good = singular > cfg.rank_tolerance * singular[0]
    values = singular**2 / n
    k = min(cfg.components, int(good.sum()))
    v = vt[:k].T
    sign = np.sign(v[np.abs(v).argmax(axis=0), np.arange(k)])
    fitted.vectors, fitted.eigenvalues, fitted.trace = v * np.where(sign == 0, 1, sign), values[:k], float(values[good].sum())
    cov = _gram(rows, dims, n, sums, [], fitted.vectors / np.sqrt(fitted.eigenvalues), cfg) / n
    fitted.identity_error = float(np.abs(cov - np.eye(k)).max())
    return fitted


def whiten(vectors: DataFrame, model: Whitening, cfg: WhiteningConfig = WhiteningConfig(), id_col: str = "vec_id") -> DataFrame:
    """(id, deviation decimal, whitened array<double>) of every valid vector."""
    import pyarrow as pa

    ship(vectors.sparkSession)
    dims, n, sums = model.dims, model.n, model.sums
    project = model.vectors / np.sqrt(model.eigenvalues) if len(model.eigenvalues) else None

    def project_rows(batches):
        for part, at, x in _blocks(batches, dims, cfg):
            if len(at) and project is not None:
                w = centred(x, n, sums) @ project
                flat = pa.array(w.ravel())
                offsets = pa.array(np.arange(0, w.size + 1, w.shape[1], dtype=np.int32))
                yield pa.RecordBatch.from_arrays(
                    [part.column(part.schema.get_field_index(id_col)).take(_arrow_index(at)),
                     pa.array([str(v) for v in deviations(x, n, sums)]), pa.ListArray.from_arrays(offsets, flat)],
                    names=[id_col, "deviation", "whitened"])

    kind = vectors.schema[id_col].dataType.simpleString()
    out = vectors.select(id_col, "embedding").mapInArrow(project_rows, f"{id_col} {kind}, deviation string, whitened array<double>")
    return out.withColumn("deviation", F.col("deviation").cast("decimal(38,0)"))


def components(spark, model: Whitening) -> DataFrame:
    """(component, eigenvalue, explained, vector): numbered from 1 by falling eigenvalue."""
    rows = [(i + 1, float(e), float(e / model.trace), [float(x) for x in model.vectors[:, i]]) for i, e in enumerate(model.eigenvalues)]
    return spark.createDataFrame(rows, "component int, eigenvalue double, explained double, vector array<double>")
