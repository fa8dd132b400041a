"""Clustering twins: Lloyd iterations from fixed start centres and the
closed-form squared-Euclidean silhouette.

Each Lloyd step is one distributed aggregate (sum and count per cluster, map
side combined); only the k centres (k x d numbers) travel to the driver and
come back as literals in the next step's distance expression, the same
exchange ``pyspark.ml`` KMeans makes with its broadcast centres.  Lineage does
not grow across steps: every step is a fresh plan over the same (persisted)
input.

The silhouette uses per-cluster count, feature sums and sums of squared
norms: mean squared distance of x to cluster c is
``|x|^2 + Q_c / N_c - 2 x.S_c / N_c``; one aggregate, one projection.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DIST_DIGITS = 9


def _lit(x: float) -> str:
    """Exact double literal for Spark SQL text."""
    return f"{float(x)!r}D"


def _sq_dist_sql(features: Sequence[str], center: Sequence[float]) -> str:
    terms = []
    for f, c in zip(features, center):
        d = f"(CAST(`{f}` AS DOUBLE) - {_lit(c)})"
        terms.append(f"{d} * {d}")
    return " + ".join(terms)


def assign(points: DataFrame, features: Sequence[str],
           centers: Sequence[Sequence[float]], out: str = "cluster") -> DataFrame:
    """Add ``out``: index of the nearest centre (distances rounded to
    ``DIST_DIGITS``, ties to the lowest index).

    One SQL expression: the minimum of (distance, index) structs, so each
    distance is computed once and struct ordering breaks ties by index.
    """
    pairs = ", ".join(
        f"named_struct('d', round({_sq_dist_sql(features, c)}, {DIST_DIGITS}), 'i', {i})"
        for i, c in enumerate(centers))
    return points.withColumn(out, F.expr(f"array_min(array({pairs})).i"))


def initial_centers(points: DataFrame, features: Sequence[str], k: int,
                    order_by: str) -> list[list[float]]:
    """The k points with the smallest ``order_by`` key (a bounded top-k)."""
    rows = points.orderBy(order_by).limit(k).select(*features).collect()
    return [[float(r[f]) for f in features] for r in rows]


def lloyd(points: DataFrame, features: Sequence[str], centers: Sequence[Sequence[float]],
          steps: int) -> list[list[float]]:
    """Run ``steps`` Lloyd updates; an empty cluster keeps its centre."""
    centers = [list(map(float, c)) for c in centers]
    k = len(centers)
    for _ in range(steps):
        a = assign(points, features, centers)
        # One global aggregate (k counts, k x d conditional sums): every map
        # task sends one partial row, no shuffle by cluster.
        aggs = []
        for i in range(k):
            aggs.append(F.expr(f"count(CASE WHEN cluster = {i} THEN 1 END) AS n{i}"))
            aggs += [F.expr(f"sum(CASE WHEN cluster = {i} THEN CAST(`{f}` AS DOUBLE) END) AS s{i}_{j}")
                     for j, f in enumerate(features)]
        r = a.agg(*aggs).first()
        centers = [[float(r[f"s{i}_{j}"]) / r[f"n{i}"] for j in range(len(features))]
                   if r[f"n{i}"] else c for i, c in enumerate(centers)]
    return centers


def _nearest(runs: dict[int, Sequence[Sequence[float]]]):
    """Function of a matrix of points: (k, nearest centre of each point) of every run.  It and the
    functions built on it are sent to the tasks by value, so they need numpy alone there."""
    import numpy as np
    centers = {k: np.asarray(c, dtype=float) for k, c in runs.items()}
    digits = DIST_DIGITS

    def assigned(x):
        for k, c in centers.items():
            yield k, np.round(((x[:, None, :] - c[None]) ** 2).sum(axis=2), digits).argmin(axis=1)

    return assigned


def _blocks(points: DataFrame, features: Sequence[str], make, schema: str) -> DataFrame:
    """Rows that ``make`` yields from all matrices of a task, as tuples."""
    d = len(features)
    fields = [f.split() for f in schema.split(",")]

    def run(batches):
        import numpy as np
        import pyarrow as pa

        def matrices():
            for b in batches:
                if b.num_rows:
                    yield b.column(0).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(b.num_rows, d)

        rows = list(make(matrices()))
        if rows:
            kinds = {"int": pa.int32(), "long": pa.int64(), "double": pa.float64(), "array<double>": pa.list_(pa.float64())}
            yield pa.RecordBatch.from_arrays([pa.array(c, kinds[t]) for c, (_, t) in zip(zip(*rows), fields)], names=[n for n, _ in fields])

    x = F.array(*[F.col(f).cast("double") for f in features]).alias("x")
    return points.select(x).mapInArrow(run, schema)


def _run_sums(points: DataFrame, features: Sequence[str], runs) -> dict[tuple[int, int], tuple]:
    """(k, cluster) -> (n, sum of squared norms, sum of each feature): one pass and one aggregate for all runs; a task
    sends a row for each centre."""
    assigned = _nearest(runs)

    def make(matrices):
        import numpy as np
        sums = {}
        for x in matrices:
            sq = (x * x).sum(axis=1)
            for k, own in assigned(x):
                for c in np.unique(own):
                    at = own == c
                    n, q, s = sums.get((k, c), (0, 0.0, 0.0))
                    sums[k, c] = n + int(at.sum()), q + float(sq[at].sum()), s + x[at].sum(axis=0)
        for (k, c), (n, q, s) in sums.items():
            yield int(k), int(c), n, q, [float(v) for v in s]

    parts = _blocks(points, features, make, "k int, cluster int, n long, q double, s array<double>")
    total = parts.groupBy("k", "cluster").agg(
        F.sum("n").alias("n"), F.sum("q").alias("q"), F.array(*[F.sum(F.col("s")[i]) for i in range(len(features))]).alias("s")).collect()
    return {(r["k"], r["cluster"]): (r["n"], r["q"], list(r["s"])) for r in total}


def lloyd_all(points: DataFrame, features: Sequence[str], runs: dict[int, Sequence[Sequence[float]]], steps: int) -> dict[int, list[list[float]]]:
    """``lloyd`` of several runs at once (k -> start centres): each step is one pass over the points
    and one aggregate of all centres of all runs."""
    own = {k: [list(map(float, c)) for c in centers] for k, centers in runs.items()}
    for _ in range(steps):
        sums = _run_sums(points, features, own)
        own = {k: [[v / sums[k, i][0] for v in sums[k, i][2]] if (k, i) in sums else c for i, c in enumerate(centers)]
               for k, centers in own.items()}
    return own


def silhouettes(points: DataFrame, features: Sequence[str], runs: dict[int, Sequence[Sequence[float]]]) -> DataFrame:
    """(k, silhouette) of several runs, as ``silhouette`` of each: one pass for the sums of all clusters, one for
    the scores of all points."""
    sums, assigned = _run_sums(points, features, runs), _nearest(runs)

    def make(matrices):
        import numpy as np
        totals = {}
        for x in matrices:
            sq = (x * x).sum(axis=1)
            for k, own in assigned(x):
                present = sorted(c for j, c in sums if j == k)
                n = np.array([sums[k, c][0] for c in present], dtype=float)
                q = np.array([sums[k, c][1] for c in present])
                s = np.array([sums[k, c][2] for c in present])
                mean = sq[:, None] + q / n - 2.0 * (x @ s.T) / n
                at = np.searchsorted(present, own)
                row = np.arange(len(x))
                size = n[at]
                with np.errstate(divide="ignore", invalid="ignore"):
                    a = mean[row, at] * size / (size - 1)
                    mean[row, at] = np.inf
                    b = mean.min(axis=1)
                    score = np.where(size <= 1, 0.0, np.where(a < b, 1 - a / b, np.where(a > b, b / a - 1, 0.0)))
                t, m = totals.get(k, (0.0, 0))
                totals[k] = t + float(score.sum()), m + len(x)
        for k, (t, m) in totals.items():
            yield int(k), t, m

    parts = _blocks(points, features, make, "k int, total double, n long")
    return parts.groupBy("k").agg((F.sum("total") / F.sum("n")).alias("silhouette"))


def centers_frame(spark, centers: Sequence[Sequence[float]], features: Sequence[str],
                  digits: int = 6) -> DataFrame:
    """(cluster, feature, value) long form of the centres."""
    rows = [(i, f, round(float(v), digits)) for i, c in enumerate(centers)
            for f, v in zip(features, c)]
    return spark.createDataFrame(rows, "cluster int, feature string, value double")


def silhouette(assigned: DataFrame, features: Sequence[str],
               cluster: str = "cluster") -> DataFrame:
    """One row: mean silhouette (squared Euclidean), as ClusteringEvaluator.

    Points alone in their cluster score 0.
    """
    sq = " + ".join(f"CAST(`{f}` AS DOUBLE) * CAST(`{f}` AS DOUBLE)" for f in features)
    pts = assigned.withColumn("_sq", F.expr(sq))
    stats = pts.groupBy(cluster).agg(
        F.count(F.lit(1)).alias("n"), F.sum("_sq").alias("q"),
        *[F.sum(F.col(f).cast("double")).alias(f"_s_{f}") for f in features]).collect()
    st = {r[cluster]: r for r in stats}        # one row per cluster
    ids = sorted(st)

    def mean_dist(cid):
        r = st[cid]
        n = float(r["n"])
        dot = " + ".join(f"CAST(`{f}` AS DOUBLE) * {_lit(r[f'_s_{f}'])}" for f in features)
        return f"(_sq + {_lit(float(r['q']) / n)}) - (2.0D * ({dot})) / {_lit(n)}"

    # Mean squared distance to every cluster, computed once per point.
    md = ", ".join(f"named_struct('c', {c}, 'n', {_lit(st[c]['n'])}, 'd', {mean_dist(c)})"
                   for c in ids)
    pts = pts.withColumn("_md", F.expr(f"array({md})"))
    own = F.expr(f"filter(_md, m -> m.c = `{cluster}`)[0]")
    nb = F.expr(f"array_min(transform(filter(_md, m -> m.c != `{cluster}`), m -> m.d))")
    pts = pts.select(own.alias("_own"), nb.alias("_nb"))
    return pts.agg(F.avg(_score(F.col("_own.n"), F.col("_own.d"), F.col("_nb"))).alias("silhouette"))


def _score(own_n, own_d, nearest):
    """Silhouette of a point from its cluster's size and mean distance and the nearest other mean distance."""
    a = own_d * own_n / (own_n - F.lit(1.0))
    return (F.when(own_n <= 1, F.lit(0.0))
            .when(a < nearest, F.lit(1.0) - a / nearest)
            .when(a > nearest, nearest / a - F.lit(1.0))
            .otherwise(F.lit(0.0)))
