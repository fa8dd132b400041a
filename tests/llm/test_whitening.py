"""Whitening against plain numpy and exact integers."""

from fractions import Fraction
from math import floor

import numpy as np
import pytest

from aisleflow.llm import whitening as W
from aisleflow.llm.common import table
from aisleflow.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"
SCHEMA = "vec_id long, embedding array<double>, component int, n long, whitened string"


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(i, v, 9, 9, "x") for i, v in rows], SCHEMA).repartition(parts)


def plain(x, k=8):
    """Fixed-point entries -> (n, sums, deviations, eigenvalues, vectors) by numpy and Python integers."""
    ints = [[floor(Fraction(float(c)) * 1024) + 100_000 for c in row] for row in x]
    n, sums = len(ints), [sum(c) for c in zip(*ints)]
    dev = [sum((n * v - s) ** 2 for v, s in zip(row, sums)) for row in ints]
    a = np.array([[float(Fraction(n * v - s, n)) for v, s in zip(row, sums)] for row in ints])
    values, vectors = np.linalg.eigh(a.T @ a / n)
    order = np.argsort(-values)[:k]
    return n, sums, dev, values[order], vectors[:, order], values.sum(), a


def test_query_is_plain_whitening(spark):
    got = QUERIES["op12_whitening"](spark, SF).toPandas()
    rows = table(spark, SF, "embeddings").select("vec_id", "embedding").collect()
    n, _, dev, values, vectors, trace, a = plain([r["embedding"] for r in rows])
    assert len(got) == 8 * len(rows) and set(got["n"]) == {n} and set(got["component"]) == set(range(1, 9))
    want = dict(zip([r["vec_id"] for r in rows], dev))
    assert all(want[i] == d for i, d in zip(got["vec_id"], got["deviation"]))
    wide = got.pivot(index="vec_id", columns="component", values="whitened").loc[[r["vec_id"] for r in rows]].to_numpy()
    own = a @ vectors / np.sqrt(values)
    signs = np.sign((own * wide).sum(axis=0))
    np.testing.assert_allclose(wide * signs, own, atol=1e-8)
    explained = got.groupby("component")["explained"].first().to_numpy()
    np.testing.assert_allclose(explained, values / trace, rtol=1e-12)
    assert got["identity_error"].nunique() == 1 and got["identity_error"][0] < 1e-12
    np.testing.assert_allclose(wide.T @ wide / n, np.eye(8), atol=1e-12)


def test_ill_conditioned_columns(spark):
    """Columns of sizes a million apart and nearly parallel: later passes and their factors are needed."""
    rng = np.random.default_rng(2)
    x = rng.normal(size=(700, 6)) * np.array([3e5, 2e2, 1.0, 30.0, 7.0, 0.5])
    x[:, 3] = x[:, 0] * 1e-3 + x[:, 3] * 1e-3
    model = W.fit(frame(spark, enumerate(x.tolist())))
    _, sums, _, values, vectors, trace, _ = plain(x.tolist())
    assert model.sums == sums and 2 <= model.passes <= 4 and model.orthogonality < 1e-12 and model.identity_error < 1e-10
    np.testing.assert_allclose(model.eigenvalues, values, rtol=1e-4)
    np.testing.assert_allclose(np.abs((model.vectors * vectors).sum(axis=0)), 1, atol=1e-6)
    assert abs(model.trace / trace - 1) < 1e-12


@pytest.mark.parametrize("shape", ["constant", "dependent", "few"])
def test_directions_without_variance_are_no_components(spark, shape):
    rng = np.random.default_rng(4)
    x = rng.integers(-50, 50, size=(3 if shape == "few" else 90, 5)).astype(float)
    if shape == "constant":
        x[:, 2] = 7.0
    if shape == "dependent":
        x[:, 4] = x[:, 0] + x[:, 1]
    rank = 2 if shape == "few" else 4
    model = W.fit(frame(spark, enumerate(x.tolist())))
    _, _, _, values, _, trace, _ = plain(x.tolist())
    assert len(model.eigenvalues) == rank
    np.testing.assert_allclose(model.eigenvalues, values[:rank], rtol=1e-10)
    assert abs(model.trace / trace - 1) < 1e-12 and model.identity_error < 1e-9


def test_edge_cases(spark):
    nan, inf = float("nan"), float("inf")
    good = [[1.0, 2.0, 3.0], [2.0, 1.0, 0.0], [0.5, -4.0, 1.0], [9.0, 9.5, -1.0]]
    rows = [(i, v) for i, v in enumerate(good)] + [(None, good[0]), (1, good[1]), (1, good[1])]  # null and repeated ids, repeated rows
    bad = [(50, None), (51, []), (52, [1.0, None, 2.0]), (53, [1.0, nan, 2.0]), (54, [inf, 1.0, 2.0]), (55, [1.0, 2.0]), (56, [None, None, None])]
    vectors = frame(spark, rows + bad)
    model = W.fit(vectors)
    n, sums, dev, values, _, _, _ = plain([v for _, v in rows])
    assert (model.n, model.sums, model.dims) == (n, sums, 3)
    np.testing.assert_allclose(model.eigenvalues, values, rtol=1e-12)
    out = W.whiten(vectors, model)
    assert out.columns == ["vec_id", "deviation", "whitened"]
    got = sorted(((r["vec_id"], int(r["deviation"])) for r in out.collect()), key=str)
    assert got == sorted(zip([i for i, _ in rows], dev), key=str)
    assert [r["component"] for r in W.components(spark, model).collect()] == [1, 2, 3]
    for nothing in ([], [(1, None)], [(1, [1.0, 2.0])], [(1, [3.0, 4.0])] * 5):
        v = frame(spark, nothing)
        m = W.fit(v)
        assert len(m.eigenvalues) == 0 and W.whiten(v, m).count() == 0 and m.n == sum(r is not None for _, r in nothing)


def test_entries_beyond_64_bits(spark):
    x = [[1e25, 1.0], [-3e24, 2.0], [5e3, 7.0]]
    vectors = frame(spark, enumerate(x))
    n, sums, dev, _, _, _, _ = plain(x)
    ints = W.fixed_point(np.array(x), 1024, 100_000)
    assert W.deviations(ints, n, sums) == dev
    model = W.fit(vectors)
    assert model.sums == sums and len(model.eigenvalues) >= 1


def test_result_does_not_hang_on_partitions_or_blocks(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(300, 10)).astype(np.float32)
    x[:200] = x[0]  # a vector that two thirds of the rows share
    x[200:] *= 30
    models = [W.fit(frame(spark, enumerate(x.tolist()), parts), W.WhiteningConfig(block_rows=block)) for parts, block in ((1, 8192), (17, 7))]
    np.testing.assert_allclose(models[0].eigenvalues, models[1].eigenvalues, rtol=1e-12)
    np.testing.assert_allclose(models[0].vectors, models[1].vectors, atol=1e-9)
    assert models[0].sums == models[1].sums


def test_triangular_solve():
    rng = np.random.default_rng(1)
    r = np.triu(rng.normal(size=(75, 75))) + 5 * np.eye(75)
    a = rng.normal(size=(40, 75))
    np.testing.assert_allclose(W.through_solves(a, [r]) @ r, a, atol=1e-10)
