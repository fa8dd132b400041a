"""Gaussian mixture densities as column expressions over exported parameters."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

#: What the estimator adds to every weighted density, so that none is 0.
EPSILON = float(np.finfo(np.float64).eps)


def _lit(x: float) -> str:
    return f"{float(x)!r}D"


def whitener(cov: np.ndarray) -> tuple[np.ndarray, float]:
    """(M, logdet): M'M is the pseudo-inverse of ``cov`` and logdet the logarithm of its pseudo-determinant."""
    values, vectors = np.linalg.eigh(cov)
    good = values > EPSILON * values.max() * len(values)
    return vectors[:, good].T / np.sqrt(values[good])[:, None], float(np.log(values[good]).sum())


def weighted_density(features: Sequence[str], weight: float, mean: Sequence[float], cov: Sequence[float]) -> Column:
    """``weight`` x the normal density at ``features``, plus ``EPSILON``; ``cov`` is row after row."""
    d = len(features)
    m, logdet = whitener(np.asarray(cov, dtype=float).reshape(d, d))
    rows = [" + ".join(f"{_lit(c)} * (CAST(`{f}` AS DOUBLE) - {_lit(mu)})" for c, f, mu in zip(row, features, mean)) for row in m]
    squares = " + ".join(f"pow({r}, 2)" for r in rows) or "0.0D"
    constant = math.log(weight) - 0.5 * (d * math.log(2 * math.pi) + logdet) if weight > 0 else -math.inf
    if constant == -math.inf:
        return F.lit(EPSILON)
    return F.expr(f"{_lit(EPSILON)} + exp({_lit(constant)} - 0.5D * ({squares}))")


def mixture_probabilities(densities: Sequence[Column]) -> Column:
    """array<double>: share of each component in the density of the row."""
    total = sum(densities[1:], densities[0])
    return F.array(*[d / total for d in densities])


def log_density(densities: Sequence[Column]) -> Column:
    return F.log(sum(densities[1:], densities[0]))
