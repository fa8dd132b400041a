"""Rating -> label maps and the modulo bucket filter of the review jobs."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Star rating -> label encodings used by the review jobs.
# Ratings outside 1-5 have no label (NULL).
RATING_TO_BAYES = {1: 0.0, 2: 0.0, 3: 1.0, 4: 2.0, 5: 2.0}
RATING_TO_LOGISTIC = {1: 0.0, 2: 0.0, 3: 1.0, 4: 3.0, 5: 3.0}
RATING_TO_SENTIMENT = {1: "NEG", 2: "NEG", 3: "NEU", 4: "POS", 5: "POS"}
RATING_TO_BINARY = {1: 0.0, 2: 0.0, 3: 0.0, 4: 1.0, 5: 1.0}

# The review jobs keep reviews whose id mod 5 is 1, 2 or 3.
REVIEW_BUCKETS = (1, 2, 3)
REVIEW_MODULUS = 5


def rating_label(rating: Column, mapping: Mapping) -> Column:
    """Simple CASE over the rating with no ELSE: unmapped ratings -> NULL."""
    expr = None
    for k, v in mapping.items():
        expr = (F.when(rating == k, F.lit(v)) if expr is None
                else expr.when(rating == k, F.lit(v)))
    return expr


def bucket_filter(key: Column, modulus: int = REVIEW_MODULUS,
                  keep: Iterable[int] = REVIEW_BUCKETS) -> Column:
    """``pmod(key, modulus) IN keep`` (non-negative for negative keys)."""
    return F.pmod(key, F.lit(modulus)).isin(list(keep))


def text_label(rating: Column, mapping: Mapping) -> Column:
    """The label as the job reads it: a CASE that gives digits as text, cast to double."""
    return rating_label(rating, {k: str(int(v)) for k, v in mapping.items()}).cast("double")
