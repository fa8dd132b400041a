"""Joins of many rows to one row per key, where a key may hold a third of all rows.

A key with more rows than one task should read gets salts in proportion to its share;
every other key has one copy.  The number of rows of each key is a column of the per-key
side (a document frequency, for example), so nothing is counted for the join's sake.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows of one key that one task joins; a key with more is spread.
ROWS_PER_TASK = 1 << 20
#: Keys that are spread, at most: the threshold rises with the rows so that there are no more,
#: which bounds the broadcast table of their salts.
MAX_SPREAD_KEYS = 10_000

SALT, SALTS = "__salt", "__salts"


def spread_keys(per_key: DataFrame, on: list[str], load: str, rows_per_task: int = ROWS_PER_TASK,
                max_keys: int = MAX_SPREAD_KEYS) -> DataFrame:
    """(on..., __salts) of the keys whose ``load`` is above ``rows_per_task``, and above
    the sum of loads / ``max_keys``, so that they are fewer than ``max_keys``."""
    total = per_key.select(F.coalesce(F.sum(load), F.lit(0)).cast("double")).scalar()
    limit = F.greatest(F.lit(float(rows_per_task)), total / F.lit(max_keys))
    heavy = F.col(load) > limit
    return per_key.filter(heavy).select(*on, F.ceil(F.col(load) / F.lit(rows_per_task)).cast("int").alias(SALTS))


def share_join(rows: DataFrame, per_key: DataFrame, on: list[str], load: str, spread_by: Column,
               rows_per_task: int = ROWS_PER_TASK, how: str = "inner", max_keys: int = MAX_SPREAD_KEYS,
               loads: DataFrame | None = None) -> DataFrame:
    """``rows`` joined (inner or left) to ``per_key``.

    ``loads`` (default ``per_key`` itself) has one row per key ``on`` and the key's number of
    rows in column ``load``; a wrong number changes the spread, not the result.  ``spread_by``
    deals the rows of a spread key over its salts.  The salt stays as column ``__salt``.  Keys
    that are null meet nothing.
    """
    heavy = F.broadcast(spread_keys(per_key if loads is None else loads, on, load, rows_per_task, max_keys))
    salt = F.coalesce(F.pmod(F.xxhash64(spread_by), F.col(SALTS).cast("long")).cast("int"), F.lit(0))
    left = rows.join(heavy, on, "left").withColumn(SALT, salt).drop(SALTS)
    copies = F.explode(F.sequence(F.lit(0), F.coalesce(F.col(SALTS), F.lit(1)) - 1))
    right = per_key.join(heavy, on, "left").withColumn(SALT, copies).drop(SALTS)
    return left.join(right, [*on, SALT], how)
