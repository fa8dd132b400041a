"""Deterministic train/test splits.

``randomSplit`` depends on the input's partitioning and row order, so a
re-run on another cluster size (or after an executor loss that recomputes a
partition in a different order) can move rows between the sides.  The hash
split puts each key in a bucket from the md5 of its text form: the same on
every engine and every partitioning, and free of any shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

N_BUCKETS = 10


def hash_bucket(key: Column, buckets: int = N_BUCKETS) -> Column:
    """``int(md5(str(key))[0:4], 16) % buckets``."""
    h = F.conv(F.substring(F.md5(key.cast("string")), 1, 4), 16, 10).cast("int")
    return h % F.lit(buckets)


def hash_split(df: DataFrame, key: str, train_buckets: int = 6,
               buckets: int = N_BUCKETS) -> tuple[DataFrame, DataFrame]:
    """(train, test): buckets ``< train_buckets`` train, the rest test."""
    b = hash_bucket(F.col(key), buckets)
    return df.filter(b < train_buckets), df.filter(b >= train_buckets)


def with_split(df: DataFrame, key: str, train_buckets: int = 6,
               buckets: int = N_BUCKETS) -> DataFrame:
    """Add ``bucket`` and ``split`` ('train' / 'test') columns."""
    b = hash_bucket(F.col(key), buckets)
    return (df.withColumn("bucket", b)
              .withColumn("split", F.when(F.col("bucket") < train_buckets, F.lit("train"))
                          .otherwise(F.lit("test"))))


def random_split(df: DataFrame, weights=(0.6, 0.4), seed: int = 1234138471039):
    """Seeded ``randomSplit`` (kept for parity with the original jobs)."""
    return df.randomSplit(list(weights), seed)
