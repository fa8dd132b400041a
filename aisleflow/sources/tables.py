"""Parquet tables of a scale-factor folder.

Reads are lazy and column-pruned by Catalyst; callers select only the columns
they use so the scan's ReadSchema stays narrow.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region nation customer supplier part orders lineitem events "
          "documents embeddings pages benchmark labels conversations").split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table, read from ``{sf_dir}/{name}.parquet``."""
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def by_key(df: DataFrame, key: str) -> DataFrame:
    """``df`` hash-partitioned by ``key``, sized by adaptive execution.

    For heavy per-row work (tokenising whole texts) that is followed by a join
    or an aggregate on ``key``: the one exchange serves both, so the texts
    move once, and the work is not bound to the number of input splits.
    """
    return df.repartition(key)


#: Bytes of text in one partition of ``texts_by_key``, about.
TEXT_BYTES_PER_TASK = 16 << 20


def texts_by_key(df: DataFrame, key: str, text: str) -> DataFrame:
    """``by_key`` with a bound on each partition's text, for work whose memory follows the words.

    Adaptive execution sizes partitions by compressed bytes, up to 64 MB; grouped words take some thirty times that, and
    with a fixed number of shuffle partitions a task would grow with the input."""
    held = df.agg(F.coalesce(F.sum(F.octet_length(text)), F.lit(0))).first()[0]
    n = -(-held // TEXT_BYTES_PER_TASK)
    return df.repartition(n, key) if n > df.sparkSession.sparkContext.defaultParallelism else by_key(df, key)
