"""Exact dedup by content sort, in DataFrame operations only.

The normalised texts are range-partitioned at sampled splitters
(``repartitionByRange``) and sorted externally in each partition, which puts
equal texts next to each other; a window over neighbours with the same whole text
finds the identifier that stays and the size of the group.  The order is by the
first ``prefix`` characters, a hash, and then the whole text: the splitters, which the
driver samples, hold the first two only, so they stay small however long the texts are, and texts
with one long beginning still spread.  This range partitioning already satisfies the window,
so there is one shuffle of the texts.

A group of copies may hold a third of all rows.  A sample of hashes (about ``sample`` rows,
drawn at random, or more where that would see less than ``2 * heavy`` of ``rows_per_task`` copies)
shows which texts recur: a text with ``heavy`` or more sampled rows gets a salt as second sort
key, so its rows are spread over ``salts`` runs of the sort, or over as many as its
estimated rows fill tasks.  There are at most ``sample / heavy``, or two in ``rows_per_task`` rows,
such texts (their hashes are broadcast).  Each run is reduced to one row, and the runs are
merged by whole text.  A wrong guess changes the work, not the result.

Defined results: null counts as the empty text.  Repeated rows count, and if the
staying id occurs in several equal rows, all of those are marked kept.  A
null id stays only in a group without any other id.  An empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from aisleflow.llm.common import ascii_lower, cut
from aisleflow.operators.skew import ROWS_PER_TASK


@dataclass(frozen=True)
class ExactDedupConfig:
    #: The identifier that stays: "smallest" or "largest".
    keep: str = "smallest"
    #: Characters of a text in a splitter.
    prefix: int = 32
    sample: int = 20_000
    heavy: int = 20
    salts: int = 64
    #: Copies that one run should hold at most.
    rows_per_task: int = ROWS_PER_TASK


def heavy_hashes(docs: DataFrame, norm: Column, cfg: ExactDedupConfig) -> DataFrame:
    """(heavy_hash, salts) of texts that recur in the sample."""
    n = docs.count()
    share = min(1.0, max(cfg.sample / max(1, n), 2 * cfg.heavy / cfg.rows_per_task))
    runs = F.ceil(F.col("count") / F.lit(share * cfg.rows_per_task)).cast("int")
    return docs.where(F.rand(17) < share).select(F.xxhash64(norm).alias("heavy_hash")).groupBy("heavy_hash").count() \
        .where(F.col("count") >= cfg.heavy).select("heavy_hash", F.greatest(F.lit(cfg.salts), runs).alias("salts"))


def equal_texts(docs: DataFrame, norm: Column, cfg: ExactDedupConfig = ExactDedupConfig()) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every row."""
    best = F.min if cfg.keep == "smallest" else F.max
    heavy = F.broadcast(cut(heavy_hashes(docs, norm, cfg), "heavy"))
    rows = docs.select("doc_id", norm.alias("norm")).withColumn("hash", F.xxhash64("norm")) \
        .join(heavy, F.col("hash") == F.col("heavy_hash"), "left")
    is_heavy = F.col("heavy_hash").isNotNull()
    salt = F.when(is_heavy, F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit("salt")), F.col("salts").cast("long"))).otherwise(F.lit(-1))
    ordered = rows.select("doc_id", "norm", F.substring("norm", 1, cfg.prefix).alias("begin"), "hash", salt.cast("int").alias("salt")) \
        .repartitionByRange("begin", "hash", "salt")
    # neighbours with the same whole text and salt
    run = Window.partitionBy("begin", "hash", "salt", "norm").orderBy("doc_id")
    whole = run.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    runs = ordered.select(
        "doc_id", "salt", best("doc_id").over(whole).alias("best"), F.count("*").over(whole).alias("n"),
        F.row_number().over(run).alias("nth"), F.sha2(F.col("norm").cast("binary"), 256).alias("text_sha256"),
        F.when(F.col("salt") >= 0, F.col("norm")).alias("norm"))
    # one row of each run keeps the text for the merge
    runs = cut(runs.withColumn("norm", F.when(F.col("nth") == 1, F.col("norm"))).drop("nth"), "runs")
    merged = runs.where("norm is not null").groupBy("norm").agg(
        best("best").alias("all_best"), F.sum("n").alias("all_n"), F.first("text_sha256").alias("sha"))
    merged = F.broadcast(cut(merged.drop("norm"), "merged"))  # one row a heavy text
    light = runs.where("salt < 0").select("doc_id", F.col("best").alias("keep_id"), F.col("n").alias("group_size"), "text_sha256")
    salted = runs.where("salt >= 0").join(merged, F.col("text_sha256") == F.col("sha")).select(
        "doc_id", F.col("all_best").alias("keep_id"), F.col("all_n").alias("group_size"), "text_sha256")
    return light.unionByName(salted).select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def exact_dedup(docs: DataFrame, cfg: ExactDedupConfig = ExactDedupConfig()) -> DataFrame:
    """Groups of texts that are identical after lower-casing A-Z."""
    return equal_texts(docs, ascii_lower(F.col("text")), cfg)
