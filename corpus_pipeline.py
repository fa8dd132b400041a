"""Corpus pipeline: documents through five operators of ``aisleflow.llm``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next stage's ``docs``.  All but the
last return the columns of ``docs``; the last adds ``shard`` and ``slot``.

ORACLE_SQL is None: the quality votes, XXH64 fingerprints and the flow of the
sharding stage are beyond SQL.  ``tests/llm/test_pipeline.py`` checks every stage
against a brute-force version on its own input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aisleflow.llm import decontaminate, mixing, quality, resharding, simhash
from aisleflow.llm.common import shared_path, table
from aisleflow.llm.queries import old_shard, quality_labels

ORACLE_SQL = None

#: One epoch, so that no document comes twice; four fifths of the tokens.
MIX = mixing.MixConfig(max_epochs=1, budget_permille=800)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents whose score is below the threshold."""
    model = quality.fit(docs, quality_labels(spark, sf_dir))
    return quality.keep_good(docs, model)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each near-duplicate component."""
    return simhash.keep_one(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents in which a window of a benchmark item occurs."""
    return decontaminate.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes the token budget of each leaf of the domain-language-source tree."""
    return mixing.mix(docs, mixing.source_domain(F.col("source")), mixing.word_tokens(F.col("text")), MIX)


def sharding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Reshards what is left from its present layout into 40 even shards."""
    return resharding.reshard(docs, old_shard())[0]


STAGES = [
    ("quality_classifier", quality_stage),
    ("simhash_near_dedup", near_dedup_stage),
    ("benchmark_decontamination", decontamination_stage),
    ("mixing", mixing_stage),
    ("sharding", sharding_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's rows are written to the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        out = stage(spark, docs, sf_dir)
        path = shared_path(spark, f"pipeline-{name}")
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return docs
