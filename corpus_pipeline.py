"""Five stages from raw documents to a sharded training mix.

Each stage is a function of (spark, docs, sf_dir) that returns a DataFrame; its
result is written as Parquet and read again as the next stage's ``docs``.  All
but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tokenmill.llm.decontamination import decontaminate
from tokenmill.llm.mixing import mixed_documents
from tokenmill.llm.ngram_join import unique_documents
from tokenmill.llm.sharding import shard_documents
from tokenmill.llm.toxicity import drop_toxic
from tokenmill.session import importable_in_workers, materialize


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects go."""
    return drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest id stays."""
    return unique_documents(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents contaminated by benchmark texts go."""
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each source comes to its target words: documents are left out or repeated."""
    return mixed_documents(docs)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row gets a shard of near-equal bytes and a slot in it."""
    return shard_documents(docs, 24)


STAGES = [
    ("toxicity", toxicity),
    ("ngram_jaccard", ngram_jaccard),
    ("benchmark_decontamination", benchmark_decontamination),
    ("source_mixing", source_mixing),
    ("sharding", sharding),
]

#: SQL can express neither the trained model nor the seeded choice of documents.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    importable_in_workers(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
