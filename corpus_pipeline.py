"""The training-corpus pipeline: five stages, each a whole-table operator whose decisions take effect."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from siltstone.llm.common import materialize
from siltstone.llm.decontaminate import decontaminate_stage
from siltstone.llm.mixing import mix_stage
from siltstone.llm.sharding import shard_stage
from siltstone.llm.simhash import dedup_stage
from siltstone.llm.toxicity import toxicity_stage


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression-distance classifier does not take for toxic."""
    return toxicity_stage(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of texts whose sets of five-word shingles have Jaccard similarity 0.8 or more."""
    return dedup_stage(docs, words=5)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a ten-word window of a benchmark item."""
    return decontaminate_stage(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mix_stage(docs)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their shard and slot along the Hilbert curve."""
    return shard_stage(docs)


STAGES = [
    ("toxicity", toxicity),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("sharding", sharding),
]

#: Compression lengths, components and the knapsack have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``, each one's result written to the shared folder for the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = materialize(docs)
    return docs
