"""Ranking and materialising helpers."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Rows up to which a counted side may be broadcast.
SMALL = 50_000


def small(df: DataFrame, rows: int = SMALL) -> DataFrame:
    """Broadcast ``df`` if it counts at most ``rows`` rows; leave it to Spark's own choice, a shuffle, beyond that."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def scratch(spark: SparkSession, df: DataFrame) -> DataFrame:
    """Write an expensive intermediate to the shared folder and read it back: it is computed once, and survives lost executors."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        spark.sparkContext.setCheckpointDir("/tmp/siltstone-checkpoints")
        base = spark.sparkContext.getCheckpointDir()
    path = f"{base.rstrip('/')}/stage-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def settled(df: DataFrame, rows: int = SMALL) -> DataFrame:
    """small() for what is expensive to compute: written first, then counted."""
    return small(scratch(df.sparkSession, df), rows)


def top_k(scores: DataFrame, k: int, key: str = "chunk_id", tie: tuple[str, ...] | None = None, score: str = "score", by: str = "query_id") -> DataFrame:
    """The k best rows of each query with their 1-based rank; ties go to the smaller key.

    The limit is pushed below the exchange, so that a task sends k rows a query at most.
    """
    order = Window.partitionBy(by).orderBy(F.round(score, 9).desc(), *(tie or (key,)))
    return scores.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
