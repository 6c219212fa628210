"""Reciprocal rank fusion of ranked lists, and ordered lists of distinct documents."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from siltstone.functions.scoring import RRF_K, rrf


def union_lists(*lists: DataFrame) -> DataFrame:
    """A bag of ranked lists, each row with its list's number."""
    numbered = [df.withColumn("list_no", F.lit(i)) for i, df in enumerate(lists)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), numbered)


def rrf_fuse(ranked: DataFrame, k: int | None = None, rrf_k: int = RRF_K, key: str = "chunk_id") -> DataFrame:
    """(query_id, rank, key, rrf_score, score): sum of 1 / (rrf_k + rank) over lists, score of the first sighting.

    Ties go to the id seen first: by list, then rank. Rows without a key are dropped; an id twice in a list counts twice.
    """
    seen = F.struct("list_no", "rank")
    fused = (
        ranked.where(F.col(key).isNotNull())
        .groupBy("query_id", key)
        .agg(F.sum(rrf(F.col("rank"), rrf_k)).alias("rrf_score"), F.min_by("score", seen).alias("score"), F.min(seen).alias("first"))
    )
    order = Window.partitionBy("query_id").orderBy(F.round("rrf_score", 12).desc(), "first")
    out = fused.withColumn("rank", F.row_number().over(order)).drop("first")
    return out.where(F.col("rank") <= k) if k is not None else out


def distinct_in_order(hits: DataFrame, uri: str = "source_uri") -> DataFrame:
    """(query_id, rank, uri): first occurrence of every non-empty uri, ranked densely."""
    first = hits.where(F.col(uri).isNotNull() & (F.col(uri) != "")).groupBy("query_id", uri).agg(F.min("rank").alias("first"))
    return first.select("query_id", uri, F.row_number().over(Window.partitionBy("query_id").orderBy("first", uri)).alias("rank"))
