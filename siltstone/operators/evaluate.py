"""Retrieval metrics: golden questions, recall at k, reciprocal rank, comparison of reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from siltstone.functions.text import basename, words
from siltstone.operators.topk import scratch, settled, small

LEAST_QUERY = 15
#: One text in COUNTED tells which of a query's words is rare; any choice gives the same rows.
COUNTED = 16


def golden_filter(asked: DataFrame, least: int = LEAST_QUERY) -> DataFrame:
    """(uri, pos, query): trimmed questions that are long enough, the first of its kind in its document, and do not name the file."""
    query, tail = F.trim(F.col("query")), basename(F.col("uri"))
    clean = asked.where(F.col("query").isNotNull()).withColumn("query", query)
    good = clean.where((F.length("query") >= least) & ~((tail != "") & F.contains(F.lower("query"), tail)))
    first = Window.partitionBy("uri", F.lower("query")).orderBy("pos")
    return good.withColumn("__n", F.row_number().over(first)).where("__n = 1").select("uri", "pos", "query")


def containing(docs: DataFrame, queries: DataFrame) -> DataFrame:
    """(query_id, uri) of the texts (uri, text) that contain a query verbatim.

    A query's words but its first and last are whole words of each text that contains it: it is compared to the texts
    that hold the rarest of them only. Queries of one or two words are compared to all texts.
    """
    spark = docs.sparkSession
    listed = words(F.col("query"))
    asked = scratch(spark, queries.select("query_id", "query", F.array_distinct(F.slice(listed, 2, F.greatest(F.size(listed) - 2, F.lit(0)))).alias("inner")))
    wanted = asked.select("query_id", F.explode("inner").alias("word"))
    there = lambda d: d.select("uri", F.explode(words(F.col("text"))).alias("word"))
    part = docs.where(F.pmod(F.xxhash64("uri"), F.lit(COUNTED)) == 0)
    counts = there(part).join(small(wanted.select("word").distinct()), "word", "left_semi").groupBy("word").agg(F.count("*").alias("n"))
    rarest = wanted.join(counts, "word", "left").groupBy("query_id").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "word")).alias("x"))
    anchors = settled(rarest.select("query_id", F.col("x.word").alias("word")))
    pairs = settled(there(docs).join(anchors, "word").select("query_id", "uri").distinct())
    same = F.contains(F.col("text"), F.col("query"))
    found = docs.select("uri", "text").join(pairs, "uri").join(small(asked.select("query_id", "query")), "query_id").where(same).select("query_id", "uri")
    short = asked.where(F.size("inner") == 0)
    return found if short.isEmpty() else found.unionByName(docs.join(small(short), same).select("query_id", "uri"))


def relevant_hits(golden: DataFrame, ranked: DataFrame) -> DataFrame:
    """(query_id, rank) of the retrieved documents that are relevant; ``ranked`` has (query_id, uri, rank)."""
    wanted = golden.select("query_id", F.explode(F.array_distinct("relevant_uris")).alias("uri"))
    return ranked.join(wanted, ["query_id", "uri"], "left_semi").select("query_id", "rank")


def per_query(golden: DataFrame, ranked: DataFrame, k_values: Sequence[int], errored: DataFrame | None = None) -> DataFrame:
    """query_id, recall_<k> for each k, first_rank (null: none) and errored of every golden query.

    Recall divides by the length of the relevant list, repeats counted; an empty list scores 0, and so does a
    query that failed. Ranks go over the whole list, not to the largest k.
    """
    if not k_values:
        raise ValueError("k_values is empty")
    hits = relevant_hits(golden, ranked)
    found = hits.groupBy("query_id").agg(F.min("rank").alias("first_rank"), *[F.count_if(F.col("rank") <= k).alias(f"found_{k}") for k in k_values])
    joined = golden.select("query_id", F.size("relevant_uris").alias("n")).join(found, "query_id", "left")
    joined = joined.join(errored.select("query_id", F.lit(True).alias("errored")), "query_id", "left") if errored is not None else joined.withColumn("errored", F.lit(False))
    ok = ~F.coalesce("errored", F.lit(False))
    recall: list[Column] = [F.coalesce(F.when(ok, F.try_divide(F.col(f"found_{k}").cast("double"), F.col("n"))), F.lit(0.0)).alias(f"recall_{k}") for k in k_values]
    return joined.select("query_id", *recall, F.when(ok, F.col("first_rank")).alias("first_rank"), (~ok).alias("errored"))


def recall_at_k(scored: DataFrame, k_values: Sequence[int]) -> DataFrame:
    """(k, recall): means over all queries, 0 without any."""
    pairs = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.col(f"recall_{k}").alias("recall")) for k in k_values]))
    found = scored.select(pairs.alias("x")).groupBy("x.k").agg(F.avg("x.recall").alias("recall"))
    every = scored.sparkSession.createDataFrame([(k,) for k in dict.fromkeys(k_values)], "k int")
    return every.join(found, "k", "left").select("k", F.coalesce("recall", F.lit(0.0)).alias("recall"))


def mrr(scored: DataFrame) -> DataFrame:
    """One row: n_queries, n_errored and mrr."""
    return scored.agg(
        F.count("*").alias("n_queries"), F.count_if("errored").alias("n_errored"),
        F.coalesce(F.avg(F.coalesce(F.lit(1.0) / F.col("first_rank"), F.lit(0.0))), F.lit(0.0)).alias("mrr"),
    )


def compare(baseline: DataFrame, current: DataFrame) -> DataFrame:
    """(k, baseline, current, delta) of the k that both reports have."""
    return current.select("k", F.col("recall").alias("current")).join(baseline.select("k", F.col("recall").alias("baseline")), "k").select(
        "k", "baseline", "current", (F.col("current") - F.col("baseline")).alias("delta")
    )


def warnings(baseline: dict, current: dict) -> list[str]:
    """What makes two reports hard to compare."""
    keys = ("collection", "n_queries", "rerank", "hybrid", "multi", "corrective", "gen_model")
    return [f"{k} differs: {baseline.get(k)!r} and {current.get(k)!r}" for k in keys if baseline.get(k) != current.get(k)]
