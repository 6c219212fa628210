"""BM25: postings, corpus statistics, and the sparse scores of batches of queries.

Postings hold term frequencies and lengths only; idf and the average length are applied when a query is
asked, so that they never go stale. Terms are joined as strings.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.functions.scoring import K1, B, bm25_weight, idf
from siltstone.functions.text import tokenize
from siltstone.operators.topk import scratch, small, top_k

#: Queries of one block, and numbers of one matrix of term frequencies.
BLOCK, MATRIX = 256, 2_000_000


def postings(chunks: DataFrame, key: str = "chunk_id", text: str = "text", terms: DataFrame | None = None) -> DataFrame:
    """(key, term, tf, length), of the given terms only if there are any; cut before and partly aggregated in the map stage."""
    tokens = chunks.select(F.col(key), tokenize(F.col(text)).alias("tokens")).select(key, F.size("tokens").cast("long").alias("length"), F.explode("tokens").alias("term"))
    if terms is not None:
        tokens = tokens.join(terms, "term", "left_semi")
    return tokens.groupBy(key, "term").agg(F.count("*").alias("tf"), F.max("length").alias("length"))


def row_postings(chunks: DataFrame, terms: DataFrame, key: str = "chunk_id", text: str = "text") -> DataFrame:
    """postings() of the given terms, counted where a text is read; only if keys repeat are they brought together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            coded = pc.dictionary_encode(lists.flatten())
            if not len(coded):
                continue
            sizes, width = np.diff(np.asarray(lists.offsets)), len(coded.dictionary)
            owner = np.repeat(np.arange(len(sizes), dtype=np.int64), sizes)
            pairs, tf = np.unique(owner * width + np.asarray(coded.indices), return_counts=True)
            owner = pairs // width
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(owner)), coded.dictionary.take(pa.array(pairs % width)), pa.array(tf.astype(np.int64)), pa.array(sizes[owner].astype(np.int64))],
                [key, "term", "tf", "length"],
            )

    tokens = chunks.select(F.col(key), tokenize(F.col(text)).alias("tokens"))
    counted = tokens.mapInArrow(run, f"`{key}` {chunks.schema[key].dataType.simpleString()}, term string, tf long, length long").join(terms, "term", "left_semi")
    if not chunks.groupBy(key).agg(F.count("*").alias("n")).where("n > 1").isEmpty():
        counted = counted.groupBy(key, "term").agg(F.sum("tf").alias("tf"), F.max("length").alias("length"))
    return counted.select(key, "term", "tf", "length")


def corpus_stats(chunks: DataFrame, text: str = "text") -> DataFrame:
    """One row: n_docs, total_len, avgdl (0 without chunks)."""
    return (
        chunks.select(F.size(tokenize(F.col(text))).cast("long").alias("length"))
        .agg(F.count("*").alias("n_docs"), F.coalesce(F.sum("length"), F.lit(0)).alias("total_len"))
        .withColumn("avgdl", F.coalesce(F.try_divide(F.col("total_len").cast("double"), F.col("n_docs")), F.lit(0.0)))
    )


def doc_freq(posted: DataFrame) -> DataFrame:
    """term and the number of chunks that have it."""
    return posted.groupBy("term").agg(F.count("*").alias("df"))


def query_terms(queries: DataFrame) -> DataFrame:
    """(query_id, term), each term of a query once."""
    return queries.select("query_id", F.explode(F.array_distinct(tokenize(F.col("query")))).alias("term"))


def bm25_scores(queries: DataFrame, posted: DataFrame, stats: DataFrame, frequencies: DataFrame | None = None, key: str = "chunk_id") -> DataFrame:
    """(query_id, key, score) of all pairs that share a term.

    Postings are cut to the queries' terms by a join with them before anything else; the side of the queries is
    broadcast if it is small.
    """
    asked = query_terms(queries)
    few = small(asked.select("term").distinct())
    there = posted.join(few, "term", "left_semi")
    counts = (frequencies if frequencies is not None else doc_freq(there)).join(few, "term", "left_semi")
    weighed = asked.join(counts, "term", "left").crossJoin(F.broadcast(stats)).select(
        "query_id", "term", idf(F.col("n_docs"), F.coalesce("df", F.lit(0))).alias("idf"), "avgdl"
    )
    pairs = there.join(small(weighed), "term")
    weight = F.col("idf") * bm25_weight(F.col("tf"), F.col("length"), F.col("avgdl"))
    return pairs.groupBy("query_id", key).agg(F.sum(weight).alias("score"))


def _weights(queries: DataFrame, terms: DataFrame, stats: DataFrame, block: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Blocks of queries: their ids, the ids of their terms, and the (terms, queries) matrix of idf weights."""
    rows = query_terms(queries).join(small(terms), "term").crossJoin(F.broadcast(stats)).select("query_id", "id", idf(F.col("n_docs"), F.col("df")).alias("w"))
    ids: list[int] = []
    held: list[tuple[int, int, float]] = []

    def close() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        known = np.unique([t for _, t, _ in held])
        matrix = np.zeros((len(known), len(ids)))
        matrix[np.searchsorted(known, [t for _, t, _ in held]), [q for q, _, _ in held]] = [w for *_, w in held]
        return np.array(ids, np.int64), known.astype(np.int64), matrix

    for query_id, term, weight in rows.orderBy("query_id", "id").toLocalIterator():
        if not ids or ids[-1] != query_id:
            if len(ids) >= block:
                yield close()
                ids, held = [], []
            ids.append(query_id)
        held.append((len(ids) - 1, term, weight))
    if ids:
        yield close()


def bm25_topk(queries: DataFrame, chunks: DataFrame, k: int = 10, key: str = "chunk_id", tie: tuple[str, ...] | None = None, block: int = BLOCK) -> DataFrame:
    """(query_id, rank, key, score): the k best chunks of each query; without an index, so texts are read for postings and for statistics.

    A chunk's asked terms become one row of numbers where its text is read. The scores of an Arrow batch of chunks
    with a block of queries are one matrix product, of which k rows a query leave the task: pairs are never rows.
    """
    spark = chunks.sparkSession
    # Numbered on the driver's side of a small, distinct list.
    named = query_terms(queries).select("term").distinct()
    numbered = small(scratch(spark, named.withColumn("id", F.monotonically_increasing_id())))
    tokens = chunks.select(F.col(key).cast("long").alias(key), tokenize(F.col("text")).alias("tokens")).select(key, F.size("tokens").alias("length"), F.explode("tokens").alias("term"))
    rows = scratch(spark, tokens.join(numbered, "term").groupBy(key, "length").agg(F.collect_list("id").alias("ids")))
    stats = scratch(spark, corpus_stats(chunks))
    counts = rows.select(F.explode(F.array_distinct("ids")).alias("id")).groupBy("id").agg(F.count("*").alias("df"))
    average = stats.first()["avgdl"] or 1.0
    parts: list[DataFrame] = []
    for names, known, matrix in _weights(queries, scratch(spark, numbered.join(counts, "id")), stats, block):
        parts.append(rows.mapInArrow(_scored(names, known, matrix, average, k, key), f"query_id long, `{key}` long, score double"))
    if not parts:
        return rows.limit(0).select(F.lit(0).cast("long").alias("query_id"), F.lit(1).alias("rank"), key, F.lit(0.0).alias("score"))
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    return top_k(every, k, key, tie).select("query_id", "rank", key, "score")


def _scored(names: np.ndarray, known: np.ndarray, matrix: np.ndarray, average: float, k: int, key: str):
    step = max(1, min(512, MATRIX // max(1, len(known))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, lengths = np.asarray(batch.column(0)), np.asarray(batch.column(1), np.float64)
            sizes = np.diff(np.asarray(batch.column(2).offsets))
            terms = np.asarray(batch.column(2).flatten())
            place = np.minimum(np.searchsorted(known, terms), max(len(known) - 1, 0))
            hit = known[place] == terms
            owner, place = np.repeat(np.arange(len(keys)), sizes)[hit], place[hit]
            best_scores, best_keys = [], []
            for at in range(0, len(keys), step):
                n = min(step, len(keys) - at)
                a, b = np.searchsorted(owner, [at, at + n])
                tf = np.bincount((owner[a:b] - at) * len(known) + place[a:b], minlength=n * len(known)).reshape(n, len(known)).astype(float)
                scores = (tf * (K1 + 1) / (tf + K1 * (1 - B + B * lengths[at : at + n, None] / average))) @ matrix
                best_scores.append(scores)
                best_keys.append(keys[at : at + n])
            if not best_scores:
                continue
            scores, order = np.concatenate(best_scores), np.argsort(np.concatenate(best_keys), kind="stable")
            scores, keys = scores[order], np.concatenate(best_keys)[order]
            best = np.argsort(-np.round(scores, 9), axis=0, kind="stable")[:k]
            rows, asked = best.T.ravel(), np.repeat(np.arange(len(names)), len(best))
            found = scores[rows, asked] > 0
            yield pa.RecordBatch.from_arrays([pa.array(names[asked][found]), pa.array(keys[rows][found]), pa.array(scores[rows, asked][found])], ["query_id", key, "score"])

    return run


def sparse_vector(posted: DataFrame, stats: DataFrame, key: str = "chunk_id") -> DataFrame:
    """Serialised document vectors: (key, indices, values) with parallel arrays in term order."""
    weighed = posted.crossJoin(F.broadcast(stats)).select(key, F.struct("term", bm25_weight(F.col("tf"), F.col("length"), F.col("avgdl")).alias("w")).alias("x"))
    listed = weighed.groupBy(key).agg(F.array_sort(F.collect_list("x")).alias("xs"))
    return listed.select(key, F.col("xs.term").alias("indices"), F.col("xs.w").alias("values"))


def idf_top_terms(posted: DataFrame, stats: DataFrame, k: int) -> DataFrame:
    """The k rarest terms."""
    scored = doc_freq(posted).crossJoin(F.broadcast(stats)).select("term", "df", F.round(idf(F.col("n_docs"), F.col("df")), 6).alias("idf"))
    return scored.orderBy(F.desc("idf"), "term").limit(k)


