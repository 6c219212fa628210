"""Exact nearest vectors of batches of queries.

The queries travel to the vectors, never the other way round: blocks of at most ``BLOCK`` query vectors are
shipped with the task, each Arrow batch is one matrix product, and only its k best rows a query leave it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.operators.topk import top_k

#: Query vectors of one block; more queries are more blocks, one after another.
BLOCK = 4096


def _matrix(values: pa.Array) -> np.ndarray:
    if not len(values):
        return np.zeros((0, 0))
    flat = np.asarray(values.flatten(), np.float64)
    return flat.reshape(len(values), -1)


def scores_of(points: np.ndarray, queries: np.ndarray, distance: str) -> np.ndarray:
    """(points, queries) similarities, higher is nearer."""
    if distance == "Euclid":
        return -np.sqrt(np.maximum((points**2).sum(1)[:, None] + (queries**2).sum(1)[None] - 2 * points @ queries.T, 0))
    if distance == "Manhattan":
        return -np.stack([np.abs(points - q).sum(1) for q in queries], axis=1)
    product = points @ queries.T
    if distance == "Dot":
        return product
    norms = np.sqrt((points**2).sum(1))[:, None] * np.sqrt((queries**2).sum(1))[None]
    return np.divide(product, norms, out=np.zeros_like(product), where=norms > 0)


def dense_topk(
    queries: DataFrame, points: DataFrame, k: int = 10, *, key: str = "chunk_id", vector: str = "dense", query_vector: str = "dense",
    distance: str = "Cosine", where: Column | None = None, block: int = BLOCK,
) -> DataFrame:
    """(query_id, rank, key, score) of the k nearest ``points`` of each query, after the filter ``where``."""
    if distance not in ("Cosine", "Dot", "Euclid", "Manhattan"):
        raise ValueError(f"unknown distance {distance!r}")
    there = (points.where(where) if where is not None else points).where(F.col(vector).isNotNull()).select(F.col(key).cast("long").alias(key), vector)
    parts: list[DataFrame] = []
    ids: list[int] = []
    vectors: list[list[float]] = []

    def ask(names: np.ndarray, matrix: np.ndarray) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = _matrix(batch.column(1))
                if not len(found):
                    continue
                keys = np.asarray(batch.column(0))
                order = np.argsort(keys, kind="stable")
                scores = scores_of(found[order], matrix, distance)
                # Stable sort of the rounded scores keeps the smaller key first, as the final ranking does.
                best = np.argsort(-np.round(scores, 9), axis=0, kind="stable")[:k]
                rows = best.T.ravel()
                asked = np.repeat(np.arange(len(names)), len(best))
                yield pa.RecordBatch.from_arrays([pa.array(names[asked]), pa.array(keys[order][rows]), pa.array(scores[rows, asked])], ["query_id", key, "score"])

        return there.mapInArrow(run, f"query_id long, `{key}` long, score double")

    for row in queries.where(F.col(query_vector).isNotNull()).select("query_id", query_vector).toLocalIterator():
        ids.append(row[0])
        vectors.append(row[1])
        if len(ids) == block:
            parts.append(ask(np.array(ids, np.int64), np.array(vectors, np.float64)))
            ids, vectors = [], []
    if ids or not parts:
        parts.append(ask(np.array(ids, np.int64), np.array(vectors, np.float64).reshape(len(ids), -1)) if ids else there.limit(0).select(F.lit(0).cast("long").alias("query_id"), key, F.lit(0.0).alias("score")))
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    return top_k(every, k, key).select("query_id", "rank", key, "score")
