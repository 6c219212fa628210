"""Reranking of hits by a scorer of (query, text)."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from siltstone.functions.text import tokenize


def overlap_score(query: Column, text: Column) -> Column:
    """Offline scorer: Jaccard similarity of the two texts' terms."""
    a, b = F.array_distinct(tokenize(query)), F.array_distinct(tokenize(text))
    return F.coalesce(F.try_divide(F.size(F.array_intersect(a, b)).cast("double"), F.size(F.array_union(a, b))), F.lit(0.0))


def rerank(hits: DataFrame, score: Column | None, top_k: int | None = None) -> DataFrame:
    """Hits in descending rerank_score, ties in their former order; no scorer leaves them as they are."""
    if score is None:
        out = hits.withColumn("rerank_score", F.lit(None).cast("double"))
    else:
        order = Window.partitionBy("query_id").orderBy(F.round("rerank_score", 9).desc(), "rank")
        out = hits.withColumn("rerank_score", F.coalesce(score, F.lit(0.0))).withColumn("rank", F.row_number().over(order))
    return out.where(F.col("rank") <= top_k) if top_k is not None else out


def http_scorer(url: str, timeout: float = 60.0, batch: int = 32) -> Callable[[Column, Column], Column]:
    """Scorer that posts {query, texts} to ``url``/rerank; replies are a list of scores or of {index, score}."""

    @F.pandas_udf("double")
    def scored(query: pd.Series, text: pd.Series) -> pd.Series:
        import json
        import urllib.request

        out = pd.Series(0.0, index=query.index)
        for asked, rows in query.groupby(query, sort=False):
            for at in range(0, len(rows), batch):
                index = rows.index[at : at + batch]
                body = json.dumps({"query": asked, "texts": text[index].tolist()}).encode()
                request = urllib.request.Request(f"{url}/rerank", body, {"Content-Type": "application/json"})
                with urllib.request.urlopen(request, timeout=timeout) as r:
                    reply = json.load(r)
                out[index] = parse_scores(reply, len(index))
        return out

    return scored


def parse_scores(reply, n: int) -> list[float]:
    """Scores by position of either reply form; an index that is missing scores 0."""
    rows = reply.get("results", reply.get("scores", [])) if isinstance(reply, dict) else reply
    out = [0.0] * n
    for i, x in enumerate(rows):
        at, value = (int(x["index"]), x.get("score", x.get("relevance_score", 0.0))) if isinstance(x, dict) else (i, x)
        if 0 <= at < n:
            out[at] = float(value)
    return out
