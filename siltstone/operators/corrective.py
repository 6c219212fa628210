"""Corrective retrieval: grades, dropping, and which queries need a second try."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType
from pyspark.sql.window import Window

from siltstone.functions.text import tokenize

POOL, PASSAGE_CHARS = 10, 600
DROP, FLOOR = 0.25, 0.5


def overlap_grade(query: Column, text: Column) -> Column:
    """Offline grader: the share of the query's terms that the passage's first 600 characters have; 0.5 without terms."""
    asked = F.array_distinct(tokenize(query))
    there = F.array_intersect(asked, tokenize(F.substring(text, 1, PASSAGE_CHARS)))
    return F.coalesce(F.try_divide(F.size(there).cast("double"), F.size(asked)), F.lit(0.5))


def service_grades(hits: DataFrame, model: Callable[[str, list[str]], list], pool: int = POOL) -> DataFrame:
    """``hits`` (query_id, rank, query, text, ...) with the column grade: one call for the first ``pool`` hits of each query.

    A failed call, and what a reply lacks or says wrongly, counts 0.5; the tail has null. At most ``pool`` rows meet in a group.
    """
    asked = hits.where(F.col("rank") <= pool).select("query_id", "rank", "query", F.substring("text", 1, PASSAGE_CHARS).alias("text"))
    shape = StructType([hits.schema["query_id"], hits.schema["rank"], StructField("grade", DoubleType())])

    def run(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("rank")
        try:
            said = list(model(part["query"].iloc[0], part["text"].tolist()))
        except Exception:
            said = []
        return part[["query_id", "rank"]].assign(grade=graded(said, len(part)))

    return hits.join(asked.groupBy("query_id").applyInPandas(run, shape), ["query_id", "rank"], "left")


def graded(said: list, n: int) -> list[float]:
    """``n`` grades from 0 to 1; what is missing or no number counts 0.5."""
    number = lambda x: isinstance(x, (int, float)) and not isinstance(x, bool) and x == x
    found = [min(1.0, max(0.0, float(x))) if number(x) else 0.5 for x in said[:n]]
    return found + [0.5] * (n - len(found))


def apply_grades(hits: DataFrame, grade: Column, drop: float = DROP) -> DataFrame:
    """Graded hits at or above ``drop`` in their order, with grade and best, the query's maximum over all graded hits."""
    best = F.max("grade").over(Window.partitionBy("query_id"))
    return hits.withColumn("grade", grade).withColumn("best", best).where(F.col("grade") >= drop)


def correct(hits: DataFrame, grade: Column, drop: float = DROP, pool: int = POOL) -> tuple[DataFrame, DataFrame]:
    """(kept hits with new ranks, best grade of every query): only the first ``pool`` are graded, the tail stays."""
    graded = hits.withColumn("grade", F.when(F.col("rank") <= pool, grade))
    best = graded.groupBy("query_id").agg(F.coalesce(F.max("grade"), F.lit(0.0)).alias("best"))
    kept = graded.where(F.col("grade").isNull() | (F.col("grade") >= drop))
    order = Window.partitionBy("query_id").orderBy("rank")
    return kept.withColumn("rank", F.row_number().over(order)), best


def weak(best: DataFrame, floor: float = FLOOR) -> DataFrame:
    """Queries whose best grade is below ``floor``."""
    return best.where(F.coalesce("best", F.lit(0.0)) < floor).select("query_id")
