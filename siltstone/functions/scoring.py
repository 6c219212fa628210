"""Weights, similarities and the parsing of model replies."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

K1, B = 1.5, 0.75
RRF_K = 60


def idf(n_docs: Column, df: Column) -> Column:
    return F.log(F.lit(1.0) + (n_docs - df + F.lit(0.5)) / (df + F.lit(0.5)))


def bm25_weight(tf: Column, length: Column, average: Column, k1: float = K1, b: float = B) -> Column:
    """Saturated term weight; without an average length the text's own, or 1, takes its place."""
    mean = F.coalesce(F.nullif(average.cast("double"), F.lit(0.0)), F.nullif(length.cast("double"), F.lit(0.0)), F.lit(1.0))
    return tf * F.lit(k1 + 1) / (tf + F.lit(k1) * (F.lit(1 - b) + F.lit(b) * length / mean))


def _fold(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x)


def dot(a: Column, b: Column) -> Column:
    return _fold(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")))


def similarity(a: Column, b: Column, distance: str = "Cosine") -> Column:
    """Higher is nearer: Cosine, Dot, or minus the Euclid or Manhattan distance."""
    gap = lambda f: _fold(F.zip_with(a, b, lambda x, y: f(x.cast("double") - y.cast("double"))))
    if distance == "Dot":
        return dot(a, b)
    if distance == "Euclid":
        return -F.sqrt(gap(lambda d: d * d))
    if distance == "Manhattan":
        return -gap(F.abs)
    if distance == "Cosine":
        return F.coalesce(F.try_divide(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))), F.lit(0.0))
    raise ValueError(f"unknown distance {distance!r}")


def rrf(rank: Column, k: int = RRF_K) -> Column:
    return F.lit(1.0) / (F.lit(k) + rank)


def parse_grades(reply: Column, n: int, neutral: float = 0.5) -> Column:
    """``n`` grades from 0 to 1 of a JSON reply, {"grades": [...]} or a bare list; what is missing or no number is neutral.

    true counts as 1 and NaN as 1, as they do where grades are clamped numbers.
    """
    grades = F.coalesce(F.from_json(reply, "struct<grades: array<string>>").getField("grades"), F.from_json(reply, "array<string>"), F.array().cast("array<string>"))

    def grade(i: Column) -> Column:
        raw = F.get(grades, i)
        value = F.when(raw == "true", F.lit(1.0)).when(raw == "false", F.lit(0.0)).otherwise(raw.try_cast("double"))
        return F.when(value.isNull(), F.lit(neutral)).when(F.isnan(value), F.lit(1.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), value)))

    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), grade) if n > 0 else F.array().cast("array<double>")


def parse_expansions(reply: Column, query: Column, n: int) -> Column:
    """At most ``n`` paraphrases of a JSON reply, {"queries": [...]} or a bare list: trimmed, not the query, each once whatever its case."""
    if n <= 0:
        return F.array().cast("array<string>")
    raw = F.coalesce(F.from_json(reply, "struct<queries: array<string>>").getField("queries"), F.from_json(reply, "array<string>"), F.array().cast("array<string>"))
    clean = F.filter(F.transform(raw, lambda x: F.trim(x)), lambda x: x.isNotNull() & (x != "") & (F.lower(x) != F.lower(F.trim(query))))
    first = F.filter(clean, lambda x, i: ~F.exists(F.slice(clean, F.lit(1), i), lambda y: F.lower(y) == F.lower(x)))
    return F.slice(first, 1, n)
