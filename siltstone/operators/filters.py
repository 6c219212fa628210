"""Payload filters as columns: must, should and must_not over match, any and range."""

from __future__ import annotations

from functools import reduce
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F


def _one(condition: dict[str, Any]) -> Column:
    if any(k in condition for k in ("must", "should", "must_not")):
        return payload_filter(condition)
    value = F.col(condition["key"])
    if "match" in condition:
        match = condition["match"]
        if "any" in match:
            return F.coalesce(value.isin(list(match["any"])), F.lit(False))
        return F.coalesce(value == F.lit(match["value"]), F.lit(False))
    if "range" in condition:
        ops = {"gt": Column.__gt__, "gte": Column.__ge__, "lt": Column.__lt__, "lte": Column.__le__}
        return F.coalesce(reduce(Column.__and__, [ops[k](value, F.lit(v)) for k, v in condition["range"].items()]), F.lit(False))
    raise ValueError(f"unknown condition {condition!r}")


def payload_filter(query_filter: dict[str, Any] | None) -> Column:
    """A predicate to be applied before scoring; no filter is true."""
    out = F.lit(True)
    if not query_filter:
        return out
    for c in query_filter.get("must", []):
        out = out & _one(c)
    if query_filter.get("should"):
        out = out & reduce(Column.__or__, [_one(c) for c in query_filter["should"]])
    for c in query_filter.get("must_not", []):
        out = out & ~_one(c)
    return out
