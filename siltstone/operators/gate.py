"""Three-way relevance gate: kept, rejected and failed rows all stay visible."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GATE_CHARS = 2000
NO_VERDICT = "gate: missing or invalid verdict"


def route(docs: DataFrame, keep: Column, reason: Column | None = None) -> DataFrame:
    """Adds state (gated, skipped or error) and reason by a boolean verdict; a null verdict is an error."""
    state = F.when(keep.isNull(), F.lit("error")).when(keep, F.lit("gated")).otherwise(F.lit("skipped"))
    why = F.when(keep.isNull(), F.lit(NO_VERDICT)).otherwise(F.coalesce(reason if reason is not None else F.lit(None).cast("string"), F.lit("")))
    return docs.withColumns({"state": state, "reason": why})


def parse_verdict(reply: Column) -> tuple[Column, Column]:
    """keep (null unless a JSON boolean) and reason of a model reply."""
    # A typed parse: a string "true", or a verdict inside another string, is none.
    parsed = F.from_json(reply, "keep boolean, reason string")
    return parsed["keep"], F.coalesce(parsed["reason"], F.lit(""))


def gate(docs: DataFrame, model: Callable[[Column, Column], Column] | None) -> DataFrame:
    """Without a model every row is gated; else ``model`` maps title and the first 2000 characters to a JSON reply."""
    if model is None:
        return route(docs, F.lit(True))
    replied = docs.withColumn("__reply", model(F.col("title"), F.substring(F.coalesce("text", F.lit("")), 1, GATE_CHARS)))
    keep, reason = parse_verdict(F.col("__reply"))
    failed = F.get_json_object("__reply", "$.failed")
    told = route(replied, keep, reason)
    return told.withColumn("reason", F.when(F.col("state") == "error", F.concat_ws(": ", "reason", failed)).otherwise(F.col("reason"))).drop("__reply")
