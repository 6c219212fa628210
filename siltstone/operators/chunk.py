"""Overlapping, token-budgeted chunks with a cap on characters.

Most texts never meet the cap: their windows are slices of the word array, in the JVM. The few that do - a word
or a window beyond the cap - are chunked step by step in Arrow batches, since each window's start depends on
what the one before could hold. Without a cap every text is sliced in the JVM.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType

from siltstone.functions.text import SPACE, stable_id, words

WORDS_PER_TOKEN = 0.75
MOST_CHARS = 5000
#: A length that no text exceeds.
NEVER = (1 << 31) - 1


@dataclass(frozen=True)
class Budget:
    """Words of a window and of the overlap of two; halves are rounded to even."""

    window: int
    overlap: int

    @classmethod
    def of(cls, max_tokens: int = 512, overlap_tokens: int = 64) -> Budget:
        window = max(1, round(max_tokens * WORDS_PER_TOKEN))
        return cls(window, min(max(0, round(overlap_tokens * WORDS_PER_TOKEN)), window - 1))

    @property
    def step(self) -> int:
        return self.window - self.overlap


def capped_windows(found: list[str], budget: Budget, most: int = MOST_CHARS) -> list[str]:
    """Windows that hold as many words as budget and cap let them; each starts ``overlap`` words before the last's end, and at least one word on."""
    pieces = [w[k : k + most] for w in found for k in range(0, len(w), most)]
    out, start = [], 0
    while start < len(pieces):
        size, end = len(pieces[start]), start + 1
        while end < len(pieces) and end - start < budget.window and size + 1 + len(pieces[end]) <= most:
            size += 1 + len(pieces[end])
            end += 1
        out.append(" ".join(pieces[start:end]))
        if end == len(pieces):
            break
        start += max(1, end - start - budget.overlap)
    return out


def chunk(docs: DataFrame, budget: Budget | None = None, keep: tuple[str, ...] = (), most: int | None = MOST_CHARS, space: str = SPACE) -> DataFrame:
    """chunk_id, source_uri, ordinal, text and the columns ``keep`` for each chunk of ``docs`` (uri, text); None: no cap on characters."""
    budget = budget or Budget.of()
    kept = [F.col(c) for c in keep]

    def cut(rows: DataFrame) -> DataFrame:
        split = rows.select(F.col("uri").cast("string").alias("source_uri"), *kept, words(F.col("text"), space).alias("words"))
        n = F.greatest(F.ceil((F.size("words") - F.lit(budget.overlap)) / F.lit(budget.step)), F.lit(1)).cast("int")
        starts = F.when(F.size("words") > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
        windows = F.transform(starts, lambda o: F.array_join(F.slice("words", o * F.lit(budget.step) + 1, F.lit(budget.window)), " "))
        return split.withColumn("windows", windows)

    named = (stable_id("source_uri", "ordinal").alias("chunk_id"), "source_uri", F.col("ordinal").cast("int"), "text", *keep)

    # A word beyond the cap makes its window longer than the cap. The test stands in generators: a filter would be
    # pushed below the projections, which would then split the text anew for each of its windows.
    binds = F.exists("windows", lambda w: F.length(w) > (NEVER if most is None else most))
    split = cut(docs)
    fast = split.select("source_uri", *keep, F.posexplode(F.when(binds, F.array().cast("array<string>")).otherwise(F.col("windows"))).alias("ordinal", "text"))
    if most is None:
        return fast.select(*named)
    # Texts that are not longer than the cap never meet it.
    long_ = cut(docs.where(F.length("text") > most))
    slow = long_.select("source_uri", *keep, F.explode(F.when(binds, F.array("words")).otherwise(F.array().cast("array<array<string>>"))).alias("words"))
    shape = split.select("source_uri", *keep).schema.add("ordinal", IntegerType()).add("text", StringType())

    def slowly(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch["text"] = [list(enumerate(capped_windows(list(w), budget, most))) for w in batch.pop("words")]
            rows = batch.explode("text", ignore_index=True).dropna(subset=["text"])
            rows["ordinal"] = [x[0] for x in rows["text"]]
            rows["text"] = [x[1] for x in rows["text"]]
            yield rows[shape.names]

    both = fast.unionByName(slow.mapInPandas(slowly, shape))
    return both.select(*named)
