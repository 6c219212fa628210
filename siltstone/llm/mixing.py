"""Mixing sources to target weights by subset-sum budget fitting.

Documents are counted by exact token length; each source's budget beyond whole copies is spread over its
lengths in proportion, and what is left is closed by a bounded-knapsack dynamic program over the remaining
length counts. Documents are then taken in a seeded order within each length.

Defined cases: null text has no words; a null source is a source of its own, last in order; empty texts and
empty tables take nothing; repeated rows are separate documents; other columns, whatever their names, do
not matter. A source never takes more than two copies of a document.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from siltstone.llm.common import WORD, materialize, pack, small, tie_break

WEIGHTS = (5, 2, 1)
#: Seeded hash buckets within a length, so that no length is ranked in one task.
BUCKETS = 1024
#: Words that the proportional and greedy passes leave for the dynamic program.
DP_WORDS = 1 << 15


def targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """Targets of the sources in ``sizes`` (no_source, source, source_size), one row a source.

    ``share`` of all sizes is dealt by the cyclic weights in code point order; what would exceed ``most``
    times a source's size is dealt again by weight, which ends at one common level a unit of weight.
    """
    order = Window.orderBy("no_source", "source")
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    whole = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    weighted = sizes.withColumn(
        "weight", F.element_at(cycle, (F.row_number().over(order) - 1) % len(weights) + 1)
    ).withColumn("most", F.col("source_size") * F.lit(most))
    full_first = Window.orderBy(F.col("most") / F.col("weight"), "no_source", "source")
    left = (
        F.sum(F.col("source_size")).over(whole) * F.lit(share)
        - F.coalesce(F.sum("most").over(full_first.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    )
    level = left / F.sum("weight").over(full_first.rowsBetween(0, Window.unboundedFollowing))
    return (
        weighted.withColumn("level", level)
        .withColumn("level", F.max("level").over(whole))
        .withColumn("target", F.least("most", F.col("level") * F.col("weight")))
        .select("no_source", "source", "source_size", "target")
    )


def _reach(lengths: list[int], counts: list[int], most: int, goal: int) -> tuple[int, list[tuple[int, int, int]]]:
    """Bitset of the sums up to ``most``, counts split in powers of two, and what each step added; ends early at ``goal``."""
    reach, mask, steps = 1, (1 << (most + 1)) - 1, []
    for i, (length, count) in enumerate(zip(lengths, counts, strict=True)):
        left, chunk = min(count, most // length), 1
        while left > 0:
            n = min(chunk, left)
            new = (reach << (length * n)) & mask & ~reach
            if new:
                reach |= new
                steps.append((i, n, new))
            left, chunk = left - n, chunk * 2
        if reach >> goal & 1:
            break
    return reach, steps


def knapsack(lengths: list[int], counts: list[int], budget: int) -> list[int]:
    """How many of each length come nearest to ``budget`` words, from below if two are as near."""
    take = [0] * len(lengths)
    if budget <= 0:
        return take
    reach, steps = _reach(lengths, counts, budget, budget)
    total = reach.bit_length() - 1
    if total < budget:
        # Sums beyond the budget that would be nearer than the best one below it.
        further, more = _reach(lengths, counts, 2 * budget - total - 1, budget)
        if above := further >> (budget + 1):
            total, steps = budget + (above & -above).bit_length(), more
    for i, n, new in reversed(steps):
        if new >> total & 1:
            take[i] += n
            total -= lengths[i] * n
    return take


def fit(lengths: list[int], counts: list[int], target: float) -> tuple[int, list[int]]:
    """Whole copies of a source, and how many documents of each length get one more, for ``target`` words."""
    whole = sum(a * b for a, b in zip(lengths, counts, strict=True))
    if not whole:
        return 0, [0] * len(lengths)
    copies = int(target // whole)
    budget = int(target) - copies * whole
    take = [c * budget // whole for c in counts]
    left = budget - sum(a * b for a, b in zip(lengths, take, strict=True))
    order = sorted(range(len(lengths)), key=lambda i: -lengths[i])
    for i in order:
        n = min(counts[i] - take[i], max(0, left - DP_WORDS) // lengths[i])
        take[i] += n
        left -= n * lengths[i]
    more = knapsack([lengths[i] for i in order], [counts[i] - take[i] for i in order], left)
    for i, n in zip(order, more, strict=True):
        take[i] += n
    return copies, take


def _fit_source(cells: pd.DataFrame) -> pd.DataFrame:
    cells = cells.sort_values("size")
    copies, take = fit([int(x) for x in cells["size"]], [int(x) for x in cells["n"]], float(cells["target"].iloc[0]))
    return cells[["no_source", "source", "size"]].assign(copies=copies, more=take)


def mix(docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = 1.5, most: float = 2.0, seed: int = 7) -> DataFrame:
    """doc_id, source, size, source_size, target and taken (words, repeats counted) of every row of ``docs``."""
    order = F.xxhash64(F.lit(seed), F.col("doc_id"))
    sized = materialize(
        docs.select(
            "doc_id",
            F.col("source").isNull().alias("no_source"),
            F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"),
            F.coalesce(F.size(F.regexp_extract_all("text", F.lit(WORD), 0)), F.lit(0)).cast("long").alias("size"),
            order.alias("seeded"),
        ).withColumn("size", F.greatest("size", F.lit(0)))
    ).withColumn("bucket", F.pmod(F.shiftright("seeded", 40), F.lit(BUCKETS)))
    group = ["no_source", "source", "size"]
    cells = sized.groupBy(*group, "bucket").agg(F.count("*").alias("n"))
    lengths = materialize(sized.groupBy(*group).agg(F.count("*").alias("n")))
    goal = small(targets(
        lengths.groupBy("no_source", "source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size")), weights, share, most
    ))
    fitted = (
        lengths.where("size > 0")
        .join(goal, ["no_source", "source"])
        .groupBy("no_source", "source")
        .applyInPandas(_fit_source, "no_source boolean, source string, size long, copies long, more long")
    )
    before = Window.partitionBy(*group).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = cells.select(*group, "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")).join(fitted, group)
    position = F.row_number().over(Window.partitionBy(*group, "bucket").orderBy("seeded", "doc_id"))
    extra = (F.col("before") + F.col("position") <= F.col("more")).cast("long")
    return (
        sized.withColumn("position", position)
        .join(offsets, [*group, "bucket"], "left")
        .join(goal, ["no_source", "source"], "left")
        .select(
            "doc_id",
            F.when(~F.col("no_source"), F.col("source")).alias("source"),
            "size",
            "source_size",
            "target",
            F.coalesce(F.col("size") * (F.col("copies") + extra), F.lit(0)).cast("long").alias("taken"),
        )
    )


def mix_stage(docs: DataFrame, **how) -> DataFrame:
    """Rows of ``docs`` as often as the mix takes them: none, one or two times, all columns kept.

    Rows are matched by doc_id, source and size; among rows alike in these, those taken once more come first by the
    hash of the text, then of the other columns.
    """
    key = ["id", "from", "size"]
    text = F.col("whole.text")
    keyed = pack(docs).select(
        F.coalesce(F.col("whole.doc_id").cast("string"), F.lit("-")).alias("id"),
        F.coalesce(F.concat(F.lit("+"), F.col("whole.source").cast("string")), F.lit("-")).alias("from"),
        F.greatest(F.coalesce(F.size(F.regexp_extract_all(text, F.lit(WORD), 0)), F.lit(0)), F.lit(0)).cast("long").alias("size"),
        F.xxhash64(text).alias("hash"), "whole",
    )
    taken = (
        mix(docs, **how)
        .select(
            F.coalesce(F.col("doc_id").cast("string"), F.lit("-")).alias("id"),
            F.coalesce(F.concat(F.lit("+"), F.col("source")), F.lit("-")).alias("from"),
            "size",
            F.coalesce(F.try_divide("taken", "size"), F.lit(0)).cast("int").alias("n"),
        )
        .groupBy(*key)
        .agg(F.sum("n").alias("sum"), F.count("*").alias("rows"))
    )
    turn = F.row_number().over(Window.partitionBy(*key).orderBy("hash", "tie"))
    return (
        keyed.withColumn("tie", tie_break(docs))
        .withColumn("turn", turn)
        .join(taken, key)
        .withColumn("n", F.floor(F.col("sum") / F.col("rows")) + (F.col("turn") <= F.col("sum") % F.col("rows")).cast("int"))
        .where("n > 0")
        .select("whole", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))).alias("copy"))
        .select("whole.*")
    )
