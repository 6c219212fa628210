"""Sharding along a Hilbert curve over quantised metadata.

Every dimension is quantised to ``bits`` bits, the Hilbert index of the cell is the sort key, and the sorted
rows are cut into runs of equal row count. A run covers few neighbouring cells, so its files have narrow
ranges in every dimension and a filter on any of them skips most files.

Defined cases: null metadata goes to level 0; null text has no bytes and the CRC of the empty text; rows of
one cell are ordered by text CRC, so equal texts with equal metadata are neighbours, then by doc_id and a hash of the
other columns; repeated rows are separate rows; an empty table has no shards; other columns are kept by the stage, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from siltstone.llm.common import materialize, pack, ranked, small, tie_break

SHARDS = 24
BITS = 5


def hilbert_index(levels: np.ndarray, bits: int) -> np.ndarray:
    """Position on the Hilbert curve of each row of ``levels`` (rows x dimensions, below 2**bits).

    The coordinates are turned into the transposed index from the highest bit down (exchange or invert the
    lower bits of the first axis), Gray-decoded, and interleaved.
    """
    x = levels.astype(np.int64).T.copy()
    n = len(x)
    for q in (1 << b for b in range(bits - 1, 0, -1)):
        low = q - 1
        for axis in range(n):
            inside = (x[axis] & q) != 0
            swap = np.where(inside, 0, (x[0] ^ x[axis]) & low)
            x[0] ^= np.where(inside, low, swap)
            x[axis] ^= swap
    for axis in range(1, n):
        x[axis] ^= x[axis - 1]
    turn = np.zeros_like(x[0])
    for q in (1 << b for b in range(bits - 1, 0, -1)):
        turn ^= np.where(x[-1] & q, q - 1, 0)
    x ^= turn
    index = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for axis in range(n):
            index = index << 1 | x[axis] >> b & 1
    return index


def _levels_of_names(rows: DataFrame, name: str, bits: int) -> DataFrame:
    """Level of each value of a text column: its place among the values in code point order, by row count."""
    counts = rows.groupBy(name).agg(F.sum("n").alias("n"))
    order = Window.orderBy(F.col(name).asc_nulls_first())
    share = (F.sum("n").over(order) - F.col("n") / 2) / F.sum("n").over(Window.partitionBy())
    level = F.least(F.floor(share * F.lit(1 << bits)), F.lit((1 << bits) - 1)).cast("int")
    found = counts.select(F.col(name).isNull().alias("__no"), F.coalesce(name, F.lit("")).alias("__key"), level.alias(f"level_{name}"))
    return small(found)


def _log_level(value: Column, bits: int, most: float = 24.0) -> Column:
    """Level of a size: its binary logarithm, ``most`` being the top."""
    scaled = F.log2(F.greatest(value.cast("double"), F.lit(0.0)) + F.lit(1.0)) * F.lit((1 << bits) / most)
    return F.coalesce(F.least(F.floor(scaled), F.lit((1 << bits) - 1)), F.lit(0)).cast("int")


def curve(docs: DataFrame, bits: int = BITS) -> DataFrame:
    """The packed rows (``whole``) of ``docs`` with __size, __crc, __curve (Hilbert index over source, lang and text size) and __tie."""
    text = F.coalesce(F.col("whole.text").cast("string"), F.lit(""))
    rows = pack(docs).select(
        "whole", F.col("whole.source").cast("string").alias("__source"), F.col("whole.lang").cast("string").alias("__lang"),
        (F.octet_length(text) + 8).cast("long").alias("__size"), F.crc32(text.cast("binary")).alias("__crc"), tie_break(docs).alias("__tie"),
    )
    names = materialize(rows.groupBy("__source", "__lang").agg(F.count("*").alias("n")))

    @F.pandas_udf("long")
    def index(a: pd.Series, b: pd.Series, c: pd.Series) -> pd.Series:
        return pd.Series(hilbert_index(np.stack([a, b, c], axis=1), bits))

    for name in ("__source", "__lang"):
        rows = (
            rows.withColumns({"__no": F.col(name).isNull(), "__key": F.coalesce(name, F.lit(""))})
            .join(_levels_of_names(names, name, bits), ["__no", "__key"])
            .drop("__no", "__key")
        )
    level = _log_level(F.col("__size") - 8, bits)
    return rows.withColumn("__curve", index("level___source", "level___lang", level)).drop("level___source", "level___lang", "__source", "__lang")


def _placed(rows: DataFrame, shards: int) -> DataFrame:
    """``rows`` of curve() with shard and slot: runs of the sorted rows, as long as one another but for one row."""
    rows = ranked(rows, "__curve", "__crc", "whole.doc_id", "__tie", name="__rank")
    n = rows.count()
    return rows.withColumn("shard", F.expr(f"cast((__rank * {shards}L) div {max(n, 1)}L as int)")).withColumn(
        "slot", F.expr(f"__rank - (shard * {n}L + {shards - 1}L) div {shards}L")
    )


def shard(docs: DataFrame, shards: int = SHARDS, bits: int = BITS) -> DataFrame:
    """Law ``rows``: size, text CRC, shard and slot of every row; the shards' row counts differ by one at most."""
    narrow = curve(docs.select("doc_id", "text", "source", "lang"), bits)
    narrow = narrow.withColumn("whole", F.col("whole").dropFields("text"))
    return _placed(narrow, shards).select(
        "whole.doc_id", F.col("__size").alias("size"), F.col("__crc").alias("text_crc32"), F.lit("rows").alias("law"),
        "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), F.col("__curve").alias("curve"), "whole.source", "whole.lang",
    )


def shard_stage(docs: DataFrame, shards: int = SHARDS, bits: int = BITS) -> DataFrame:
    """``docs`` with the columns shard and slot; columns of these names that were there before are replaced."""
    kept = docs.select(*[F.col(f"`{c.replace('`', '``')}`") for c in docs.columns if c.lower() not in ("shard", "slot")])
    return _placed(curve(kept, bits), shards).select("whole.*", "shard", "slot")


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder a shard, rows in slot order: the files' column ranges are what readers prune by."""
    n = sharded.select("shard").distinct().count()
    sharded.repartitionByRange(max(n, 1), "shard").sortWithinPartitions("shard", "slot").write.partitionBy("shard").mode("overwrite").parquet(path)
