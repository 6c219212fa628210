"""Document states: an append-only log of transitions, of which the last one counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.schema import STATE, STATES


def transitions(rows: DataFrame, collection: str, seq: int, stage: int) -> DataFrame:
    """Log rows of ``rows`` (uri, state and, if there, dim, n_chunks, error); what a row lacks is null, as the last row counts whole."""
    optional = {"dim": "int", "n_chunks": "int", "error": "string"}
    columns = [(F.col(c) if c in rows.columns else F.lit(None)).cast(t).alias(c) for c, t in optional.items()]
    known = F.col("state").isin(*STATES)
    state = F.when(known, F.col("state")).otherwise(F.raise_error(F.concat(F.lit("unknown state "), F.col("state"))).cast("string"))
    return rows.select(F.lit(seq * 100 + stage).cast("long").alias("seq"), F.lit(collection).alias("collection"), "uri", state.alias("state"), *columns, F.current_timestamp().alias("updated_at"))


def latest(log: DataFrame) -> DataFrame:
    """The row with the highest seq of each (collection, uri); aggregated before it is shuffled."""
    rest = [c for c in log.columns if c not in ("collection", "uri")]
    kept = log.groupBy("collection", "uri").agg(F.max_by(F.struct(*rest), "seq").alias("last"))
    return kept.select("collection", "uri", *[f"last.{c}" for c in rest])


def counts(current: DataFrame, collection: str | None = None) -> DataFrame:
    """state and n, by state."""
    rows = current.where(F.col("collection") == collection) if collection is not None else current
    return rows.groupBy("state").agg(F.count("*").alias("n")).orderBy("state")


def recent_errors(current: DataFrame, collection: str | None = None, limit: int = 50) -> DataFrame:
    rows = current.where(F.col("state") == "error")
    rows = rows.where(F.col("collection") == collection) if collection is not None else rows
    return rows.orderBy(F.desc("updated_at"), F.desc("seq"), "uri").limit(limit).select("uri", "error", "updated_at")


class StateStore:
    """The log as Parquet files below ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def append(self, log: DataFrame) -> None:
        log.write.mode("append").parquet(self.path)

    def log(self) -> DataFrame:
        from siltstone.operators.store import exists

        if not exists(self.spark, self.path):
            return self.spark.createDataFrame([], STATE)
        return self.spark.read.schema(STATE).parquet(self.path)

    def next_seq(self) -> int:
        return (self.log().agg(F.coalesce(F.max("seq"), F.lit(0))).first()[0]) // 100 + 1
