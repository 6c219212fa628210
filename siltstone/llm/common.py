"""Helpers shared by the training-data operators: shared-folder tables, global ranks, checked broadcasts."""

from __future__ import annotations

import ctypes
import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Words of every contract that splits at ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Rows up to which a side may be broadcast once they are counted.
BROADCAST_ROWS = 20_000
#: Bytes that go to Python at once in ``small_batches``, about.
BATCH_BYTES = 4_000_000


def shared_dir(spark: SparkSession) -> str:
    """Folder that driver and executors share; set here only where a local session names none (tests)."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        path = spark.sparkContext.getCheckpointDir()
    if not path:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        spark.sparkContext.setCheckpointDir("/tmp/siltstone-checkpoints")
        path = spark.sparkContext.getCheckpointDir()
    return path.rstrip("/")


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage is cut and lost executors lose nothing."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Jobs run inside send BATCH_BYTES or one row to Python at once: Spark's own 64 MB are held by each task, outside the heap and again in Python."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key, None)
    spark.conf.set(key, str(BATCH_BYTES))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def release() -> None:
    """Give what a worker has freed back to the system: workers live on beside the heap for all that follows."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def pack(docs: DataFrame) -> DataFrame:
    """All columns of ``docs`` in the one column ``whole``: helper columns beside it cannot clash with any, however named.

    ``select("whole.*")`` brings them back under their own names.
    """
    return docs.select(F.struct(*[F.col(f"`{c.replace('`', '``')}`") for c in docs.columns]).alias("whole"))


def tie_break(docs: DataFrame) -> Column:
    """Of packed rows: a hash over all columns but the text, the same in every run."""
    rest = [c for c in docs.columns if c.lower() != "text"]
    return F.xxhash64(F.to_json(F.struct(*[F.col(f"whole.`{c.replace('`', '``')}`") for c in rest])))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(text, UPPER, LOWER)


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Mark ``df`` for broadcast if it counts ``rows`` rows at most; Spark shuffles it otherwise."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def ranked(df: DataFrame, *order: Column | str, name: str = "rank") -> DataFrame:
    """Add the 0-based global position under ``order`` without bringing rows together in one task.

    Rows are range-partitioned and sorted; each partition's offset is the count of rows before it.
    The sorted rows are written once, so that counts and positions come from one partitioning.
    """
    place = materialize(
        df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__at", F.monotonically_increasing_id())
    ).withColumn("__part", F.shiftrightunsigned("__at", 33))
    counts = place.groupBy("__part").agg(F.count("*").alias("__n"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    # One row a partition: bounded by the partition count, whatever the data.
    return (
        place.join(F.broadcast(offsets), "__part")
        .withColumn(name, F.col("__before") + F.col("__at").bitwiseAND(F.lit((1 << 33) - 1)))
        .drop("__part", "__at", "__before")
    )
