"""Paper records: JSON lines, or rows that are there already."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.functions.text import paper_text

PAPER = "doi string, title string, abstract string, year int"


def paper_docs(records: DataFrame) -> DataFrame:
    """Documents of (doi, title, abstract, year); a record without doi is dropped."""
    title = F.coalesce("title", F.lit(""))
    return records.where(F.col("doi").isNotNull() & (F.col("doi") != "")).select(
        F.col("doi").cast("string").alias("uri"), title.alias("title"), F.lit("text/plain").alias("mime"), paper_text(F.col("title"), F.col("abstract")).alias("text"),
        F.lit(None).cast("binary").alias("raw_bytes"),
        F.create_map(F.lit("doi"), F.col("doi").cast("string"), F.lit("year"), F.col("year").cast("string"), F.lit("source_type"), F.lit("literature")).alias("meta"),
    )


def papers(spark: SparkSession, path: str | None = None, records: DataFrame | None = None) -> DataFrame:
    if records is None and path is None:
        raise ValueError("give a path or records")
    return paper_docs(records if records is not None else spark.read.schema(PAPER).json(path))
