"""Streaming: ingest of new files as they come."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from siltstone.config import Config
from siltstone.plans.ingest import Models, ingest
from siltstone.sources.papers import PAPER, paper_docs


def stream_ingest(docs: DataFrame, config: Config, checkpoint: str, source_type: str = "document", parts: Models | None = None, once: bool = True) -> StreamingQuery:
    """Ingest a stream of documents batch by batch; replacement by source makes a repeated batch harmless."""

    def each(batch: DataFrame, _: int) -> None:
        if not batch.isEmpty():
            ingest(batch, config, source_type, parts)

    writer = docs.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def stream_papers(spark: SparkSession, folder: str, config: Config, checkpoint: str, parts: Models | None = None) -> StreamingQuery:
    """Ingest JSON-lines paper files that appear in ``folder``."""
    return stream_ingest(paper_docs(spark.readStream.schema(PAPER).json(folder)), config, checkpoint, "literature", parts)


def latest_states(events: DataFrame) -> DataFrame:
    """Streaming view of the last state of each (collection, uri) of a transition stream (seq, collection, uri, state)."""
    return events.groupBy("collection", "uri").agg(F.max_by("state", "seq").alias("state"), F.max("seq").alias("seq"))
