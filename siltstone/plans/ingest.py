"""Ingest: documents to stored points, with every document's state in the log.

Each stage is one plan over all documents; the expensive ones (models) are written once before their result is
used twice. A failing document becomes a row with state error; only a collection of another vector size stops a
run, before anything is written.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from siltstone.config import Config
from siltstone.operators import models, sparse
from siltstone.operators.chunk import Budget, chunk
from siltstone.operators.extract import extract
from siltstone.operators.gate import gate
from siltstone.operators.state import StateStore, transitions
from siltstone.operators.store import Collection
from siltstone.operators.topk import scratch


@dataclass
class IngestResult:
    """Documents discovered, extracted, gated, skipped and failed; chunks made, embedded and stored."""

    discovered: int = 0
    extracted: int = 0
    gated: int = 0
    skipped: int = 0
    chunked: int = 0
    embedded: int = 0
    stored: int = 0
    errors: int = 0
    error_uris: list[str] = field(default_factory=list)

    def summary(self) -> str:
        names = ("discovered", "extracted", "gated", "skipped", "chunked", "embedded", "stored", "errors")
        return " ".join(f"{n}={getattr(self, n)}" for n in names)


@dataclass
class Models:
    """What a run calls; the defaults are deterministic and offline."""

    embedder: models.Embedder = field(default_factory=models.HashEmbedder)
    gate: Callable[[Column, Column], Column] | None = None
    context: models.ContextModel | None = None
    binary: Callable[[bytes], str] | None = None


#: Failed documents that a result names; all are in the state log.
NAMED_ERRORS = 1000


def last_of_each(docs: DataFrame) -> DataFrame:
    """One row a uri: the last by ``pos`` if there is one, by row otherwise."""
    order = F.col("pos") if "pos" in docs.columns else F.monotonically_increasing_id()
    rank = F.row_number().over(Window.partitionBy("uri").orderBy(F.desc("__pos")))
    return docs.withColumn("__pos", order).withColumn("__n", rank).where("__n = 1").drop("__pos", "__n")


def ingest(docs: DataFrame, config: Config, source_type: str = "document", parts: Models | None = None, index_fields: dict[str, str] | None = None) -> IngestResult:
    """Run ``docs`` (uri, title, mime, text, raw_bytes, meta) into the collection that ``config`` names."""
    spark, parts = docs.sparkSession, parts or Models()
    collection = Collection(spark, config.store.path, config.collection)
    log = StateStore(spark, f"{config.state.path.rstrip('/')}/log")
    seq = log.next_seq()
    note = lambda rows, stage: transitions(rows, config.collection, seq, stage)
    state = lambda name: F.lit(name).alias("state")

    extracted = scratch(spark, extract(last_of_each(docs), parts.binary).drop("raw_bytes"))
    if config.gate_enabled and parts.gate is None:
        raise ValueError("the gate is enabled, but the run has no gate model")
    judged = gate(extracted.where("state = 'extracted'").drop("state", "error"), parts.gate)
    judged = scratch(spark, judged)
    kept = judged.where("state = 'gated'")
    chunks = chunk(kept, Budget.of(config.chunk.max_tokens, config.chunk.overlap_tokens), keep=("title", "meta"))
    # Raises before any write if the collection holds another size.
    collection.ensure(parts.embedder.dim, config.store.distance, index_fields)
    context = parts.context or (models.first_sentence if config.contextual.enabled else None)
    if context is not None:
        told = models.contextualize(chunks, kept, context, config.contextual.max_chunks_per_call)
        embedded = models.embed(told, parts.embedder, models.embedding_text()).withColumn("embed_error", F.coalesce("context_error", "embed_error"))
    else:
        embedded = models.embed(chunks.withColumn("context", F.lit("")), parts.embedder)
    dim = parts.embedder.dim
    wrong = F.when(F.size("dense") != dim, F.concat(F.lit("embed: "), F.size("dense").cast("string"), F.lit(f" dimensions, not {dim}")))
    points = scratch(spark, embedded.withColumn("embed_error", F.coalesce("embed_error", wrong)))
    # One row a document: its first failure, if any chunk failed.
    fates = scratch(spark, points.groupBy(F.col("source_uri").alias("uri")).agg(
        F.count("*").cast("int").alias("n_chunks"), F.min_by("embed_error", F.when(F.col("embed_error").isNotNull(), F.col("ordinal"))).alias("error")
    ))
    good = fates.where("error is null")
    stored = points.join(good.select(F.col("uri").alias("source_uri")), "source_uri", "left_semi").select(
        "chunk_id", "source_uri", "ordinal", "text", "title", F.lit(source_type).alias("source_type"), "context", "dense", "meta"
    )
    collection.replace(stored)
    save_stats(collection)

    lines = [
        note(extracted.select("uri", state("discovered")), 1), note(extracted.select("uri", "state", "error"), 2),
        note(judged.select("uri", "state", F.when(F.col("state") != "gated", F.col("reason")).alias("error")), 3),
        note(fates.select("uri", state("chunked"), "n_chunks"), 4),
        note(good.select("uri", state("embedded"), F.lit(dim).alias("dim"), "n_chunks"), 5), note(good.select("uri", state("stored"), F.lit(dim).alias("dim"), "n_chunks"), 6),
        note(fates.where("error is not null").select("uri", state("error"), "error"), 7),
    ]
    every = lines[0]
    for line in lines[1:]:
        every = every.unionByName(line)
    log.append(every)
    return _result(extracted, judged, fates)


def _result(extracted: DataFrame, judged: DataFrame, fates: DataFrame) -> IngestResult:
    n = extracted.agg(F.count("*").alias("all"), F.count_if(F.col("state") == "extracted").alias("ok")).first()
    g = judged.agg(*[F.count_if(F.col("state") == s).alias(s) for s in ("gated", "skipped", "error")]).first()
    ok = F.col("error").isNull()
    f = fates.agg(F.coalesce(F.sum("n_chunks"), F.lit(0)).alias("chunks"), F.coalesce(F.sum(F.when(ok, F.col("n_chunks"))), F.lit(0)).alias("good"), F.count_if(~ok).alias("bad")).first()
    failed = extracted.where("state = 'error'").select("uri").unionByName(judged.where("state = 'error'").select("uri")).unionByName(fates.where("error is not null").select("uri"))
    uris = [r[0] for r in failed.orderBy("uri").limit(NAMED_ERRORS).collect()]
    return IngestResult(n["all"], n["ok"], g["gated"], g["skipped"], f["chunks"], f["good"], f["good"], n["all"] - n["ok"] + g["error"] + f["bad"], uris)


def save_stats(collection: Collection) -> None:
    """Corpus statistics of the whole collection, written anew beside its version."""
    points, n = collection.points(), collection.version()
    if points is None:
        return
    sparse.corpus_stats(points).write.mode("overwrite").parquet(f"{collection.path}/stats/v={n}")
    sparse.postings(points).write.mode("overwrite").parquet(f"{collection.path}/postings/v={n}")


def load_stats(collection: Collection) -> tuple[DataFrame, DataFrame] | None:
    """(corpus statistics, postings), or None if the collection has no points."""
    n = collection.version()
    if not n:
        return None
    read = collection.spark.read.parquet
    return read(f"{collection.path}/stats/v={n}"), read(f"{collection.path}/postings/v={n}")
