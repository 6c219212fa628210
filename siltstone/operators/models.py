"""Model surfaces: embedders, contextualisers, expansion, question generation, term numbers.

Each takes a plain callable, runs it in Arrow batches with one set-up a task, and turns a failure into an error
value of its row, never of the job. The offline models are deterministic.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property
from typing import Protocol, runtime_checkable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from siltstone.functions.text import with_context
from siltstone.operators.client import TextModel

DOC_CHARS = 6000


@runtime_checkable
class Embedder(Protocol):
    dim: int

    def embed_batch(self, texts: list[str]) -> list[list[float]]: ...


class HashEmbedder:
    """Bag of hashed terms with signs, of unit length; a text without terms has no vector."""

    def __init__(self, dim: int = 256):
        self.dim = dim

    def embed_batch(self, texts: list[str]) -> list[list[float]]:
        import zlib

        out = []
        for text in texts:
            v = np.zeros(self.dim)
            for term in re.findall("[a-z0-9]+", (text or "").lower()):
                h = zlib.crc32(term.encode())
                v[h % self.dim] += 1.0 if h >> 31 else -1.0
            norm = float(np.sqrt((v**2).sum()))
            out.append((v / norm).astype(np.float32).tolist() if norm else [])
        return out


@dataclass
class ServiceEmbedder:
    """Vectors of a model service; their size is what the service answers."""

    model: TextModel

    def embed_batch(self, texts: list[str]) -> list[list[float]]:
        return self.model.vectors(texts)

    @cached_property
    def dim(self) -> int:
        (vector,) = self.model.vectors(["size"])
        return len(vector)


def embed(chunks: DataFrame, embedder: Embedder, text: Column | None = None, batch: int = 64) -> DataFrame:
    """Adds dense and embed_error; an empty or failing text has a null vector and says why."""
    column = "__text"

    @F.pandas_udf("struct<dense: array<float>, error: string>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            vectors, errors = [], []
            for at in range(0, len(texts), batch):
                part = texts.iloc[at : at + batch].tolist()
                try:
                    found = embedder.embed_batch(part)
                except Exception:
                    found = []
                    for one in part:  # so that one bad text does not fail its neighbours
                        try:
                            found.extend(embedder.embed_batch([one]))
                        except Exception as e:
                            found.append(e)
                vectors += [None if isinstance(v, Exception) or not len(v) else v for v in found]
                errors += [f"embed: {v}" if isinstance(v, Exception) else None if len(v) else "embed: empty vector" for v in found]
            yield pd.DataFrame({"dense": vectors, "error": errors})

    out = chunks.withColumn(column, text if text is not None else F.col("text")).withColumn("__embedded", run(column))
    return out.withColumns({"dense": F.col("__embedded.dense"), "embed_error": F.col("__embedded.error")}).drop(column, "__embedded")


ContextModel = Callable[[str, list[str]], list[str]]


def first_sentence(doc: str, chunks: list[str]) -> list[str]:
    """Offline contextualiser: the document's first sentence for every chunk."""
    line = re.split(r"(?<=[.!?])\s|\n", (doc or "").strip(), maxsplit=1)[0][:200]
    return [line for _ in chunks]


def contextualize(chunks: DataFrame, docs: DataFrame, model: ContextModel, most_chunks: int = 10) -> DataFrame:
    """Adds context and context_error: one call for at most ``most_chunks`` neighbouring chunks of a document.

    Replies that are too short are padded with empty contexts; too long ones are cut.
    """
    heads = docs.select(F.col("uri").alias("source_uri"), F.substring("text", 1, DOC_CHARS).alias("__doc"))
    most = max(1, most_chunks)
    shape = StructType([*chunks.schema.fields, StructField("context", StringType()), StructField("context_error", StringType())])

    def run(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("ordinal")
        doc, texts = part["__doc"].iloc[0], part["text"].tolist()
        try:
            found = model(doc, texts)
            found = [str(x) for x in found][: len(texts)] if isinstance(found, list) else []
            part["context"], part["context_error"] = found + [""] * (len(texts) - len(found)), None
        except Exception as e:
            part["context"], part["context_error"] = "", f"context: {e}"
        return part.drop(columns=["__doc", "__call"])[shape.names]

    joined = chunks.join(heads, "source_uri", "left").withColumn("__call", F.floor(F.col("ordinal") / most))
    return joined.groupBy("source_uri", "__call").applyInPandas(run, shape)


def embedding_text() -> Column:
    return with_context(F.col("context"), F.col("text"))


ExpandModel = Callable[[str, int], list[str]]


def rotated(query: str, n: int) -> list[str]:
    """Offline expansion: the query's words turned round by 1, 2, ... places."""
    words = query.split()
    return [" ".join(words[i:] + words[:i]) for i in range(1, min(n, len(words) - 1) + 1)]


def expand(queries: DataFrame, model: ExpandModel, n: int) -> DataFrame:
    """(query_id, variant, query): the query itself as variant 0 and at most ``n`` others, none twice whatever the case; failures give none."""
    if n <= 0:
        return queries.select("query_id", F.lit(0).alias("variant"), "query")

    @F.pandas_udf("array<string>")
    def run(texts: pd.Series) -> pd.Series:
        def one(q: str) -> list[str]:
            seen, out = {q.strip().lower()}, []
            try:
                found = [str(x).strip() for x in model(q, n)]
            except Exception:
                found = []
            for x in found:
                if x and x.lower() not in seen and len(out) < n:
                    seen.add(x.lower())
                    out.append(x)
            return [q, *out]

        return texts.map(one)

    return queries.select("query_id", F.posexplode(run("query")).alias("variant", "query"))


QuestionModel = Callable[[str, int], list[str]]


def leading_questions(text: str, n: int) -> list[str]:
    """Offline question generator: the first words of the first ``n`` sentences."""
    sentences = [s for s in re.split(r"(?<=[.!?])\s+|\n+", text or "") if len(s.split()) >= 4]
    return ["What about " + " ".join(s.split()[:12]).rstrip(".,;:!?") + "?" for s in sentences[:n]]


def questions(docs: DataFrame, model: QuestionModel, n: int) -> DataFrame:
    """(uri, pos, query, failed) of at most ``n`` questions a document; a failing document has one row, failed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for uri, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                try:
                    found = model(text or "", n)
                    rows += [(uri, i, str(q), False) for i, q in enumerate((found if isinstance(found, list) else [])[:n])]
                except Exception:
                    rows.append((uri, -1, None, True))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.string(), pa.int32(), pa.string(), pa.bool_()))], ["uri", "pos", "query", "failed"]
            )

    return docs.select(F.col("uri").cast("string"), "text").mapInArrow(run, "uri string, pos int, query string, failed boolean")


def term_index(term: Column) -> Column:
    """Unsigned 32-bit BLAKE2b number of a term, for serialised vectors; joins use the term itself."""

    @F.pandas_udf("long")
    def run(terms: pd.Series) -> pd.Series:
        from hashlib import blake2b

        return terms.map(lambda t: int.from_bytes(blake2b(t.encode(), digest_size=4).digest(), "big"))

    return run(term)
