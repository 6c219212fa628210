"""Sources: a registry of functions from a session and a path to documents (uri, title, mime, text, raw_bytes, meta)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from siltstone.sources.files import files
from siltstone.sources.papers import papers
from siltstone.sources.rules import rules

Source = Callable[[SparkSession, str], DataFrame]

#: Name, function, source type and indexed fields.
SOURCES: dict[str, tuple[Source, str, dict[str, str]]] = {
    "files": (files, "document", {"source_uri": "keyword", "ext": "keyword"}),
    "papers": (papers, "literature", {"doi": "keyword", "year": "integer"}),
    "rules": (rules, "detection", {"mitre": "keyword", "level": "keyword", "logsource": "keyword", "status": "keyword"}),
}


def register(name: str, source: Source, source_type: str, index_fields: dict[str, str] | None = None) -> None:
    SOURCES[name] = (source, source_type, index_fields or {})


def read(spark: SparkSession, name: str, path: str) -> DataFrame:
    if name not in SOURCES:
        raise KeyError(f"unknown source {name!r}; there are {', '.join(sorted(SOURCES))}")
    docs = SOURCES[name][0](spark, path)
    missing = {"uri", "title", "mime", "text", "raw_bytes", "meta"} - set(docs.columns)
    if missing:
        raise ValueError(f"source {name!r} lacks {sorted(missing)}")
    return docs
