"""Tools for an assistant: search, collections, ingest of a confined path, status; served as JSON lines on stdio.

Every answer is an object: {"ok": true, ...} or {"ok": false, "error": ..., "hint": ...}; no call raises.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Callable
from dataclasses import replace
from typing import IO

from pyspark.sql import SparkSession

from siltstone import sources
from siltstone.config import Config
from siltstone.operators import state
from siltstone.operators.extract import ALLOWED, below, confined
from siltstone.operators.store import DimensionMismatch, collections
from siltstone.plans.ingest import ingest
from siltstone.plans.search import wrapped

#: What to do about an error, by its type.
HINTS = {
    PermissionError: "give a path below the allowed root, without '..'", FileNotFoundError: "the path does not exist", ValueError: f"allowed extensions: {', '.join(ALLOWED)}",
    DimensionMismatch: "use another collection or the embedder that filled this one", SystemExit: "ingest documents first", KeyError: "see the list of sources",
}


def readable(path: str, root: str) -> str:
    """A folder below ``root``, or a file that ``confined`` gives."""
    found = below(path, root)
    return str(found) if found.is_dir() else confined(path, root)


class Service:
    def __init__(self, spark: SparkSession, config: Config):
        self.spark, self.config = spark, config
        self.tools: dict[str, Callable[..., dict]] = {"search": self.search, "list_collections": self.list_collections, "ingest_path": self.ingest_path, "ingest_status": self.ingest_status}

    def _config(self, collection: str | None) -> Config:
        return replace(self.config, collection=collection) if collection else self.config

    def search(self, query: str, top_k: int = 5, rerank: bool = False, hybrid: bool = False, collection: str | None = None) -> dict:
        from siltstone.cli import searcher

        asked = self.spark.createDataFrame([(1, query)], "query_id long, query string")
        found = searcher(self.spark, self._config(collection)).search(asked, top_k, use_rerank=rerank, use_hybrid=hybrid)
        row = wrapped(found).first()
        return {"text": row["reply"] if row else ""}

    def list_collections(self) -> dict:
        return {"collections": collections(self.spark, self.config.store.path)}

    def ingest_path(self, path: str, source: str = "files", collection: str | None = None) -> dict:
        from siltstone.cli import ingest_models

        real = readable(path, self.config.extract.allowed_root)
        _, kind, fields = sources.SOURCES[source]
        config = self._config(collection)
        result = ingest(sources.read(self.spark, source, real), config, kind, ingest_models(config), fields)
        return {"summary": result.summary(), "error_uris": result.error_uris}

    def ingest_status(self, collection: str | None = None, limit: int = 20) -> dict:
        name = self._config(collection).collection
        current = state.latest(state.StateStore(self.spark, f"{self.config.state.path.rstrip('/')}/log").log())
        return {
            "counts": {r["state"]: r["n"] for r in state.counts(current, name).collect()},
            "recent_errors": [{"uri": r["uri"], "error": r["error"]} for r in state.recent_errors(current, name, limit).collect()],
        }

    def call(self, tool: str, arguments: dict | None = None) -> dict:
        try:
            if tool not in self.tools:
                raise KeyError(f"unknown tool {tool!r}; there are {', '.join(self.tools)}")
            return {"ok": True, **self.tools[tool](**(arguments or {}))}
        except (Exception, SystemExit) as e:
            return {"ok": False, "error": f"{type(e).__name__}: {e}", "hint": HINTS.get(type(e), "")}

    def serve(self, lines: IO[str] = sys.stdin, out: IO[str] = sys.stdout) -> None:
        """Answer {"id", "tool", "arguments"} lines until the input ends."""
        for line in lines:
            if line.strip():
                try:
                    asked = json.loads(line)
                    answer = {"id": asked.get("id"), **self.call(asked.get("tool", ""), asked.get("arguments"))}
                except (ValueError, AttributeError) as e:
                    answer = {"id": None, "ok": False, "error": str(e), "hint": "send one JSON object a line"}
                print(json.dumps(answer, ensure_ascii=False), file=out, flush=True)
