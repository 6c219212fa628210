"""Settings of a collection: frozen dataclasses, read from YAML and overridden by environment variables."""

from __future__ import annotations

import os
from dataclasses import dataclass, field, fields, replace
from typing import Any


@dataclass(frozen=True)
class ModelSettings:
    """Where models answer; without a url the deterministic offline models are used."""

    url: str | None = None
    embed_model: str = "hash-256"
    gate_model: str = "offline"


@dataclass(frozen=True)
class StoreSettings:
    path: str = ".siltstone/collections"
    distance: str = "Cosine"


@dataclass(frozen=True)
class ExtractSettings:
    url: str | None = None
    allowed_root: str = "."


@dataclass(frozen=True)
class RerankSettings:
    url: str | None = None


@dataclass(frozen=True)
class StateSettings:
    path: str = ".siltstone/state"


@dataclass(frozen=True)
class ChunkSettings:
    max_tokens: int = 512
    overlap_tokens: int = 64


@dataclass(frozen=True)
class EvalSettings:
    golden_path: str = ".siltstone/eval/{collection}.golden.jsonl"
    gen_model: str | None = None
    per_doc_n: int = 3
    k_values: tuple[int, ...] = (1, 3, 5, 10)


@dataclass(frozen=True)
class ContextualSettings:
    enabled: bool = False
    model: str | None = None
    max_chunks_per_call: int = 10


@dataclass(frozen=True)
class MultiQuerySettings:
    model: str | None = None
    n: int = 3


@dataclass(frozen=True)
class CorrectiveSettings:
    model: str | None = None
    drop_threshold: float = 0.25
    fallback_floor: float = 0.5


@dataclass(frozen=True)
class Config:
    collection: str = "documents"
    model: ModelSettings = field(default_factory=ModelSettings)
    store: StoreSettings = field(default_factory=StoreSettings)
    extract: ExtractSettings = field(default_factory=ExtractSettings)
    rerank: RerankSettings = field(default_factory=RerankSettings)
    state: StateSettings = field(default_factory=StateSettings)
    chunk: ChunkSettings = field(default_factory=ChunkSettings)
    eval: EvalSettings = field(default_factory=EvalSettings)
    contextual: ContextualSettings = field(default_factory=ContextualSettings)
    multi_query: MultiQuerySettings = field(default_factory=MultiQuerySettings)
    corrective: CorrectiveSettings = field(default_factory=CorrectiveSettings)
    gate_enabled: bool = False
    gate_criteria: str = "keep documents that inform; reject empty, broken and advertising ones."

    @classmethod
    def load(cls, path: str = "siltstone.yaml") -> Config:
        """Defaults, then the YAML file if there is one, then the environment. Unknown keys raise TypeError."""
        data: dict[str, Any] = {}
        if os.path.exists(path):
            import yaml

            with open(path, encoding="utf-8") as f:
                data = yaml.safe_load(f) or {}
        base, values = cls(), {}
        names = {f.name for f in fields(cls)}
        for key, value in data.items():
            if key not in names:
                raise TypeError(f"unknown setting {key!r}")
            now = getattr(base, key)
            if hasattr(now, "__dataclass_fields__"):
                section = dict(value or {})
                if "k_values" in section:
                    section["k_values"] = tuple(section["k_values"])
                value = type(now)(**section)
            values[key] = value
        return replace(base, **values)._with_environment(os.environ)

    def _with_environment(self, env) -> Config:
        out = self
        for name, section, key in ENVIRONMENT:
            if env.get(name):
                if section is None:
                    out = replace(out, **{key: env[name]})
                else:
                    out = replace(out, **{section: replace(getattr(out, section), **{key: env[name]})})
        return out


#: Variable, section (None: top level) and key that it overrides.
ENVIRONMENT = (
    ("SILTSTONE_MODEL_URL", "model", "url"),
    ("SILTSTONE_EMBED_MODEL", "model", "embed_model"),
    ("SILTSTONE_STORE_PATH", "store", "path"),
    ("SILTSTONE_EXTRACT_URL", "extract", "url"),
    ("SILTSTONE_RERANK_URL", "rerank", "url"),
    ("SILTSTONE_COLLECTION", None, "collection"),
)
