"""Document ingestion and retrieval on Spark: sources, operators, plans, streaming."""

from importlib import import_module

#: Public names and the modules that hold them; loaded when they are first asked for.
_WHERE = {
    "Config": "siltstone.config", "Collection": "siltstone.operators.store", "StateStore": "siltstone.operators.state", "HashEmbedder": "siltstone.operators.models",
    "ServiceEmbedder": "siltstone.operators.models", "TextModel": "siltstone.operators.client", "Searcher": "siltstone.plans.search", "SearchModels": "siltstone.plans.search", "Models": "siltstone.plans.ingest",
    "ingest": "siltstone.plans.ingest", "Service": "siltstone.service", "read": "siltstone.sources",
}
__all__ = sorted(_WHERE)


def __getattr__(name: str):
    if name in _WHERE:
        return getattr(import_module(_WHERE[name]), name)
    raise AttributeError(f"module 'siltstone' has no attribute {name!r}")
