"""DataFrame -> DataFrame operators: lazy, no actions, no Python UDFs."""

from . import distribution, draft, ingest, items, landed, stages

__all__ = ["distribution", "draft", "ingest", "items", "landed", "stages"]
