"""draftstats: match-draft, item and job statistics as plain Spark jobs."""

from .operators import distribution, draft, ingest, items, landed, stages

__all__ = ["distribution", "draft", "ingest", "items", "landed", "stages"]
