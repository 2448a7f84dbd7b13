"""Incremental landing of newly arrived documents."""

from .landing import land_new_files

__all__ = ["land_new_files"]
