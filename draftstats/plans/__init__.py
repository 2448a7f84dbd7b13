"""Whole jobs: which intermediate result is written once and what is read from it."""

from .landing import Landing, Listed, compact, compact_index, land_listing, land_matches, pending
from .reports import Read, counts_of_landings, draft_report, draft_report_of_counts, item_report, job_report

__all__ = [
    "Landing",
    "Listed",
    "Read",
    "compact",
    "compact_index",
    "counts_of_landings",
    "draft_report",
    "draft_report_of_counts",
    "item_report",
    "job_report",
    "land_listing",
    "land_matches",
    "pending",
]
