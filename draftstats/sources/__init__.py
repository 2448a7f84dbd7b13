"""Scans. Each returns a lazy DataFrame with a declared schema."""

from .job_metrics import read_event_log, read_stage_records
from .leagues import LEAGUE_IDS
from .listing import listing_objects, read_listing, read_listing_objects
from .matches import DRAFT_FIELDS, HERO_ID, malformed_matches, parse_matches, read_landed, read_match_lines, read_matches

__all__ = [
    "DRAFT_FIELDS",
    "HERO_ID",
    "LEAGUE_IDS",
    "listing_objects",
    "malformed_matches",
    "parse_matches",
    "read_event_log",
    "read_landed",
    "read_listing",
    "read_listing_objects",
    "read_match_lines",
    "read_matches",
    "read_stage_records",
]
