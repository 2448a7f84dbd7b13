"""Column expressions. All are built-in functions, so they stay inside codegen."""

from .draft import is_winner, team_name, win_rate
from .numeric import geometric_bucket
from .times import micros_between, parse_iso, seconds

__all__ = [
    "geometric_bucket",
    "is_winner",
    "micros_between",
    "parse_iso",
    "seconds",
    "team_name",
    "win_rate",
]
