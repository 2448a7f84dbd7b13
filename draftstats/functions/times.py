"""Timestamps and intervals of stage records."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# ISO date-time with the zone as text, e.g. 2025-05-06T10:00:00.000GMT; the
# fraction may have six digits, three, or be missing.
ISO_PATTERN = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][.SSS]z"


def parse_iso(text: Column) -> Column:
    """Timestamp of an ISO string with zone text; null where it does not parse."""
    return F.try_to_timestamp(text, F.lit(ISO_PATTERN))


def micros_between(start: Column, end: Column) -> Column:
    """Signed length of the interval in whole microseconds, days included."""
    return F.unix_micros(end) - F.unix_micros(start)


def seconds(micros: Column) -> Column:
    return micros / F.lit(1e6)
