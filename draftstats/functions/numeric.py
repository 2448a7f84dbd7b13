"""Numeric helpers."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Above log2 of the largest double and, negated, below log2 of the smallest.
_MAX_EXPONENT = 1100


def geometric_bucket(value: Column, per_octave: int = 1024) -> Column:
    """Order-preserving bucket number of a finite or infinite number, NaN last.

    a <= b implies bucket(a) <= bucket(b), so sorting by bucket and then inside
    each bucket is sorting by value. The number is a pure function of the value:
    it needs no sample of the data, and a recomputed task finds the same bucket.
    There are at most 4 * 1100 * `per_octave` buckets whatever the data.
    """
    magnitude = F.abs(value.cast("double"))
    rank = (
        F.when(magnitude == 0, F.lit(0))
        .when(
            magnitude < float("inf"),
            F.floor((F.log2(magnitude) + _MAX_EXPONENT) * per_octave),
        )
        .otherwise(F.lit(2 * _MAX_EXPONENT * per_octave))
    )
    return F.when(value < 0, -rank).otherwise(rank).cast("bigint")
