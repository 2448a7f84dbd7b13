"""Exact empirical distributions that do not sort a group in one task.

The pieces work on value counts (`value`, `n`), so equal values cost one row
however often they occur. Values are spread over `geometric_bucket`s, and a
bucket that is still crowded is split by the leading digits of its values, again
and again; sums over the buckets give each one's start, and a window runs inside
each bucket only.

For input that is too large to order at all there are mergeable sketches.
"""

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geometric_bucket

# Rows emitted by one array when a compact CDF is written out row by row.
_CHUNK = 10_000
# Distinct values from which on a bucket is split, and into how many parts, at least and at most.
_CROWD = 100_000
_PARTS = 1 << 12, 1 << 14
# Buckets that are split at a time, the most crowded first: what is sent to every task.
_SPLIT_AT_ONCE = 100_000
# Buckets whose sums are added up together; there are at most 35,000 such groups.
_COARSE = 64
# Values a sketch keeps on each level: a rank is off by less than 0.2 % of all.
SKETCH_K = 2_048


def value_counts(rows: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """(by, value, n) for the non-null values."""
    return (
        rows.filter(F.col(value).isNotNull())
        .groupBy(*by, F.col(value).alias("value"))
        .agg(F.count("*").alias("n"))
    )


def empirical_cdf_compact(counts: DataFrame, by: Sequence[str] = (), splits: int = 1) -> DataFrame:
    """(by, value, n, first, total): the sorted positions first .. first + n - 1 hold `value`. `splits` is that of `in_small_buckets`."""
    bucketed = in_small_buckets(counts, by, splits)
    return _positions(bucketed, _bucket_starts(bucketed, by), by)


def empirical_cdf(counts: DataFrame, by: Sequence[str] = (), splits: int = 1) -> DataFrame:
    """(by, value, cdf), a row per observation: the i-th smallest of n, from 0, gets i / n.

    Ties get successive values and the largest gets (n - 1) / n.
    """
    # A value that occurs very often is cut into chunks, which are then spread
    # out, so no row holds more than _CHUNK positions.
    chunks = (
        empirical_cdf_compact(counts, by, splits)
        .select(
            *by,
            "value",
            "total",
            (F.col("first") + F.col("n")).alias("end"),
            F.explode(_span(F.col("first"), F.col("first") + F.col("n") - 1, _CHUNK)).alias("from"),
        )
        .repartition("value", "from")
    )
    last = F.least(F.col("from") + _CHUNK, F.col("end")) - 1
    return chunks.select(*by, "value", "total", F.explode(_span(F.col("from"), last, 1)).alias("i")).select(
        *by, "value", (F.col("i") / F.col("total")).alias("cdf")
    )


def exact_percentile(counts: DataFrame, fraction: float, by: Sequence[str] = (), splits: int = 1) -> DataFrame:
    """(by, percentile) with linear interpolation between the two nearest ranks.

    Only the one or two buckets that hold those ranks are sorted.
    """
    bucketed = in_small_buckets(counts, by, splits)
    rank = F.lit(fraction) * (F.col("total") - 1)
    low, high = F.floor(rank), F.ceil(rank)
    end = F.col("first") + F.col("n")

    def holds(position: Column) -> Column:
        return (F.col("first") <= position) & (position < end)

    wanted = _bucket_starts(bucketed, by).filter(
        (F.col("start") <= high) & (low < F.col("start") + F.col("bucket_n"))
    )
    found = _positions(_in_buckets(bucketed, wanted, by), wanted, by)
    weight = rank - low
    return (
        found.groupBy(*by)
        .agg(
            F.max(F.when(holds(low), F.col("value"))).alias("low_value"),
            F.max(F.when(holds(high), F.col("value"))).alias("high_value"),
            F.max(weight).alias("weight"),
        )
        .select(
            *by,
            ((1 - F.col("weight")) * F.col("low_value") + F.col("weight") * F.col("high_value")).alias("percentile"),
        )
    )


def sketches(rows: DataFrame, value: str, by: Sequence[str] = (), k: int = SKETCH_K) -> DataFrame:
    """(by, sketch): a KLL sketch of a group's whole numbers, a few KB however many there are; nulls are left out.

    Sketches may be stored, per day say, and merged later by `merged_sketches`.
    """
    return rows.filter(F.col(value).isNotNull()).groupBy(*by).agg(F.kll_sketch_agg_bigint(value, k).alias("sketch"))


def merged_sketches(parts: DataFrame, by: Sequence[str] = (), k: int = SKETCH_K) -> DataFrame:
    """(by, sketch) of the union of the parts' values."""
    return parts.groupBy(*by).agg(F.kll_merge_agg_bigint("sketch", k).alias("sketch"))


def sketched_percentile(sketches: DataFrame, fraction: float, by: Sequence[str] = ()) -> DataFrame:
    """(by, n, percentile): a value whose rank is within 0.2 % of all from the one asked for."""
    return sketches.select(
        *by,
        F.kll_sketch_get_n_bigint("sketch").alias("n"),
        F.kll_sketch_get_quantile_bigint("sketch", F.lit(fraction)).alias("percentile"),
    )


def in_small_buckets(counts: DataFrame, by: Sequence[str] = (), splits: int = 1) -> DataFrame:
    """Value counts with their `bucket`, an array that orders as the values do.

    A bucket of very many distinct values is split evenly between its least and
    its largest value, into 4,096 parts or more; its values get one more
    element. A second split parts values that are crowded within a few thousandths
    of a bucket, and so on; three leave nothing crowded that doubles can tell
    apart, but where values crowd at several scales. Each split costs planning, and a pass
    over the counts; where nothing is crowded, which is known only as the query
    runs, its join falls away.
    """
    rows = counts.withColumn("bucket", F.array(geometric_bucket(F.col("value"))))
    for _ in range(splits):
        rows = _split(rows, by)
    return rows


def _split(rows: DataFrame, by: Sequence[str]) -> DataFrame:
    keys = [*by, "bucket"]
    sizes = rows.groupBy(*keys).agg(F.count("*").alias("size"), F.min("value").alias("least"), F.max("value").alias("most"))
    crowded = sizes.filter((F.col("size") > _CROWD) & (F.col("least") < F.col("most")))
    # The limit is what makes sending them safe. A bucket beyond it is left whole, which changes no result.
    wanted = F.ceil(4 * F.col("size") / _CROWD)
    parts = F.least(F.lit(_PARTS[1]), F.greatest(F.lit(_PARTS[0]), wanted)).alias("parts")
    sent = crowded.orderBy(F.desc("size"), *keys).limit(_SPLIT_AT_ONCE).select(
        *[F.col(key).alias(f"crowded_{key}") for key in keys], "least", "most", parts
    )
    same = reduce(and_, [rows[key].eqNullSafe(sent[f"crowded_{key}"]) for key in keys])
    # Subtracting, dividing and rounding down never turn the order of two values.
    share = (F.col("value") - F.col("least")).cast("double") / (F.col("most") - F.col("least")).cast("double")
    part = F.floor(share * F.col("parts")).cast("bigint")
    bucket = F.when(F.col("parts").isNotNull(), F.array_append("bucket", part)).otherwise(F.col("bucket"))
    return rows.join(F.broadcast(sent), same, "left").select(*by, "value", "n", bucket.alias("bucket"))


def _bucket_starts(bucketed: DataFrame, by: Sequence[str]) -> DataFrame:
    """(by, bucket, bucket_n, start, total): observations before each bucket, and in all.

    Buckets are added up in groups of neighbours and the groups' sums once more,
    so one task orders the bounded number of groups and never all buckets. A
    group's start enters its running sum as a row that sorts before all buckets.
    """
    coarse = F.floor(F.element_at("bucket", 1) / _COARSE).alias("coarse")
    buckets = bucketed.groupBy(*by, "bucket").agg(F.sum("n").alias("bucket_n")).select(*by, coarse, "bucket", "bucket_n")
    whole = Window.partitionBy(*by)
    before = whole.orderBy("coarse").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    groups = buckets.groupBy(*by, "coarse").agg(F.sum("bucket_n").alias("group_n"))
    starts = groups.select(
        *by,
        "coarse",
        (F.sum("group_n").over(before) - F.col("group_n")).alias("bucket_n"),
        F.sum("group_n").over(whole).alias("total"),
    )
    upto = (
        Window.partitionBy(*by, "coarse")
        .orderBy(F.asc_nulls_first("bucket"))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    rows = buckets.unionByName(starts, allowMissingColumns=True)
    return rows.select(
        *by,
        "bucket",
        "bucket_n",
        (F.sum("bucket_n").over(upto) - F.col("bucket_n")).alias("start"),
        F.max("total").over(upto).alias("total"),
    ).filter(F.col("bucket").isNotNull())


def _in_buckets(bucketed: DataFrame, buckets: DataFrame, by: Sequence[str]) -> DataFrame:
    """The rows of the given buckets; a null group is a group like any other."""
    keys = [*by, "bucket"]
    wanted = buckets.select(*[F.col(key).alias(f"wanted_{key}") for key in keys])
    same = reduce(and_, [bucketed[key].eqNullSafe(wanted[f"wanted_{key}"]) for key in keys])
    return bucketed.join(wanted, same, "left_semi")


def _positions(bucketed: DataFrame, buckets: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows with the sorted position of their first observation.

    Each bucket's start enters the running sum as a row of its own that sorts
    before all values, so values and starts meet in one exchange without a join.
    """
    starts = buckets.select(*by, "bucket", F.col("start").alias("n"), "total")
    rows = bucketed.select(*by, "bucket", "value", "n").unionByName(starts, allowMissingColumns=True)
    upto = (
        Window.partitionBy(*by, "bucket")
        .orderBy(F.asc_nulls_first("value"))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        rows.select(
            *by,
            "value",
            "n",
            (F.sum("n").over(upto) - F.col("n")).alias("first"),
            F.max("total").over(upto).alias("total"),
        )
        .filter(F.col("value").isNotNull())
    )


def _span(start: Column, stop: Column, step: int) -> Column:
    return F.sequence(start, stop, F.lit(step).cast("bigint"))
