"""Which listed matches still have to be landed, and how documents are deduplicated."""

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import landed as index

_LISTED = ("match_id", "leagueid")


def listing_union(*listings: DataFrame) -> DataFrame:
    """All leagues' listings one after the other, duplicates kept."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), listings)


def of_league(listing: DataFrame, league_id: int, column: str = "leagueid") -> DataFrame:
    """A listing asked for one league: rows that do not name their league are of that one."""
    return listing.withColumn(column, F.coalesce(F.col(column), F.lit(league_id).cast("bigint")))


def of_leagues(listing: DataFrame, league_ids: Iterable[int], column: str = "leagueid") -> DataFrame:
    """Only the given leagues' matches. Rows without a league are of none; see `of_league`."""
    return listing.filter(F.col(column).isin(*league_ids))


def listing_dedup(listing: DataFrame) -> DataFrame:
    """One row per listed match id.

    Copies collapse in the map-side aggregate, so a match listed very often
    costs one row per task in the exchange.
    """
    return listing.select("match_id").distinct()


def new_listing_rows(listing: DataFrame, known: DataFrame | None) -> DataFrame:
    """(match_id, leagueid) pairs of a listing that an earlier listing did not have."""
    rows = listing.select(*_LISTED, F.lit(False).alias("is_known"))
    if known is not None:
        rows = rows.unionByName(known.select(*_LISTED, F.lit(True).alias("is_known")))
    return rows.groupBy(*_LISTED).agg(F.max("is_known").alias("is_known")).filter(~F.col("is_known")).select(*_LISTED)


def new_listing_objects(listing: DataFrame, known: DataFrame | None) -> DataFrame:
    """(match_id, leagueid, listing): `new_listing_rows` with the whole object; of several the first by its text.

    Objects of different text for one match and league are copies like any other.
    """
    text = F.to_json("listing").alias("text")
    rows = listing.select(*_LISTED, text, F.lit(False).alias("is_known"))
    if known is not None:
        rows = rows.unionByName(known.select(*_LISTED, F.lit(True).alias("is_known")), allowMissingColumns=True)
    first = rows.groupBy(*_LISTED).agg(F.max("is_known").alias("is_known"), F.min("text").alias("text"))
    return first.filter(~F.col("is_known")).select(*_LISTED, F.parse_json("text").alias("listing"))


def pending_matches(listing: DataFrame, landed: DataFrame | None) -> DataFrame:
    """Listed match ids without a landed document. A row without id cannot be landed.

    An anti join in the form of one aggregation: both sides reduce to distinct
    ids map-side and meet in a single exchange, so neither a match listed very
    often nor the size of the landed side matters.
    """
    listed = listing.filter(F.col("match_id").isNotNull()).select("match_id", F.lit(False).alias("is_landed"))
    if landed is None:
        return listing_dedup(listed)
    return (
        listed.unionByName(_landed_rows(landed))
        .groupBy("match_id")
        .agg(F.max("is_landed").alias("is_landed"))
        .filter(~F.col("is_landed"))
        .select("match_id")
    )


def new_documents(docs: DataFrame, landed: DataFrame | None, unique: bool = False) -> DataFrame:
    """Documents whose match has not landed yet, one per match.

    Of several copies the one from the first source file by name is taken.
    Copies collapse map-side, and a single exchange by match id serves the
    deduplication, the anti join and the compaction of one-document files.
    Where most documents may have landed, `without_landed` spares them all that.

    `unique` states that there are no copies, as in one folder of files named by
    match id. The first landing then moves no document between tasks, and later
    ones only if the landed ids are too many to broadcast.
    """
    docs = docs.filter(F.col("match_id").isNotNull())
    if unique:
        return docs if landed is None else docs.join(listing_dedup(landed), "match_id", "left_anti")
    fields = [c for c in docs.columns if c != "match_id"]
    rows = docs.select(
        "match_id", "source_file", F.struct(*fields).alias("document"), F.lit(False).alias("is_landed")
    )
    if landed is not None:
        rows = rows.unionByName(_landed_rows(landed), allowMissingColumns=True)
    return (
        rows.groupBy("match_id")
        .agg(F.min_by("document", "source_file").alias("document"), F.max("is_landed").alias("is_landed"))
        .filter(~F.col("is_landed"))
        .select("match_id", "document.*")
    )


def without_landed(docs: DataFrame, landed: DataFrame) -> DataFrame:
    """The documents whose match has not landed, left out where they are read: the index of landed ids is sent to every task.

    Where ids lie too far apart for that, all documents; `new_documents` takes the new ones of either.
    """
    ids = index.index_of(landed)
    return index.not_landed_in_place(docs, ids) if index.fits_tasks(ids) else docs


def _landed_rows(landed: DataFrame) -> DataFrame:
    return landed.select("match_id", F.lit(True).alias("is_landed"))
