"""Item purchase statistics."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def player_rows(matches: DataFrame) -> DataFrame:
    """One row per player of each match."""
    return matches.select(F.explode("players").alias("player")).select("player.*")


def item_purchases(matches: DataFrame) -> DataFrame:
    """One row (key, time) per purchase; players without a log give none."""
    return (
        player_rows(matches)
        .select(F.explode("purchase_log").alias("purchase"))
        .select("purchase.key", "purchase.time")
    )


def item_totals(purchases: DataFrame) -> DataFrame:
    return purchases.groupBy("key").agg(F.count("*").alias("totals"))


def item_first_purchase(purchases: DataFrame) -> DataFrame:
    """Earliest time per item; null times are ignored."""
    return purchases.groupBy("key").agg(F.min("time").alias("timings"))


def item_stats(purchases: DataFrame, ordered: bool = True) -> DataFrame:
    """key, totals, timings in one aggregation, the most bought first; unnamed items are left out."""
    stats = (
        purchases.filter(F.col("key").isNotNull())
        .groupBy("key")
        .agg(F.count("*").alias("totals"), F.min("time").alias("timings"))
    )
    return stats.orderBy(F.desc("totals"), "key") if ordered else stats
