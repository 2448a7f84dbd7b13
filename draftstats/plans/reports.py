"""The reports. Each makes a single pass over its input, and takes the place of the one before only as a whole."""

from collections.abc import Sequence

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import draft, items, stages
from ..schemas import CORRUPT
from ..sinks import published, write_by_team, write_stats
from ..sources.matches import read_landed
from .counting import Counted


@dataclass(frozen=True)
class Read:
    """What a report read: lines, and those of them of which it could not read all it needs."""

    lines: int
    rejected: int


def draft_report(matches: DataFrame, output: str, mode: str = draft.FULL, fmt: str = "parquet") -> Read:
    """hero_stats, team_names, team_picks and team_bans (strict) or team_stats (full) below `output`.

    The matches are read once, into draft_counts per (hero, team). That table is
    itself an output; everything else is computed from it.
    """
    counted = _counted(matches, "picks_bans")
    draft_report_of_counts(draft.hero_team_counts(draft.draft_events(counted.rows)), output, mode, fmt)
    return Read(**counted.get())


def _counted(matches: DataFrame, read: str) -> Counted:
    """Straight from JSON, lines that are damaged in what the report reads are rejected."""
    corrupt = F.col(CORRUPT).isNotNull() if CORRUPT in matches.columns else F.lit(False)
    # Spark must be asked for another column as well; this is true of any.
    rejected = F.count_if(corrupt & (F.coalesce(F.size(read), F.lit(0)) >= -1))
    return Counted(matches, lines=F.count("*"), rejected=rejected)


def draft_report_of_counts(team_counts: DataFrame, output: str, mode: str = draft.FULL, fmt: str = "parquet") -> None:
    """The draft report from `hero_team_counts`, however they were made; see `counts_of_landings`."""
    spark = team_counts.sparkSession
    with published(spark, output) as folder:
        counts_path = f"{folder}/draft_counts"
        team_counts.write.mode("overwrite").parquet(counts_path)
        counts = spark.read.parquet(counts_path)

        heroes = draft.roll_up_heroes(counts)
        write_stats(draft.hero_stats(heroes, mode), f"{folder}/hero_stats", fmt)
        write_stats(draft.team_names(counts), f"{folder}/team_names", fmt)
        if mode == draft.FULL:
            write_by_team(draft.team_stats(counts), f"{folder}/team_stats", [F.desc("picks"), "hero_id"], fmt)
        else:
            picks = draft.team_picks(counts, mode, ordered=False)
            bans = draft.team_bans(counts, mode, ordered=False)
            write_by_team(picks, f"{folder}/team_picks", [F.desc("picks"), "hero_id"], fmt)
            write_by_team(bans, f"{folder}/team_bans", [F.desc("bans"), "hero_id"], fmt)


def counts_of_landings(spark: SparkSession, table: str, counts: str) -> DataFrame:
    """`hero_team_counts` of a whole match table, of which only landings that were not counted yet are read.

    Counts are kept per landing in `counts`. A landing's counts replace those of
    the same landing, so a repeated run changes nothing.
    """
    known = read_landed(spark, counts)
    last = -1 if known is None else known.agg(F.max("batch")).first()[0]
    new = spark.read.parquet(table).filter(F.col("batch") > (-1 if last is None else last))
    by_landing = draft.hero_team_counts(draft.draft_events(new, ("batch",)), ("batch",))
    writer = by_landing.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch")
    writer.parquet(counts)
    known = read_landed(spark, counts)
    return draft.merged_counts(by_landing if known is None else known)


def item_report(matches: DataFrame, output: str, fmt: str = "parquet") -> Read:
    """item_stats below `output`."""
    counted = _counted(matches, "players")
    with published(matches.sparkSession, output) as folder:
        write_stats(items.item_stats(items.item_purchases(counted.rows)), f"{folder}/item_stats", fmt)
    return Read(**counted.get())


def job_report(stage_rows: DataFrame, output: str, by: Sequence[str] = ("app_id",), fmt: str = "parquet") -> None:
    """summary, durations, completion_cdf and failed_stages below `output`."""
    with published(stage_rows.sparkSession, output) as folder:
        table = f"{folder}/stages"
        stage_rows.write.mode("overwrite").parquet(table)
        rows = stage_rows.sparkSession.read.parquet(table)
        write_stats(stages.stage_summary(rows, by), f"{folder}/summary", fmt)
        write_stats(stages.stage_durations(rows), f"{folder}/durations", fmt)
        write_stats(stages.completion_cdf(rows, by, splits=3), f"{folder}/completion_cdf", fmt)
        write_stats(stages.failed_stages(rows), f"{folder}/failed_stages", fmt)
