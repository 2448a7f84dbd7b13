"""Pick / ban / win statistics.

Two result conventions exist for every statistic and are never mixed:

full    every hero and team, null ones included; absent counts are 0 and the
        win rate without picks is 0. The default.
strict  what inner-joining separately counted picks and wins gives: picks and
        win rate are null (per team: the row is missing) for heroes that never
        won; null heroes and null teams match nothing; absent bans are null.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import is_winner, team_name, win_rate

FULL, STRICT = "full", "strict"

_HEADER = ("radiant_name", "dire_name", "radiant_win")
_MEASURES = ("totals", "bans", "picks", "wins")


def picks_bans_flat(matches: DataFrame) -> DataFrame:
    """One row per pick or ban; documents without events give none."""
    events = matches.select(F.explode("picks_bans").alias("event"), *_HEADER)
    return events.select("event.*", *_side_of("event.team"))


def draft_events(matches: DataFrame, kept: Sequence[str] = ()) -> DataFrame:
    """`picks_bans_flat` without order and team number: what the statistics count. `kept` columns of the match stay.

    An exploded struct is scanned with all its fields. Zipping the arrays of the
    three counted fields keeps the fourth out of the scan.
    """
    counted = F.arrays_zip("picks_bans.hero_id", "picks_bans.is_pick", "picks_bans.team")
    events = matches.select(F.explode(counted).alias("event"), *_HEADER, *kept)
    return events.select("event.hero_id", "event.is_pick", *_side_of("event.team"), *kept)


def _side_of(team: str) -> list[Column]:
    return [
        team_name(F.col(team), F.col("radiant_name"), F.col("dire_name")).alias("teamname"),
        is_winner(F.col(team), F.col("radiant_win")).alias("winner"),
    ]


# Single counts per hero ------------------------------------------------------


def hero_totals(flat: DataFrame) -> DataFrame:
    return _count(flat, "totals")


def hero_picks(flat: DataFrame) -> DataFrame:
    return _count(flat.filter("is_pick"), "picks")


def hero_bans(flat: DataFrame) -> DataFrame:
    return _count(flat.filter("NOT is_pick"), "bans")


def hero_wins(flat: DataFrame) -> DataFrame:
    return _count(flat.filter("is_pick AND winner"), "wins")


def _count(rows: DataFrame, name: str) -> DataFrame:
    return rows.groupBy("hero_id").agg(F.count("*").alias(name))


# All counts in one pass ------------------------------------------------------


def hero_counts(flat: DataFrame) -> DataFrame:
    """All four counts per hero: one scan, one exchange of partial counts."""
    return flat.groupBy("hero_id").agg(*_event_counts())


def hero_team_counts(flat: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """All four counts per (hero, team), and `by` further columns. Everything else below derives from this."""
    return flat.groupBy("hero_id", "teamname", *by).agg(*_event_counts())


def merged_counts(parts: DataFrame) -> DataFrame:
    """`hero_team_counts` of all matches from those of disjoint parts."""
    return parts.groupBy("hero_id", "teamname").agg(*_summed_counts())


def roll_up_heroes(team_counts: DataFrame) -> DataFrame:
    """`hero_counts` from `hero_team_counts`, without going back to the events."""
    return team_counts.groupBy("hero_id").agg(*_summed_counts())


def draft_counts(flat: DataFrame) -> DataFrame:
    """Both grains in one relation: gid 1 is per hero, gid 0 per (hero, team).

    The grouping sets expand the already counted (hero, team) rows, not the
    events. A null team is a real group, so only gid tells the grains apart.
    """
    hero, team = F.col("hero_id"), F.col("teamname")
    return hero_team_counts(flat).groupingSets([[hero], [hero, team]], hero, team).agg(
        F.grouping_id().alias("gid"), *_summed_counts()
    )


def _event_counts() -> list[Column]:
    picked = F.col("is_pick")
    return [
        F.count("*").alias("totals"),
        F.count_if(~picked).alias("bans"),
        F.count_if(picked).alias("picks"),
        F.count_if(picked & F.col("winner")).alias("wins"),
    ]


def _summed_counts() -> list[Column]:
    return [F.sum(m).alias(m) for m in _MEASURES]


# Reports over the counts -----------------------------------------------------


def hero_stats(counts: DataFrame, mode: str = FULL, ordered: bool = True) -> DataFrame:
    """hero_id, totals, bans, picks, winrate from `hero_counts`, by hero_id, nulls first."""
    hero = F.col("hero_id")
    if _is_strict(mode):
        won = hero.isNotNull() & (F.col("wins") > 0)
        columns = [
            F.when(hero.isNotNull(), F.nullif("bans", F.lit(0))).alias("bans"),
            F.when(won, F.col("picks")).alias("picks"),
            F.when(won, _rate()).alias("winrate"),
        ]
    else:
        columns = [F.col("bans"), F.col("picks"), _rate_or_zero()]
    stats = counts.select("hero_id", "totals", *columns)
    return stats.orderBy(F.asc("hero_id")) if ordered else stats


def team_stats(team_counts: DataFrame) -> DataFrame:
    """hero_id, teamname, bans, picks, winrate in full mode; only pairs picked or banned."""
    return team_counts.filter("bans + picks > 0").select(
        "hero_id", "teamname", "bans", "picks", _rate_or_zero()
    )


def team_picks(team_counts: DataFrame, mode: str = STRICT, ordered: bool = True) -> DataFrame:
    """teamname, hero_id, picks, winrate; the most picked first within a team."""
    if _is_strict(mode):
        rows = team_counts.filter("teamname IS NOT NULL AND hero_id IS NOT NULL AND wins > 0")
    else:
        rows = team_counts.filter("picks > 0")
    rows = rows.select("teamname", "hero_id", "picks", _rate().alias("winrate"))
    return rows.orderBy("teamname", F.desc("picks"), "hero_id") if ordered else rows


def team_bans(team_counts: DataFrame, mode: str = STRICT, ordered: bool = True) -> DataFrame:
    """teamname, hero_id, bans; the most banned first within a team."""
    rows = team_counts.filter("bans > 0")
    if _is_strict(mode):
        rows = rows.filter("teamname IS NOT NULL")
    rows = rows.select("teamname", "hero_id", "bans")
    return rows.orderBy("teamname", F.desc("bans"), "hero_id") if ordered else rows


def team_names(rows: DataFrame) -> DataFrame:
    """Distinct team names of flat events or of counts; null is one of them."""
    return rows.select("teamname").distinct()


def for_team(rows: DataFrame, teamname: str) -> DataFrame:
    """One team's rows of any relation with a team name."""
    return rows.filter(F.col("teamname") == teamname)


def team_events(matches: DataFrame, teamname: str) -> DataFrame:
    """`draft_events` of one team.

    The team of an event is known only after the explode, so no filter on it
    reaches the scan. That the match has the team on one of its sides does.
    """
    played = matches.filter((F.col("radiant_name") == teamname) | (F.col("dire_name") == teamname))
    return for_team(draft_events(played), teamname)


def _rate() -> Column:
    return win_rate(F.col("wins"), F.col("picks"))


def _rate_or_zero() -> Column:
    return F.coalesce(_rate(), F.lit(0.0)).alias("winrate")


def _is_strict(mode: str) -> bool:
    if mode not in (FULL, STRICT):
        raise ValueError(f"mode must be {FULL!r} or {STRICT!r}, not {mode!r}")
    return mode == STRICT
