"""Expressions over one draft event and its match header."""

from pyspark.sql import Column
from pyspark.sql import functions as F

RADIANT, DIRE = 0, 1


def team_name(team: Column, radiant_name: Column, dire_name: Column) -> Column:
    """Side 0 is radiant; every other value, null included, counts as dire."""
    return F.when(team == RADIANT, radiant_name).otherwise(dire_name)


def is_winner(team: Column, radiant_win: Column) -> Column:
    """Whether the event's side won. Unknown side or unknown result is False, never null."""
    side_won = ((team == RADIANT) & radiant_win) | ((team == DIRE) & ~radiant_win)
    return F.coalesce(side_won, F.lit(False))


def win_rate(wins: Column, picks: Column) -> Column:
    """wins / picks as double; null where there are no picks."""
    return F.try_divide(wins, picks)
