import random

import pytest
from conftest import event, rows

from draftstats.operators import draft
from draftstats.schemas import MATCH
from draftstats.sources import proxies, read_matches


@pytest.fixture(scope="module")
def flat(spark, match_dir):
    return draft.picks_bans_flat(read_matches(spark, match_dir))


@pytest.fixture(scope="module")
def big_flat(spark, sf_dir):
    return draft.picks_bans_flat(proxies.draft_documents(spark, sf_dir)).cache()


def test_flat_events(flat):
    assert flat.columns == ["hero_id", "is_pick", "order", "team", "teamname", "winner"]
    assert rows(flat.drop("order")) == sorted(
        [
            (1, True, 0, "A", True),
            (2, True, 1, "B", False),
            (3, False, 0, "A", True),
            (4, True, 2, "B", False),
            (None, True, 0, "A", True),
            (5, None, 0, "A", True),
            (6, True, None, "B", False),
            (None, True, 0, "C", False),
            (13, None, 0, "C", False),
            (1, True, 0, "C", False),
        ],
        key=lambda r: [(v is not None, v) for v in r],
    )


def test_counted_events_are_the_flat_events(spark, match_dir, sf_dir, flat):
    counted = ["hero_id", "is_pick", "teamname", "winner"]
    assert rows(draft.draft_events(read_matches(spark, match_dir))) == rows(flat.select(counted))
    docs = proxies.draft_documents(spark, sf_dir)
    assert rows(draft.draft_events(docs)) == rows(draft.picks_bans_flat(docs).select(counted))


def test_a_null_among_the_events_is_an_event_without_values(spark):
    match = {"picks_bans": [None, event(1, True, 0)], "radiant_name": "A", "dire_name": "B", "radiant_win": True}
    docs = spark.createDataFrame([match], MATCH)
    expected = [(None, None, "B", False), (1, True, "A", True)]
    assert rows(draft.draft_events(docs)) == expected
    assert rows(draft.picks_bans_flat(docs).select("hero_id", "is_pick", "teamname", "winner")) == expected


def test_dire_wins_when_radiant_lost(spark):
    match = {"picks_bans": [event(1, True, 0), event(2, True, 1)], "radiant_name": "A", "dire_name": "B", "radiant_win": False}
    flat = draft.picks_bans_flat(spark.createDataFrame([match], MATCH))
    assert rows(flat.select("hero_id", "teamname", "winner")) == [(1, "A", False), (2, "B", True)]


def test_single_counts(flat):
    assert rows(draft.hero_totals(flat)) == [(None, 2), (1, 2), (2, 1), (3, 1), (4, 1), (5, 1), (6, 1), (13, 1)]
    assert rows(draft.hero_picks(flat)) == [(None, 2), (1, 2), (2, 1), (4, 1), (6, 1)]
    assert rows(draft.hero_bans(flat)) == [(3, 1)]
    assert rows(draft.hero_wins(flat)) == [(None, 1), (1, 1)]


def test_hero_stats_full(flat):
    assert [tuple(r) for r in draft.hero_stats(draft.hero_counts(flat)).collect()] == [
        (None, 2, 0, 2, 0.5),
        (1, 2, 0, 2, 0.5),
        (2, 1, 0, 1, 0.0),
        (3, 1, 1, 0, 0.0),
        (4, 1, 0, 1, 0.0),
        (5, 1, 0, 0, 0.0),
        (6, 1, 0, 1, 0.0),
        (13, 1, 0, 0, 0.0),
    ]


def test_hero_stats_strict(flat):
    stats = draft.hero_stats(draft.hero_counts(flat), draft.STRICT)
    assert stats.columns == ["hero_id", "totals", "bans", "picks", "winrate"]
    assert [tuple(r) for r in stats.collect()] == [
        (None, 2, None, None, None),
        (1, 2, None, 2, 0.5),
        (2, 1, None, None, None),
        (3, 1, 1, None, None),
        (4, 1, None, None, None),
        (5, 1, None, None, None),
        (6, 1, None, None, None),
        (13, 1, None, None, None),
    ]


def test_team_results(flat):
    counts = draft.hero_team_counts(flat)
    assert rows(draft.team_picks(counts)) == [("A", 1, 1, 1.0)]
    assert rows(draft.team_bans(counts)) == [("A", 3, 1)]
    assert rows(draft.team_stats(counts)) == [
        (None, "A", 0, 1, 1.0),
        (None, "C", 0, 1, 0.0),
        (1, "A", 0, 1, 1.0),
        (1, "C", 0, 1, 0.0),
        (2, "B", 0, 1, 0.0),
        (3, "A", 1, 0, 0.0),
        (4, "B", 0, 1, 0.0),
        (6, "B", 0, 1, 0.0),
    ]
    assert rows(draft.team_names(flat)) == [("A",), ("B",), ("C",)]
    assert rows(draft.hero_totals(draft.for_team(flat, "B"))) == [(2, 1), (4, 1), (6, 1)]


def test_null_team_is_kept_in_full_and_dropped_in_strict(spark):
    match = {"picks_bans": [event(1, True, 1), event(2, False, 1)], "radiant_name": "A", "dire_name": None, "radiant_win": False}
    flat = draft.picks_bans_flat(spark.createDataFrame([match], MATCH))
    counts = draft.hero_team_counts(flat)
    assert rows(draft.team_names(flat)) == [(None,)]
    assert rows(draft.team_stats(counts)) == [(1, None, 0, 1, 1.0), (2, None, 1, 0, 0.0)]
    assert rows(draft.team_picks(counts)) == [] and rows(draft.team_bans(counts)) == []
    assert rows(draft.team_picks(counts, draft.FULL)) == [(None, 1, 1, 1.0)]
    assert rows(draft.team_bans(counts, draft.FULL)) == [(None, 2, 1)]
    both = {(r.gid, r.hero_id, r.teamname): r.totals for r in draft.draft_counts(flat).collect()}
    assert both == {(1, 1, None): 1, (0, 1, None): 1, (1, 2, None): 1, (0, 2, None): 1}


def test_unknown_mode_is_refused(flat):
    with pytest.raises(ValueError, match="mode must be"):
        draft.hero_stats(draft.hero_counts(flat), "lenient")


def test_no_matches(spark):
    flat = draft.picks_bans_flat(spark.createDataFrame([], MATCH))
    assert rows(draft.hero_stats(draft.hero_counts(flat))) == []
    assert rows(draft.draft_counts(flat)) == []


def test_result_order(big_flat):
    counts = draft.hero_team_counts(big_flat)
    heroes = [r.hero_id for r in draft.hero_stats(draft.hero_counts(big_flat)).collect()]
    assert heroes[0] is None and heroes[1:] == sorted(heroes[1:])
    picks = [(r.teamname, -r.picks, r.hero_id) for r in draft.team_picks(counts).collect()]
    assert picks == sorted(picks)
    bans = [(r.teamname, -r.bans, r.hero_id is not None, r.hero_id or 0) for r in draft.team_bans(counts).collect()]
    assert bans == sorted(bans)


def test_strict_equals_separately_joined_counts(spark, big_flat):
    big_flat.createOrReplaceTempView("pb")
    literal = spark.sql(
        """
        WITH t AS (SELECT hero_id, count(*) totals FROM pb GROUP BY hero_id),
             b AS (SELECT hero_id, count(*) bans FROM pb WHERE is_pick = false GROUP BY hero_id),
             p AS (SELECT hero_id, count(*) picks FROM pb WHERE is_pick = true GROUP BY hero_id),
             w AS (SELECT hero_id, count(*) wins FROM pb WHERE is_pick = true AND winner = true GROUP BY hero_id),
             r AS (SELECT hero_id, picks, try_divide(wins, picks) winrate FROM p JOIN w USING (hero_id))
        SELECT t.hero_id, totals, bans, picks, winrate
        FROM t LEFT JOIN b ON t.hero_id = b.hero_id LEFT JOIN r ON t.hero_id = r.hero_id"""
    )
    strict = rows(draft.hero_stats(draft.hero_counts(big_flat), draft.STRICT))
    assert strict == rows(literal)
    assert any(r[3] is None for r in strict) and any(r[2] is None for r in strict)


def test_invariants(big_flat):
    counts = draft.hero_counts(big_flat)
    teams = draft.hero_team_counts(big_flat)
    assert counts.filter("picks + bans > totals OR wins > picks").isEmpty()
    assert draft.hero_stats(counts).filter("winrate < 0 OR winrate > 1").isEmpty()
    assert rows(draft.roll_up_heroes(teams)) == rows(counts)
    both = draft.draft_counts(big_flat)
    assert rows(both.filter("gid = 1").select(*counts.columns)) == rows(counts)
    assert rows(both.filter("gid = 0").select(*teams.columns)) == rows(teams)


@pytest.mark.parametrize("partitions", ["1", "7"])
def test_result_does_not_depend_on_partitioning(spark, big_flat, partitions):
    expected = rows(draft.draft_counts(big_flat))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        assert rows(draft.draft_counts(big_flat.repartition(int(partitions) + 1))) == expected
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_one_hero_with_most_events(spark):
    """A hot hero reaches the exchange as one partial count per task."""
    generator = random.Random(3)
    events = [event(7 if generator.random() < 0.6 else i, True, i % 2) for i in range(2000)]
    matches = [
        {"picks_bans": events[i : i + 10], "radiant_name": "A", "dire_name": "B", "radiant_win": True}
        for i in range(0, len(events), 10)
    ]
    flat = draft.picks_bans_flat(spark.createDataFrame(matches, MATCH).repartition(6))
    hot = draft.hero_counts(flat).filter("hero_id = 7").first()
    assert hot.totals == sum(e["hero_id"] == 7 for e in events)
    assert hot.wins == sum(e["hero_id"] == 7 and e["team"] == 0 for e in events)
