"""Random documents and stage records, against plain loops over them."""

import json
from collections import Counter
from datetime import datetime, timedelta

import numpy as np
import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from draftstats.operators import draft, items, stages
from draftstats.schemas import STAGE_RECORD
from draftstats.sources import parse_matches

maybe = lambda s: st.none() | s
names = maybe(st.sampled_from(["A", "B", "", "a/b", "ü"]))
events = st.fixed_dictionaries(
    {"hero_id": maybe(st.integers(1, 4)), "is_pick": maybe(st.booleans()), "team": maybe(st.integers(0, 2))}
)
purchases = st.fixed_dictionaries({"key": names, "time": maybe(st.integers(-90, 90))})
players = st.fixed_dictionaries({"purchase_log": maybe(st.lists(purchases, max_size=4))})
documents = st.fixed_dictionaries(
    {
        "picks_bans": maybe(st.lists(events, max_size=6)),
        "radiant_name": names,
        "dire_name": names,
        "radiant_win": maybe(st.booleans()),
        "players": maybe(st.lists(players, max_size=3)),
    }
)


def flatten(docs):
    for doc in docs:
        for e in doc["picks_bans"] or []:
            winner = (e["team"], doc["radiant_win"]) in ((0, True), (1, False))
            team = doc["radiant_name"] if e["team"] == 0 else doc["dire_name"]
            yield e["hero_id"], e["is_pick"], team, winner


def in_order(found):
    return sorted(found, key=lambda r: [(v is not None, v) for v in r])


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(documents, min_size=1, max_size=25))
def test_draft_and_items(spark, docs):
    parsed = parse_matches(spark.createDataFrame([(json.dumps(d),) for d in docs], "value string")).cache()
    flat = list(flatten(docs))
    assert rows(draft.draft_events(parsed)) == in_order(flat)

    totals = Counter(h for h, *_ in flat)
    bans = Counter(h for h, pick, *_ in flat if pick is False)
    picks = Counter(h for h, pick, *_ in flat if pick)
    wins = Counter(h for h, pick, _, won in flat if pick and won)
    counts = draft.hero_counts(draft.draft_events(parsed))
    assert rows(draft.hero_stats(counts)) == in_order(
        (h, n, bans[h], picks[h], wins[h] / picks[h] if picks[h] else 0.0) for h, n in totals.items()
    )

    def strict(hero):
        if hero is None:
            return None, None, None
        won = wins[hero] > 0
        return bans[hero] or None, picks[hero] if won else None, wins[hero] / picks[hero] if won else None

    assert rows(draft.hero_stats(counts, draft.STRICT)) == in_order((h, n, *strict(h)) for h, n in totals.items())

    team_picks = Counter((t, h) for h, pick, t, _ in flat if pick)
    team_wins = Counter((t, h) for h, pick, t, won in flat if pick and won)
    expected = in_order(
        (t, h, n, team_wins[t, h] / n) for (t, h), n in team_picks.items() if None not in (t, h) and team_wins[t, h]
    )
    assert rows(draft.team_picks(draft.hero_team_counts(draft.draft_events(parsed)))) == expected

    bought = [(p["key"], p["time"]) for d in docs for x in d["players"] or [] for p in x["purchase_log"] or []]
    first = {}
    for key, time in bought:
        known = [t for t in (first.get(key), time) if t is not None]
        first[key] = min(known, default=None)
    times = Counter(key for key, _ in bought)
    assert rows(items.item_stats(items.item_purchases(parsed))) == in_order(
        (key, n, first[key]) for key, n in times.items() if key is not None
    )
    parsed.unpersist()


stage_records = st.fixed_dictionaries(
    {
        "status": st.sampled_from(["SKIPPED", "COMPLETE", "COMPLETE", "FAILED", None]),
        "launch": maybe(st.integers(-2_000, 90_000_000)),
        "length": maybe(st.integers(-2_000, 90_000_000)),
        "written": maybe(st.integers(0, 3)),
        "write_ns": st.integers(0, 10**7),
        "remote": maybe(st.integers(0, 3)),
        "failed": maybe(st.integers(0, 2)),
        "tasks": st.lists(st.tuples(st.integers(0, 5000), st.integers(0, 50)), max_size=3),
    }
)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(stage_records, min_size=1, max_size=30))
def test_stage_summary(spark, found):
    start = datetime(2025, 5, 6, 10)

    def at(ms):
        return None if ms is None else f"{(start + timedelta(milliseconds=ms)).isoformat(timespec='milliseconds')}GMT"

    records = [
        {
            "status": s["status"],
            "stageId": i,
            "submissionTime": at(0),
            "firstTaskLaunchedTime": at(s["launch"]),
            "completionTime": at(s["length"]),
            "shuffleWriteBytes": s["written"],
            "shuffleWriteTime": s["write_ns"],
            "shuffleRemoteBytesRead": s["remote"],
            "numFailedTasks": s["failed"],
            "tasks": {
                str(t): {"taskMetrics": {"executorRunTime": run, "executorDeserializeTime": deserialize}}
                for t, (run, deserialize) in enumerate(s["tasks"])
            },
        }
        for i, s in enumerate(found)
    ]
    df = spark.createDataFrame(records, STAGE_RECORD).selectExpr("'a' AS app_id", "*")
    row = stages.stage_summary(stages.stages_from_records(df)).first().asDict()

    ran = [s for s in found if s["status"] != "SKIPPED"]
    lengths = [s["length"] / 1000 for s in ran if s["length"] is not None]
    waits = [s["launch"] / 1000 for s in ran if s["launch"] is not None]
    wrote = [s for s in ran if s["written"]]
    read = [s["remote"] for s in ran if s["remote"]]
    tasks = [t for s in ran for t in s["tasks"]]

    def mean(values):
        return float(np.average(values)) if values else None

    expected = {
        "computed_stages": len(ran),
        "skipped_stages": len(found) - len(ran),
        "avg_stage_s": mean(lengths),
        "p99_stage_s": float(np.percentile(lengths, 99)) if lengths else None,
        "max_stage_s": max(lengths, default=None),
        "avg_scheduling_wait_s": mean(waits),
        "avg_task_run_s": mean([run / 1000 for run, _ in tasks]),
        "avg_task_deserialize_s": mean([deserialize / 1000 for _, deserialize in tasks]),
        "disk_accesses": len(wrote),
        "disk_access_fraction": len(wrote) / len(found),
        "skipped_fraction": (len(found) - len(ran)) / len(found),
        "disk_bytes_written": sum(s["written"] for s in wrote),
        "avg_shuffle_write_s": mean([s["write_ns"] / 1e9 for s in wrote]),
        "data_exchanges": len(read),
        "bytes_exchanged": sum(read),
    }
    assert row == {k: v if v is None else pytest.approx(v, rel=1e-9, abs=1e-9) for k, v in expected.items()}
    assert rows(stages.completion_cdf(stages.stages_from_records(df))) == [
        (v, i / len(lengths)) for i, v in enumerate(sorted(lengths))
    ]
    failed = [(i,) for i, s in enumerate(found) if s["status"] != "SKIPPED" and s["failed"]]
    assert rows(stages.failed_stages(stages.stages_from_records(df)).select("stage_id")) == failed
