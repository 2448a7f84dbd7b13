import json
import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_DIR = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("draftstats-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


def rows(df):
    """Rows as a sorted list of tuples, nulls first."""
    return sorted((tuple(r) for r in df.collect()), key=lambda r: [(v is not None, v) for v in r])


def event(hero_id, is_pick, team, order=0):
    return {"hero_id": hero_id, "is_pick": is_pick, "order": order, "team": team}


def purchase(key, time):
    return {"key": key, "time": time}


FIRST = {
    "picks_bans": [
        event(1, True, 0),
        event(2, True, 1),
        event(3, False, 0),
        event(4, True, 2),
        event(None, True, 0),
        event(5, None, 0),
        event(6, True, None),
    ],
    "radiant_name": "A",
    "dire_name": "B",
    "radiant_win": True,
    "players": [
        {
            "name": "x",
            "hero_id": 1,
            "purchase_log": [purchase("tango", -90), purchase("tango", 10), purchase("boots", None), purchase(None, 5)],
        },
        {"name": "y", "hero_id": 2, "purchase_log": None},
    ],
}
LOOSELY_TYPED = {
    "picks_bans": [event("12", True, 0), event(13, 1, 0), event(1, True, 0)],
    "radiant_name": "C",
    "dire_name": None,
    "radiant_win": None,
}


@pytest.fixture(scope="session")
def match_dir(tmp_path_factory):
    """Six match files: whole, null events, no events, cut off, loosely typed, pretty-printed."""
    folder = tmp_path_factory.mktemp("matches")
    texts = {
        1: json.dumps(FIRST),
        2: json.dumps({"picks_bans": None, "radiant_name": "A", "dire_name": "B", "radiant_win": True}),
        3: json.dumps({"picks_bans": [], "radiant_name": "A", "dire_name": "B", "radiant_win": True}),
        4: json.dumps(FIRST)[:-20],
        5: json.dumps(LOOSELY_TYPED),
        6: json.dumps({"picks_bans": [event(9, True, 0)], "radiant_name": "Z"}, indent=2),
    }
    for match_id, text in texts.items():
        (folder / f"{match_id}.json").write_text(text)
    return str(folder)
