import json

import pytest
from conftest import FIRST, LOOSELY_TYPED, event, rows
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from draftstats.operators import draft
from draftstats.sources import (
    HERO_ID,
    malformed_matches,
    parse_matches,
    read_listing,
    read_match_lines,
    read_matches,
)

# A failing scan surfaces as the JVM error, a failing expression as Spark's own.
BAD_INPUT = (PySparkException, Py4JJavaError)


def test_match_id_comes_from_the_file_name(spark, match_dir):
    docs = read_matches(spark, f"{match_dir}/*.json")
    assert {r.match_id for r in docs.select("match_id").distinct().collect()} == {1, 2, 3, 4, 5, 6}


def test_permissive_keeps_the_text_of_what_it_could_not_read(spark, match_dir):
    malformed = malformed_matches(read_matches(spark, match_dir))
    found = {}
    for row in malformed.collect():
        found.setdefault(row.match_id, []).append((row._corrupt_record, row.whole_line))
    assert found[4] == [(json.dumps(FIRST)[:-20], True)]
    assert found[5] == [(json.dumps(LOOSELY_TYPED), False)]
    assert set(found) == {4, 5, 6}
    with open(f"{match_dir}/6.json") as file:
        assert len(found[6]) == len(file.readlines())


def test_failfast_raises_on_a_field_of_the_wrong_type(spark, match_dir):
    with pytest.raises(BAD_INPUT, match="FAILED_READ_FILE"):
        read_matches(spark, f"{match_dir}/5.json", mode="FAILFAST").collect()
    whole = read_matches(spark, f"{match_dir}/1.json", mode="FAILFAST")
    assert "_corrupt_record" not in whole.columns and whole.count() == 1


def test_multi_line_reads_pretty_printed_files(spark, match_dir):
    flat = draft.picks_bans_flat(read_matches(spark, f"{match_dir}/6.json", multi_line=True))
    assert rows(flat.select("hero_id", "teamname")) == [(9, "Z")]


def test_coercion_accepts_quoted_numbers_and_numeric_flags(spark, match_dir):
    flat = draft.picks_bans_flat(read_matches(spark, f"{match_dir}/5.json", coerce=True))
    assert rows(flat.select("hero_id", "is_pick", "team", "teamname")) == [
        (1, True, 0, "C"),
        (12, True, 0, "C"),
        (13, True, 0, "C"),
    ]


def test_coercion_gives_null_for_what_is_no_number(spark):
    text = json.dumps({"picks_bans": [event("axe", True, "left")], "radiant_name": "A", "dire_name": "B"})
    flat = draft.picks_bans_flat(parse_matches(spark.createDataFrame([(text,)], "value string"), coerce=True))
    assert rows(flat.select("hero_id", "team", "teamname")) == [(None, None, "B")]


def test_text_lines_equal_the_json_scan(spark, match_dir):
    path = [f"{match_dir}/{i}.json" for i in (1, 2, 3, 5)]
    by_line = draft.picks_bans_flat(read_match_lines(spark, path))
    by_scan = draft.picks_bans_flat(read_matches(spark, path, coerce=True))
    assert rows(by_line) == rows(by_scan)


def test_text_lines_raise_on_malformed_json(spark, match_dir):
    with pytest.raises(BAD_INPUT, match="MALFORMED_RECORD"):
        draft.picks_bans_flat(read_match_lines(spark, f"{match_dir}/4.json")).collect()


def test_json_round_trip(spark, sf_dir, tmp_path):
    """Flat events written as JSON and read back, and documents through files."""
    from draftstats.sinks import write_stats
    from draftstats.sources import proxies

    docs = proxies.draft_documents(spark, sf_dir)
    docs.withColumn("players", F.lit(None).cast("array<struct<name:string>>")).write.json(str(tmp_path / "docs"))
    back = draft.picks_bans_flat(read_matches(spark, str(tmp_path / "docs")))
    expected = rows(draft.picks_bans_flat(docs))
    assert rows(back) == expected
    write_stats(draft.picks_bans_flat(docs), str(tmp_path / "flat"), "json")
    flat = spark.read.schema(back.schema).json(str(tmp_path / "flat"))
    assert rows(flat) == expected


def test_listing_arrays_and_lines(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([{"match_id": 1, "leagueid": 7, "other": "x"}, {"match_id": 2}]))
    (tmp_path / "b.json").write_text(json.dumps([{"match_id": 2, "leagueid": 8}], indent=1))
    arrays = read_listing(spark, [str(tmp_path / "a.json"), str(tmp_path / "b.json")], multi_line=True)
    assert rows(arrays) == [(1, 7), (2, None), (2, 8)]
    (tmp_path / "c.json").write_text('{"match_id": 3, "leagueid": 9}\n{"match_id": 4, "leagueid": 9}\n')
    assert rows(read_listing(spark, str(tmp_path / "c.json"))) == [(3, 9), (4, 9)]
    one_line = read_listing(spark, [str(tmp_path / "a.json"), str(tmp_path / "c.json")])
    assert rows(one_line) == [(1, 7), (2, None), (3, 9), (4, 9)]


def test_only_ids_of_heroes_are_coerced(spark):
    events = [event("12", True, 0), event(13, 1, 0), event(" 7 ", False, "1"), event("x", True, 1), event(None, True, 1)]
    text = json.dumps({"picks_bans": events, "radiant_name": "A", "dire_name": "B", "radiant_win": True})
    lines = spark.createDataFrame([(text,)], "value string")
    ids, flags = (parse_matches(lines, coerce=c).select("picks_bans.hero_id", "picks_bans.is_pick").first() for c in (HERO_ID, True))
    assert ids.hero_id == flags.hero_id == [12, 13, 7, None, None]
    assert ids.is_pick == [True, None, False, True, True] and flags.is_pick == [True, True, False, True, True]
