import json
import os
import time

from conftest import FIRST, event, rows

from draftstats.operators import draft, ingest
from draftstats.plans import Landing, Listed, land_listing, land_matches
from draftstats.sources import LEAGUE_IDS, read_landed, read_listing_objects, read_matches
from draftstats.streaming import land_new_files


def listing(spark, ids, league=16169):
    return spark.createDataFrame([(i, league) for i in ids], "match_id bigint, leagueid bigint")


def test_union_keeps_and_dedup_drops_copies(spark):
    both = ingest.listing_union(listing(spark, [1, 2, 3]), listing(spark, [3, 4], 16201))
    assert rows(both.select("match_id")) == [(1,), (2,), (3,), (3,), (4,)]
    assert rows(ingest.listing_dedup(both)) == [(1,), (2,), (3,), (4,)]


def test_union_of_listings_with_different_columns(spark):
    wide = spark.createDataFrame([(5, 1, "x")], "match_id bigint, leagueid bigint, note string")
    assert rows(ingest.listing_union(listing(spark, [1]), wide).select("match_id", "note")) == [(1, None), (5, "x")]


def test_listing_table_only_grows(spark, tmp_path):
    table = str(tmp_path / "listing")
    land_listing(listing(spark, [1, 2, 2]), table)
    land_listing(ingest.listing_union(listing(spark, [2, 3]), listing(spark, [2], 16201)), table)
    land_listing(listing(spark, [3]), table)
    assert rows(read_landed(spark, table)) == [(1, 16169), (2, 16169), (2, 16201), (3, 16169)]


def objects_in(folder, name, *lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(line if isinstance(line, str) else json.dumps(line) for line in lines))
    return str(folder)


GAME = {"match_id": 1, "leagueid": 16169, "radiant_name": "A", "series": {"id": 5, "games": [1, 2]}, "note": None}


def test_listing_objects_come_back_whole(spark, tmp_path):
    both = [{**GAME, "match_id": 2, "extra": "é"}, {"match_id": 3, "leagueid": "x", "duration": 2.5}]
    path = objects_in(tmp_path / "in", "a.json", GAME, both, "{not json", [], {"leagueid": 16169})
    found = read_listing_objects(spark, path)
    listed = {r.match_id: (r.leagueid, json.loads(r.text)) for r in found.selectExpr("*", "to_json(listing) AS text").collect()}
    assert listed == {1: (16169, GAME), 2: (16169, both[0]), 3: (None, both[1]), None: (16169, {"leagueid": 16169})}
    pretty = tmp_path / "pretty.json"
    pretty.write_text(json.dumps(both, indent=2))
    assert rows(read_listing_objects(spark, str(pretty), multi_line=True).select("match_id")) == [(2,), (3,)]


def test_listing_table_keeps_objects_and_counts_those_without_a_league(spark, tmp_path):
    table = str(tmp_path / "table")
    first = objects_in(tmp_path / "a", "a.json", [GAME, {**GAME, "note": "copy"}, {"match_id": 9}])
    assert land_listing(read_listing_objects(spark, first), table, LEAGUE_IDS) == Listed(3, 0, 1)
    again = objects_in(tmp_path / "b", "a.json", {**GAME, "note": "later"}, {**GAME, "match_id": 4}, {**GAME, "leagueid": 5}, {"leagueid": 1})
    assert land_listing(read_listing_objects(spark, again), table, LEAGUE_IDS) == Listed(4, 1, 0)
    found = read_landed(spark, table)
    texts = {r.match_id: json.loads(r.text) for r in found.selectExpr("match_id", "to_json(listing) AS text").collect()}
    assert texts == {1: {**GAME, "note": "copy"}, 4: {**GAME, "match_id": 4}}
    assert rows(ingest.pending_matches(found, None)) == [(1,), (4,)]


def test_listings_of_nothing_wanted(spark, tmp_path):
    table, path = str(tmp_path / "table"), objects_in(tmp_path / "in", "a.json", {"match_id": 1, "leagueid": 5}, {"match_id": 2})
    assert land_listing(read_listing_objects(spark, path), table, LEAGUE_IDS) == Listed(2, 0, 1)
    empty = spark.createDataFrame([], "match_id bigint, leagueid bigint")
    assert land_listing(empty, str(tmp_path / "other")) == Listed(0, 0, 0)


def test_pending(spark):
    both = ingest.listing_union(listing(spark, [1, 2, 3]), listing(spark, [3, 4]))
    landed = spark.createDataFrame([(2,), (2,), (9,)], "match_id bigint")
    assert rows(ingest.pending_matches(both, landed)) == [(1,), (3,), (4,)]
    assert rows(ingest.pending_matches(both, None)) == [(1,), (2,), (3,), (4,)]


def test_pending_ignores_rows_without_id(spark):
    assert rows(ingest.pending_matches(listing(spark, [None, 1]), listing(spark, [None]))) == [(1,)]


def test_leagues(spark):
    both = ingest.listing_union(listing(spark, [1]), listing(spark, [2], 5))
    assert rows(ingest.of_leagues(both, LEAGUE_IDS).select("match_id")) == [(1,)]
    assert len(LEAGUE_IDS) == len(set(LEAGUE_IDS)) == 20


def test_landing_is_repeatable_and_skips_unreadable_lines(spark, match_dir, tmp_path):
    table = str(tmp_path / "table")
    docs = read_matches(spark, match_dir)
    assert read_landed(spark, table) is None
    with open(f"{match_dir}/6.json") as file:
        pretty = len(file.readlines())
    counts = Landing(lines=5 + pretty, damaged=1, unreadable=1 + pretty, unnamed=0)
    assert land_matches(docs, table) == counts
    assert land_matches(docs, table) == counts
    landed = read_landed(spark, table)
    assert rows(landed.select("match_id")) == [(1,), (2,), (3,), (5,)]
    assert rows(draft.picks_bans_flat(landed)) == rows(draft.picks_bans_flat(docs))


def test_landing_files_known_to_be_unique(spark, match_dir, tmp_path):
    table = str(tmp_path / "table")
    land_matches(read_matches(spark, f"{match_dir}/[1-2].json"), table, unique=True)
    land_matches(read_matches(spark, match_dir), table, unique=True)
    assert rows(read_landed(spark, table).select("match_id")) == [(1,), (2,), (3,), (5,)]


def test_landing_documents_without_a_reject_column(spark, match_dir, tmp_path):
    docs = read_matches(spark, f"{match_dir}/1.json", mode="FAILFAST")
    assert land_matches(docs, str(tmp_path / "table")) == Landing(lines=1, damaged=0, unreadable=0, unnamed=0)


def test_landing_counts_documents_without_an_id(spark, tmp_path):
    for name in ("8.json", "other.json"):
        (tmp_path / name).write_text(json.dumps(FIRST))
    docs = read_matches(spark, f"{tmp_path}/*.json")
    assert land_matches(docs, str(tmp_path / "table")) == Landing(lines=2, damaged=0, unreadable=0, unnamed=1)


def test_landing_takes_the_first_of_several_copies(spark, tmp_path):
    for folder, hero in (("b", 2), ("a", 1), ("c", 3)):
        (tmp_path / folder).mkdir()
        (tmp_path / folder / "7.json").write_text(json.dumps({**FIRST, "picks_bans": [event(hero, True, 0)]}))
    table = str(tmp_path / "table")
    land_matches(read_matches(spark, [str(tmp_path / f) for f in "abc"]), table)
    assert rows(draft.hero_picks(draft.picks_bans_flat(read_landed(spark, table)))) == [(1, 1)]


def test_landing_one_match_with_most_copies(spark, tmp_path):
    """A third of all documents are copies of one match; it lands once, the others too."""
    docs = spark.range(3000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 0 ELSE id END AS match_id",
        "concat('file-', lpad(id, 5, '0')) AS source_file",
        "id AS copy",
    )
    landed = spark.range(0, 3000, 2).selectExpr("id + 1 AS match_id")
    new = ingest.new_documents(docs.repartition(8), landed).collect()
    ids = {0} | {i for i in range(3000) if i % 3}
    assert {r.match_id for r in new} == {i for i in ids if i % 2 == 0} and len(new) == len({r.match_id for r in new})
    assert next(r.copy for r in new if r.match_id == 0) == 0


def test_streamed_landing_takes_only_new_files(spark, tmp_path):
    source, table, checkpoint = tmp_path / "in", str(tmp_path / "table"), str(tmp_path / "checkpoint")
    source.mkdir()

    def add(match_id):
        (source / f"{match_id}.json").write_text(json.dumps(FIRST))

    def run(max_files=None):
        land_new_files(spark, str(source), table, checkpoint, max_files).awaitTermination(120)
        return rows(read_landed(spark, table).select("match_id"))

    add(1), add(2), add(3)
    assert run(max_files=2) == [(1,), (2,), (3,)]
    add(4)
    (source / "notes.txt").write_text("not a match")
    assert run() == [(1,), (2,), (3,), (4,)]
    assert run() == [(1,), (2,), (3,), (4,)]


def test_streamed_landing_after_a_lost_checkpoint_lands_nothing_twice(spark, tmp_path):
    source, table = tmp_path / "in", str(tmp_path / "table")
    source.mkdir()
    (source / "1.json").write_text(json.dumps(FIRST))
    for attempt in ("one", "two"):
        land_new_files(spark, str(source), table, str(tmp_path / attempt)).awaitTermination(120)
    assert rows(read_landed(spark, table).select("match_id")) == [(1,)]


def test_documents_of_one_file_land_by_their_own_ids(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for part in range(3):
        lines = [json.dumps({**FIRST, "match_id": 5 * part + i}) for i in range(5)]
        (tmp_path / "in" / f"part-0000{part}-abc-c000.json").write_text("\n".join(lines))
    table = str(tmp_path / "table")
    assert land_matches(read_matches(spark, f"{tmp_path}/in"), table) == Landing(15, 0, 0, 0)
    assert rows(read_landed(spark, table).select("match_id")) == [(i,) for i in range(15)]


def test_different_documents_that_share_a_file_name_are_counted_not_merged(spark, tmp_path):
    docs = [json.dumps({**FIRST, "picks_bans": [event(hero, True, 0)]}) for hero in range(5)]
    (tmp_path / "77.json").write_text("\n".join(docs))
    (tmp_path / "78.json").write_text("\n".join(docs[:1] * 2))
    (tmp_path / "part-00001.json").write_text(docs[0])
    table = str(tmp_path / "table")
    found = land_matches(read_matches(spark, f"{tmp_path}/*.json"), table)
    assert found == Landing(lines=8, damaged=0, unreadable=0, unnamed=1, ambiguous=5)
    assert rows(read_landed(spark, table).select("match_id")) == [(78,)]


def test_streamed_landing_takes_old_files_and_keeps_rejects(spark, tmp_path):
    source, table, checkpoint = tmp_path / "in", str(tmp_path / "table"), str(tmp_path / "checkpoint")
    source.mkdir()
    (source / "1.json").write_text(json.dumps(FIRST))
    land_new_files(spark, str(source), table, checkpoint).awaitTermination(120)
    (source / "2.json").write_text(json.dumps(FIRST))
    os.utime(source / "2.json", (time.time() - 20 * 86400,) * 2)
    (source / "3.json").write_text(json.dumps(FIRST)[:-20])
    land_new_files(spark, str(source), table, checkpoint).awaitTermination(120)
    assert rows(read_landed(spark, table).select("match_id")) == [(1,), (2,)]
    assert rows(spark.read.parquet(f"{table}_rejects").select("match_id", "whole_line")) == [(3, True)]
    assert spark.read.parquet(f"{table}_counts").selectExpr("sum(unreadable)").first()[0] == 1


def test_a_listing_of_one_league_names_it(spark):
    unnamed = spark.createDataFrame([(1, None), (2, 7)], "match_id bigint, leagueid bigint")
    assert rows(ingest.of_league(unnamed, 16169)) == [(1, 16169), (2, 7)]
