import json

import pytest
from conftest import rows
from pyspark.errors import AnalysisException

import main
from draftstats.operators import draft
from draftstats.sources import read_matches


@pytest.fixture(autouse=True)
def keep_settings(spark):
    before = {key: spark.conf.get(key, None) for key in main.SMALL_FILES}
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_land_then_report(spark, match_dir, tmp_path, capsys):
    table, out = str(tmp_path / "table"), str(tmp_path / "out")
    main.main(["land", "--input", match_dir, "--output", table])
    assert "unreadable=" in capsys.readouterr().out
    main.main(["draft", "--input", table, "--landed", "--output", out, "--mode", "strict"])
    main.main(["items", "--input", table, "--landed", "--output", out, "--format", "json"])
    flat = draft.picks_bans_flat(read_matches(spark, match_dir))
    expected = rows(draft.hero_stats(draft.hero_counts(flat), draft.STRICT))
    assert rows(spark.read.parquet(f"{out}/hero_stats")) == expected
    items = spark.read.schema("key string, totals bigint, timings bigint").json(f"{out}/item_stats")
    assert rows(items) == [("boots", 1, None), ("tango", 2, -90)]


def test_land_with_checkpoint_and_unique_files(spark, match_dir, tmp_path):
    table = str(tmp_path / "table")
    for _ in range(2):
        checkpoint = ["--checkpoint", str(tmp_path / "c"), "--max-files", "4"]
        main.main(["land", "--input", match_dir, "--output", table, "--unique", *checkpoint])
    assert rows(spark.read.parquet(table).select("match_id")) == [(1,), (2,), (3,), (5,)]


def test_reports_straight_from_json(spark, match_dir, tmp_path):
    main.main(["draft", "--input", f"{match_dir}/1.json", "--output", str(tmp_path / "o"), "--failfast"])
    assert spark.read.parquet(str(tmp_path / "o" / "team_names")).count() == 2


def test_listing_and_pending(spark, match_dir, tmp_path):
    (tmp_path / "lists").mkdir()
    for league, ids in ((16169, [1, 2, 7]), (16201, [7, 8]), (5, [9])):
        listing = [{"match_id": i, "leagueid": league} for i in ids]
        (tmp_path / "lists" / f"{league}.json").write_text(json.dumps(listing))
    table, matches, out = (str(tmp_path / name) for name in ("table", "matches", "out"))
    for _ in range(2):
        main.main(["listing", "--input", str(tmp_path / "lists"), "--output", table])
    assert spark.read.parquet(table).count() == 5
    main.main(["pending", "--input", table, "--output", out])
    assert rows(spark.read.parquet(out)) == [(1,), (2,), (7,), (8,)]
    main.main(["land", "--input", match_dir, "--output", matches])
    main.main(["pending", "--input", table, "--matches", matches, "--output", out])
    assert rows(spark.read.parquet(out)) == [(7,), (8,)]


def test_job(spark, tmp_path):
    record = {"status": "SKIPPED", "stageId": 3, "attemptId": 0}
    (tmp_path / "app-1-2.json").write_text(json.dumps([record]))
    main.main(["job", "--records", "--input", str(tmp_path / "app-1-2.json"), "--output", str(tmp_path / "o")])
    row = spark.read.parquet(str(tmp_path / "o" / "summary")).first()
    assert (row.app_id, row.skipped_stages, row.computed_stages) == ("app-1-2", 1, 0)


def test_malformed(spark, match_dir, tmp_path):
    main.main(["malformed", "--input", match_dir, "--output", str(tmp_path / "o")])
    found = spark.read.parquet(str(tmp_path / "o"))
    assert {r.match_id for r in found.collect()} == {4, 5, 6}


def test_settings_given_at_submission_stay(spark):
    submitted = spark.conf.get("spark.sql.shuffle.partitions")
    main.set_defaults(spark, {"spark.sql.shuffle.partitions": "99", **main.SMALL_FILES})
    assert spark.conf.get("spark.sql.shuffle.partitions") == submitted != "99"
    assert spark.conf.get("spark.sql.files.openCostInBytes") == main.SMALL_FILES["spark.sql.files.openCostInBytes"]


@pytest.mark.parametrize(
    "args", [["malformed", "--failfast"], ["land", "--failfast", "--checkpoint", "c"], ["land", "--landed"]]
)
def test_options_without_a_meaning_are_refused(args, tmp_path):
    with pytest.raises(SystemExit):
        main.main([*args, "--input", str(tmp_path), "--output", str(tmp_path / "o")])


def test_a_mistyped_match_table_is_an_error(spark, tmp_path):
    spark.createDataFrame([(1, 2)], "match_id bigint, leagueid bigint").write.parquet(str(tmp_path / "list"))
    with pytest.raises(AnalysisException):
        main.main(["pending", "--input", str(tmp_path / "list"), "--matches", str(tmp_path / "typo"), "--output", str(tmp_path / "o")])
