import os

import pytest
from conftest import rows
from pyspark.sql import functions as F

from draftstats.operators import draft, items, stages
from draftstats import sinks
from draftstats.plans import Read, compact, counts_of_landings, draft_report, draft_report_of_counts, item_report, job_report, land_matches
from draftstats.schemas import MATCH
from draftstats.sinks import write_by_team, write_stats
from draftstats.sources import proxies, read_matches


def ordered(df):
    return [tuple(r) for r in df.collect()]


def files(path):
    return [f for _, _, names in os.walk(path) for f in names if f.startswith("part-")]


def test_team_directories_keep_every_name(spark, tmp_path):
    teams = spark.createDataFrame(
        [("a/b", 1, 5), ("a/b", 2, 9), (None, 3, 1), ("", 4, 1), ("x=y", 5, 1)], "teamname string, hero_id int, picks int"
    )
    path = str(tmp_path / "teams")
    write_by_team(teams, path, [F.desc("picks"), "hero_id"])
    back = spark.read.parquet(path)
    assert rows(back.drop("team_dir")) == rows(teams)
    assert "team_dir=a%2Fb" in os.listdir(path)
    assert ordered(back.filter("teamname = 'a/b'").select("hero_id", "picks")) == [(2, 9), (1, 5)]


def test_a_team_is_few_files(spark, tmp_path):
    teams = spark.range(20_000).selectExpr("concat('t', id % 5) AS teamname", "id AS hero_id", "id AS bans").repartition(16)
    path = str(tmp_path / "teams")
    write_by_team(teams, path, ["hero_id"])
    assert len(files(path)) <= 10 and spark.read.parquet(path).count() == 20_000


def test_a_very_large_team_is_split(spark, tmp_path):
    teams = spark.range(200_000).selectExpr(
        "CASE WHEN id % 10 > 0 THEN 'hot' ELSE concat('t', id % 3) END AS teamname", "id AS hero_id", "hash(id) AS bans"
    )
    path = str(tmp_path / "teams")
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "200k")
    try:
        write_by_team(teams.repartition(8), path, ["hero_id"])
    finally:
        spark.conf.set(key, before)
    assert len(files(f"{path}/team_dir=hot")) > 1
    assert all(len(files(f"{path}/team_dir=t{i}")) <= 2 for i in range(3))
    back = spark.read.parquet(path).drop("team_dir")
    assert back.count() == 200_000 and back.exceptAll(teams).isEmpty()


def test_write_stats_keeps_the_order(spark, tmp_path):
    df = spark.range(1000).withColumn("v", F.hash("id")).orderBy(F.desc("v"))
    for fmt in ("parquet", "json", "csv"):
        write_stats(df, str(tmp_path / fmt), fmt)
    back = [r.v for r in spark.read.parquet(str(tmp_path / "parquet")).collect()]
    assert sorted(back, reverse=True) == sorted((r.v for r in df.collect()), reverse=True)
    parts = sorted(f for f in os.listdir(tmp_path / "csv") if f.startswith("part-"))
    lines = [line for part in parts for line in (tmp_path / "csv" / part).read_text().split()]
    values = [int(line.split(",")[1]) for line in lines]
    assert values == sorted(values, reverse=True)


def test_draft_report(spark, sf_dir, tmp_path):
    docs = proxies.draft_documents(spark, sf_dir)
    flat = draft.picks_bans_flat(docs)
    counts = draft.hero_team_counts(flat)
    full, strict = str(tmp_path / "full"), str(tmp_path / "strict")
    draft_report(docs, full)
    draft_report(docs, strict, draft.STRICT)
    heroes = spark.read.parquet(f"{full}/hero_stats")
    assert rows(heroes) == rows(draft.hero_stats(draft.hero_counts(flat)))
    assert rows(spark.read.parquet(f"{full}/team_stats").drop("team_dir")) == rows(draft.team_stats(counts))
    assert rows(spark.read.parquet(f"{full}/team_names")) == rows(draft.team_names(flat))
    assert rows(spark.read.parquet(f"{strict}/hero_stats")) == rows(draft.hero_stats(draft.hero_counts(flat), draft.STRICT))
    assert rows(spark.read.parquet(f"{strict}/team_picks").drop("team_dir")) == rows(draft.team_picks(counts))
    assert rows(spark.read.parquet(f"{strict}/team_bans").drop("team_dir")) == rows(draft.team_bans(counts))


def test_item_report(spark, sf_dir, tmp_path):
    docs = proxies.loadout_documents(spark, sf_dir)
    item_report(docs, str(tmp_path))
    expected = items.item_stats(items.item_purchases(docs))
    assert rows(spark.read.parquet(f"{tmp_path}/item_stats")) == rows(expected)


def test_job_report(spark, sf_dir, tmp_path):
    found = stages.stages_from_records(proxies.stage_records(spark, sf_dir))
    job_report(found, str(tmp_path))
    read = lambda name: spark.read.parquet(f"{tmp_path}/{name}")
    assert read("summary").count() == 7
    assert rows(read("durations")) == rows(stages.stage_durations(found))
    assert rows(read("completion_cdf")) == rows(stages.completion_cdf(found, ["app_id"]))
    assert rows(read("failed_stages")) == rows(stages.failed_stages(found))


def test_reports_of_nothing(spark, tmp_path):
    empty = spark.createDataFrame([], MATCH)
    assert draft_report(empty, str(tmp_path / "d")) == Read(0, 0)
    assert item_report(empty, str(tmp_path / "i")) == Read(0, 0)
    assert spark.read.parquet(f"{tmp_path}/d/hero_stats").count() == 0
    assert spark.read.parquet(f"{tmp_path}/i/item_stats").count() == 0


def below(folder):
    return {os.path.join(d, f): open(os.path.join(d, f), "rb").read() for d, _, names in os.walk(folder) for f in names}


def test_a_report_that_fails_leaves_the_old_one_whole(spark, sf_dir, tmp_path, monkeypatch):
    docs, out = proxies.draft_documents(spark, sf_dir), str(tmp_path / "out")
    draft_report(docs.limit(50), out)
    before = below(out)
    monkeypatch.setattr(draft, "team_stats", lambda counts: counts.filter(F.raise_error(F.lit("lost")).isNull()))
    with pytest.raises(Exception, match="lost"):
        draft_report(docs, out)
    assert {path: content for path, content in below(out).items() if "/_unfinished/" not in path} == before
    monkeypatch.undo()
    draft_report(docs, out)
    flat = draft.picks_bans_flat(docs)
    assert rows(spark.read.parquet(f"{out}/hero_stats")) == rows(draft.hero_stats(draft.hero_counts(flat)))
    assert sorted(os.listdir(out)) == ["draft_counts", "hero_stats", "team_names", "team_stats"]


def test_a_report_that_was_interrupted_as_it_took_its_place(spark, tmp_path, monkeypatch):
    out = str(tmp_path)
    for name in ("a", "b"):
        sinks.write_stats(spark.range(1), f"{out}/{name}")
    monkeypatch.setattr(sinks, "settle", lambda *_: None)
    with sinks.published(spark, out) as folder:
        for name in ("a", "b", "c"):
            sinks.write_stats(spark.range(2), f"{folder}/{name}")
    monkeypatch.undo()
    # One table was moved when the session died.
    sinks.delete(spark, f"{out}/a")
    os.rename(f"{out}/_finished/a", f"{out}/a")
    sinks.settle(spark, out)
    assert sorted(os.listdir(out)) == ["a", "b", "c"]
    assert [spark.read.parquet(f"{out}/{name}").count() for name in "abc"] == [2, 2, 2]


def test_counts_kept_per_landing_equal_a_full_count(spark, sf_dir, tmp_path):
    docs, table, kept = proxies.arriving_documents(spark, sf_dir), str(tmp_path / "t"), str(tmp_path / "counts")
    for i in range(3):
        land_matches(docs.filter(f"match_id % 3 <= {i}"), table)
        found = counts_of_landings(spark, table, kept)
        whole = rows(draft.hero_team_counts(draft.draft_events(spark.read.parquet(table))))
        assert rows(found) == whole
        assert rows(counts_of_landings(spark, table, kept)) == whole
    assert len([d for d in os.listdir(kept) if d.startswith("batch=")]) == 3
    compact(spark, table)
    found = counts_of_landings(spark, table, kept)
    assert rows(found) == whole
    draft_report_of_counts(found, str(tmp_path / "out"))
    assert rows(spark.read.parquet(f"{tmp_path}/out/draft_counts")) == whole
    heroes = draft.hero_counts(draft.draft_events(spark.read.parquet(table)))
    assert rows(spark.read.parquet(f"{tmp_path}/out/hero_stats")) == rows(draft.hero_stats(heroes))


def test_only_new_landings_are_counted(spark, tmp_path):
    table, kept = str(tmp_path / "t"), str(tmp_path / "counts")
    docs = spark.createDataFrame([], MATCH).select("*", F.lit("f").alias("source_file"))
    land_matches(docs, table)
    events = "array(named_struct('hero_id', id, 'is_pick', true, 'order', 1L, 'team', 0L)) AS picks_bans"
    columns = ["id AS match_id", events, "'A' AS radiant_name", "'B' AS dire_name", "true AS radiant_win", "'f' AS source_file"]
    for start in (0, 5):
        land_matches(spark.range(start, start + 5).selectExpr(*columns), table)
        assert counts_of_landings(spark, table, kept).agg(F.sum("picks")).first()[0] == start + 5
    # What was counted is not read again.
    for name in os.listdir(f"{table}/era=0"):
        if name.endswith(".parquet") and spark.read.parquet(f"{table}/era=0/{name}").filter("batch = 0").count():
            os.remove(f"{table}/era=0/{name}")
    assert counts_of_landings(spark, table, kept).agg(F.sum("picks")).first()[0] == 10


def test_reports_straight_from_json_count_what_they_could_not_read(spark, match_dir, tmp_path):
    docs = read_matches(spark, f"{match_dir}/[1-5].json")
    # One line is cut off, and one has hero ids in quotes, which matter to the drafts alone.
    assert draft_report(docs, str(tmp_path / "d")) == Read(lines=5, rejected=2)
    assert item_report(docs, str(tmp_path / "i")) == Read(lines=5, rejected=1)
    assert draft_report(docs.drop("_corrupt_record"), str(tmp_path / "d")) == Read(lines=5, rejected=0)


def test_documents_without_events_are_counted(spark, tmp_path):
    for name, text in (("1.json", "{}"), ("2.json", "broken")):
        (tmp_path / name).write_text(text)
    docs = read_matches(spark, f"{tmp_path}/*.json")
    assert draft_report(docs, str(tmp_path / "d")) == item_report(docs, str(tmp_path / "i")) == Read(2, 1)
