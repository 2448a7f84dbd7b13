"""

Each query runs an operator of the package on match-, listing- or job-shaped
relations derived from the star-schema tables (`draftstats.sources.proxies`).
The SQL states the same result directly on those tables, in the plainest form:
separately filtered counts and joins where the engine uses a single pass.
"""

from __future__ import annotations

import os
import sys
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from draftstats import draft, ingest, items, landed, stages  # noqa: E402
from draftstats.plans import counts_of_landings, draft_report, land_listing, land_matches  # noqa: E402
from draftstats.sources import (  # noqa: E402
    DRAFT_FIELDS,
    HERO_ID,
    LEAGUE_IDS,
    malformed_matches,
    parse_matches,
    proxies,
    read_event_log,
    read_landed,
    read_listing_objects,
    read_matches,
)

Query = Callable[[SparkSession, str], DataFrame]

# The subpackage and the pipeline may be absent; any other failed import is an error.
LLM_QUERIES: dict[str, Query] = {}
LLM_SQL: dict[str, str] = {}
try:
    from draftstats.llm import queries as llm_queries

    LLM_QUERIES.update(llm_queries.QUERIES)
    LLM_SQL.update(llm_queries.SQL)
    import corpus_pipeline

    LLM_QUERIES["pipeline"] = corpus_pipeline.run
    if corpus_pipeline.ORACLE_SQL:
        LLM_SQL["pipeline"] = corpus_pipeline.ORACLE_SQL
except ModuleNotFoundError as error:
    if error.name not in ("draftstats.llm", "corpus_pipeline"):
        raise
except ImportError as error:
    if error.name != "draftstats.llm":
        raise

BY_APP = ("app_id",)


def entry(spark: SparkSession) -> DataFrame:
    return queries()["hero_stats_full"](spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Query]:
    return {
        "picks_bans_flat": lambda s, d: draft.picks_bans_flat(proxies.draft_documents(s, d)),
        **{name: _on(_events, run) for name, run in _COUNTED.items()},
        "one_team_picks": lambda s, d: draft.team_picks(
            draft.hero_team_counts(draft.team_events(proxies.draft_documents(s, d), "TEAM_5"))
        ),
        **{name: _on(_purchases, run) for name, run in _PURCHASES.items()},
        "player_rows": _player_rows,
        "parsed_picks_bans": lambda s, d: draft.picks_bans_flat(parse_matches(proxies.document_lines(s, d), fields=DRAFT_FIELDS)),
        "coerced_hero_stats": lambda s, d: draft.hero_stats(
            draft.hero_counts(
                draft.draft_events(parse_matches(proxies.document_lines(s, d), coerce=True, fields=DRAFT_FIELDS))
            )
        ),
        "hero_ids_coerced": lambda s, d: draft.hero_stats(
            draft.hero_counts(
                draft.draft_events(parse_matches(proxies.document_lines(s, d), coerce=HERO_ID, fields=DRAFT_FIELDS))
            )
        ),
        "malformed_lines": lambda s, d: malformed_matches(parse_matches(proxies.document_lines(s, d))).select(
            "match_id", "whole_line"
        ),
        "listing_union": lambda s, d: _listing(s, d),
        "listing_dedup": lambda s, d: ingest.listing_dedup(_listing(s, d)),
        "pending_matches": lambda s, d: ingest.pending_matches(_listing(s, d), proxies.landed_ids(s, d)),
        "new_listing_rows": _new_listing_rows,
        "new_documents": _new_documents,
        "landed_index": lambda s, d: landed.bucket_sizes(_index(s, d)),
        "pending_by_index": lambda s, d: landed.pending(_listing(s, d), _index(s, d)),
        "chosen_documents": _chosen_documents,
        "listing_files": _listing_files,
        "landed_files": _landed_files,
        "report_hero_stats": lambda s, d: _report(s, d, "hero_stats"),
        "report_team_stats": lambda s, d: _report(s, d, "team_stats").drop("team_dir"),
        "counts_of_landings": _counts_of_landings,
        **{name: _on(_stages, run) for name, run in _STAGES.items()},
        "stage_task_totals": lambda s, d: _stages_with_tasks(s, d).select(
            *stages.STAGE_KEY, "status", "timed_tasks", "run_ms", "deserialize_ms"
        ),
        "stage_summary": lambda s, d: _rounded(stages.stage_summary(_stages_with_tasks(s, d), BY_APP)),
        "stage_summary_overall": lambda s, d: _rounded(stages.stage_summary(_stages_with_tasks(s, d))),
        "task_rows": lambda s, d: _tasks(s, d),
        "task_summary": lambda s, d: _rounded(stages.task_summary(_tasks(s, d), BY_APP)),
        "stage_percentile_sketch": _percentile_sketch,
        **{name: _on(_log_stages, run) for name, run in _LOG_STAGES.items()},
        "event_log_files": lambda s, d: stages.stages_from_log(read_event_log(s, _log_folder(s, d))).drop(
            "submitted", "first_launch", "completed"
        ),
        "event_log_planned_stages": lambda s, d: stages.stages_from_log(proxies.event_log(s, d, unfinished=3))
        .filter(F.col("status").isin(stages.SKIPPED, stages.PENDING))
        .select("app_id", "stage_id", "status"),
        "event_log_task_summary": lambda s, d: _rounded(
            stages.task_summary(stages.tasks_from_log(proxies.event_log(s, d)), BY_APP)
        ),
        **LLM_QUERIES,
    }


def oracle_sql() -> dict[str, str]:
    return {
        **{name: f"WITH {_PB} {sql}" for name, sql in _DRAFT_SQL.items()},
        **{name: f"WITH {_PURCHASED} {sql}" for name, sql in _PURCHASES_SQL.items()},
        **{name: f"WITH {_PLAIN_PB} {sql}" for name, sql in _PARSED_SQL.items()},
        "player_rows": _PLAYER_ROWS_SQL,
        "malformed_lines": _MALFORMED_SQL,
        **{name: f"WITH {_LISTING} {sql}" for name, sql in _LISTING_SQL.items()},
        "new_documents": _NEW_DOCUMENTS_SQL,
        "chosen_documents": _NEW_DOCUMENTS_SQL,
        "pending_by_index": f"WITH {_LISTING} {_LISTING_SQL['pending_matches']}",
        "landed_index": _LANDED_INDEX_SQL,
        "landed_files": _LANDED_FILES_SQL,
        "counts_of_landings": _LANDED_COUNTS_SQL,
        "listing_files": f"WITH {_LISTING} SELECT DISTINCT match_id, leagueid, leagueid AS game FROM listing",
        "report_hero_stats": f"WITH {_PB} {_HERO_FULL_SQL}",
        "report_team_stats": f"WITH {_PB} {_DRAFT_SQL['team_stats_full']}",
        **{name: f"WITH {_STAGE} {sql}" for name, sql in _STAGES_SQL.items()},
        **{name: f"WITH {_LOG} {sql}" for name, sql in _LOG_SQL.items()},
        **LLM_SQL,
    }


# Queries ---------------------------------------------------------------------


def _on(source: Query, run: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: run(source(spark, sf_dir))


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return draft.draft_events(proxies.draft_documents(spark, sf_dir))


def _purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return items.item_purchases(proxies.loadout_documents(spark, sf_dir))


def _player_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    players = items.player_rows(proxies.loadout_documents(spark, sf_dir))
    return players.select("hero_id", "name", F.coalesce(F.size("purchase_log"), F.lit(-1)).alias("purchases"))


def _listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.of_leagues(ingest.listing_union(*proxies.listings(spark, sf_dir)), LEAGUE_IDS)


def _new_listing_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    known, listing = proxies.listings(spark, sf_dir)
    return ingest.new_listing_rows(listing, known)


def _new_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    landed_ids = proxies.landed_ids(spark, sf_dir)
    new = ingest.new_documents(ingest.without_landed(proxies.arriving_documents(spark, sf_dir), landed_ids), landed_ids)
    events = F.coalesce(F.size("picks_bans"), F.lit(-1)).alias("events")
    return new.select("match_id", "source_file", events, "radiant_name", "dire_name", "radiant_win")


def _index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The index as several landings leave it: one part of the ids each, some ids in more than one."""
    lines = proxies.table(spark, sf_dir, "lineitem").filter("l_linestatus = 'F'")
    parts = [lines.filter(f"l_linenumber % 3 = {i}").select(F.col("l_orderkey").alias("match_id")) for i in range(3)]
    return landed.index_of(parts[0]).unionByName(landed.index_of(parts[1])).unionByName(landed.index_of(parts[2]))


def _chosen_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`new_documents` in two phases: the choice on names and places, then the documents by their places."""
    staged = proxies.arriving_documents(spark, sf_dir).withColumns(
        {
            "file_named": F.lit(False),
            "content": F.lit(None).cast("string"),
            "staged_file": F.col("_metadata.file_name"),
            "row_index": F.col("_metadata.row_index"),
        }
    )
    narrow = staged.select("match_id", "source_file", "file_named", "content", *landed.PLACE)
    picked = landed.chosen(landed.candidates(narrow), _index(spark, sf_dir))
    return landed.marked(staged, landed.marks(picked)).selectExpr("match_id", "source_file", *_HEADLINE)


_HEADLINE = ("coalesce(size(picks_bans), -1) AS events", "radiant_name", "dire_name", "radiant_win")


def _scratch(spark: SparkSession) -> str:
    """A folder that driver and executors share."""
    base = spark.conf.get("spark.checkpoint.dir", None) or tempfile.mkdtemp(prefix="draftstats-")
    return f"{base.rstrip('/')}/query-{uuid.uuid4().hex}"


def _landed_table(spark: SparkSession, sf_dir: str) -> str:
    """A match table that three landings made of JSON files: one folder, two that overlap, and both again."""
    folder = _scratch(spark)
    docs = proxies.order_documents(spark, sf_dir)
    docs.filter("match_id % 3 = 0").write.json(f"{folder}/json/a")
    docs.filter("match_id % 2 = 0").write.json(f"{folder}/json/b")
    for part in ("a", "*", "*"):
        land_matches(read_matches(spark, f"{folder}/json/{part}"), f"{folder}/matches")
    return f"{folder}/matches"


def _landed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_landed(spark, _landed_table(spark, sf_dir)).selectExpr("match_id", "batch", *_HEADLINE)


def _counts_of_landings(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _landed_table(spark, sf_dir)
    counts_of_landings(spark, table, f"{table}_counts_kept")
    return counts_of_landings(spark, table, f"{table}_counts_kept")


def _listing_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A listing table that two landings made of JSON files, with the whole objects; some fields of these."""
    folder = _scratch(spark)
    for i, listing in enumerate(proxies.listings(spark, sf_dir)):
        details = F.expr("named_struct('id', match_id % 7, 'games', array(match_id, leagueid))")
        listing.withColumn("series", details).write.json(f"{folder}/json/{i}")
        land_listing(read_listing_objects(spark, f"{folder}/json/*"), f"{folder}/listing", LEAGUE_IDS)
    games = F.try_variant_get("listing", "$.series.games[1]", "bigint")
    return read_landed(spark, f"{folder}/listing").select("match_id", "leagueid", games.alias("game"))


def _report(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the draft report on the flat documents, written twice and read back."""
    folder = _scratch(spark)
    for _ in range(2):
        draft_report(proxies.draft_documents(spark, sf_dir), folder)
    return spark.read.parquet(f"{folder}/{name}")


def _log_folder(spark: SparkSession, sf_dir: str) -> str:
    """The event logs as JSON files, a folder per application."""
    folder = _scratch(spark)
    log = proxies.event_log(spark, sf_dir).withColumn("log", F.concat("app_id", F.lit("-0001"))).drop("app_id")
    log.write.partitionBy("log").json(folder)
    return folder


def _percentile_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per application, whether the 99th percentile of its merged sketches has the rank it should, up to its error."""
    rows = _stages(spark, sf_dir).withColumn("day", F.expr("stage_id % 100"))
    parts = stages.duration_sketches(rows, (*BY_APP, "day"))
    p99 = stages.sketched_duration(parts, 0.99, BY_APP)
    ranked = stages.stage_durations(rows).join(p99, [*BY_APP])
    below = F.count_if(F.col("completion_s") <= F.col("percentile_s"))
    return ranked.groupBy(*BY_APP).agg(
        F.max("n").alias("timed_stages"),
        (F.abs(below / F.count("*") - 0.99) <= F.lit(0.002) + 1 / F.count("*")).alias("is_within_error"),
    )


def _stages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stages.stages_from_records(proxies.stage_records(spark, sf_dir))


def _tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stages.tasks_from_records(proxies.task_records(spark, sf_dir))


def _stages_with_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stages.with_task_totals(_stages(spark, sf_dir), _tasks(spark, sf_dir))


def _log_stages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stages.stages_from_log(proxies.event_log(spark, sf_dir))


def _rounded(df: DataFrame) -> DataFrame:
    """Means and percentiles to six places: the two engines add doubles in different orders."""
    return df.select([F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


_COUNTED = {
    "hero_totals": draft.hero_totals,
    "hero_picks": draft.hero_picks,
    "hero_bans": draft.hero_bans,
    "hero_wins": draft.hero_wins,
    "hero_stats_full": lambda events: draft.hero_stats(draft.hero_counts(events)),
    "hero_stats_strict": lambda events: draft.hero_stats(draft.hero_counts(events), draft.STRICT),
    "hero_stats_rolled_up": lambda events: draft.hero_stats(draft.roll_up_heroes(draft.hero_team_counts(events))),
    "draft_counts": draft.draft_counts,
    "team_names": draft.team_names,
    "team_picks_strict": lambda events: draft.team_picks(draft.hero_team_counts(events)),
    "team_picks_full": lambda events: draft.team_picks(draft.hero_team_counts(events), draft.FULL),
    "team_bans": lambda events: draft.team_bans(draft.hero_team_counts(events)),
    "team_stats_full": lambda events: draft.team_stats(draft.hero_team_counts(events)),
}

_PURCHASES = {
    "item_purchases": lambda purchases: purchases,
    "item_totals": items.item_totals,
    "item_first_purchase": items.item_first_purchase,
    "item_stats": items.item_stats,
}

_STAGES = {
    "stage_durations": lambda rows: _rounded(stages.stage_durations(rows)),
    "failed_stages": stages.failed_stages,
    "stage_completion_cdf": lambda rows: stages.completion_cdf(rows, BY_APP),
    "stage_completion_cdf_overall": stages.completion_cdf,
    "stage_completion_cdf_compact": lambda rows: stages.completion_cdf_compact(rows, BY_APP),
}

_LOG_STAGES = {
    "event_log_stages": lambda rows: rows.drop("submitted", "first_launch", "completed"),
    "event_log_durations": lambda rows: _rounded(stages.stage_durations(rows)),
    "event_log_summary": lambda rows: _rounded(stages.stage_summary(rows, BY_APP)),
}


# SQL for the draft queries ---------------------------------------------------

_HEADER = """
  CASE l_suppkey % 25 WHEN 7 THEN NULL WHEN 8 THEN '' WHEN 9 THEN 'a/b'
       ELSE 'TEAM_' || (l_suppkey % 25) END AS radiant_name,
  CASE WHEN l_partkey % 40 <> 3 THEN 'TEAM_' || (l_partkey % 40) END AS dire_name,
  CASE WHEN l_discount < 0.05::double THEN true WHEN l_discount < 0.10::double THEN false END AS radiant_win"""


def _pb_sql(lines: str, first_pick: str, second_pick: str) -> str:
    return f"""
events_of_lines AS (
  SELECT CASE WHEN l_quantity <> 50 THEN l_partkey END AS hero_id, {first_pick} AS is_pick,
         l_linenumber::bigint AS "order", (l_linenumber % 3)::bigint AS team, {_HEADER}
  FROM lineitem WHERE l_tax NOT IN (0.08::double, 0.0::double) AND {lines}
  UNION ALL
  SELECT l_suppkey, {second_pick}, (l_linenumber + 7)::bigint,
         CASE WHEN l_linenumber <> 7 THEN ((l_linenumber + 1) % 2)::bigint END, {_HEADER}
  FROM lineitem WHERE l_tax NOT IN (0.08::double, 0.0::double) AND {lines}),
pb AS (
  SELECT hero_id, is_pick, "order", team, CASE WHEN team = 0 THEN radiant_name ELSE dire_name END AS teamname,
         coalesce((team = 0 AND radiant_win) OR (team = 1 AND NOT radiant_win), false) AS winner
  FROM events_of_lines)"""


_FIRST_PICK = "CASE l_returnflag WHEN 'N' THEN true WHEN 'R' THEN false END"
_SECOND_PICK = "l_linestatus = 'F'"
_PB = _pb_sql("true", _FIRST_PICK, _SECOND_PICK) + """,
totals AS (SELECT hero_id, count(*) AS totals FROM pb GROUP BY hero_id),
bans AS (SELECT hero_id, count(*) AS bans FROM pb WHERE is_pick = false GROUP BY hero_id),
picks AS (SELECT hero_id, count(*) AS picks FROM pb WHERE is_pick = true GROUP BY hero_id),
wins AS (SELECT hero_id, count(*) AS wins FROM pb WHERE is_pick = true AND winner = true GROUP BY hero_id),
team_b AS (SELECT hero_id, teamname, count(*) AS bans FROM pb WHERE is_pick = false GROUP BY hero_id, teamname),
team_p AS (SELECT hero_id, teamname, count(*) AS picks FROM pb WHERE is_pick = true GROUP BY hero_id, teamname),
team_w AS (SELECT hero_id, teamname, count(*) AS wins FROM pb WHERE is_pick = true AND winner = true
           GROUP BY hero_id, teamname)"""

_HERO_FULL_SQL = """
SELECT t.hero_id, totals, coalesce(bans, 0) AS bans, coalesce(picks, 0) AS picks,
       CASE WHEN picks > 0 THEN coalesce(wins, 0) / picks ELSE 0.0::double END AS winrate
FROM totals t LEFT JOIN bans b ON b.hero_id IS NOT DISTINCT FROM t.hero_id
LEFT JOIN picks p ON p.hero_id IS NOT DISTINCT FROM t.hero_id
LEFT JOIN wins w ON w.hero_id IS NOT DISTINCT FROM t.hero_id ORDER BY 1"""

_DRAFT_SQL = {
    "picks_bans_flat": "SELECT * FROM pb",
    "hero_totals": "SELECT * FROM totals",
    "hero_picks": "SELECT * FROM picks",
    "hero_bans": "SELECT * FROM bans",
    "hero_wins": "SELECT * FROM wins",
    "hero_stats_full": _HERO_FULL_SQL,
    "hero_stats_rolled_up": _HERO_FULL_SQL,
    "hero_stats_strict": """
SELECT t.hero_id, totals, bans, picks, winrate
FROM totals t LEFT JOIN bans b ON b.hero_id = t.hero_id
LEFT JOIN (SELECT p.hero_id, picks, wins / picks AS winrate FROM picks p JOIN wins w ON w.hero_id = p.hero_id) r
  ON r.hero_id = t.hero_id ORDER BY 1""",
    "draft_counts": """
SELECT hero_id, NULL AS teamname, 1::bigint AS gid, count(*) AS totals, count(*) FILTER (WHERE NOT is_pick) AS bans,
       count(*) FILTER (WHERE is_pick) AS picks, count(*) FILTER (WHERE is_pick AND winner) AS wins
FROM pb GROUP BY hero_id
UNION ALL
SELECT hero_id, teamname, 0, count(*), count(*) FILTER (WHERE NOT is_pick),
       count(*) FILTER (WHERE is_pick), count(*) FILTER (WHERE is_pick AND winner)
FROM pb GROUP BY hero_id, teamname""",
    "team_names": "SELECT DISTINCT teamname FROM pb",
    "team_picks_strict": """
SELECT p.teamname, p.hero_id, picks, wins / picks AS winrate
FROM team_p p JOIN team_w w ON w.hero_id = p.hero_id AND w.teamname = p.teamname ORDER BY 1, 3 DESC, 2""",
    "team_picks_full": """
SELECT p.teamname, p.hero_id, picks, coalesce(wins, 0) / picks AS winrate
FROM team_p p LEFT JOIN team_w w
  ON w.hero_id IS NOT DISTINCT FROM p.hero_id AND w.teamname IS NOT DISTINCT FROM p.teamname""",
    "team_bans": "SELECT teamname, hero_id, bans FROM team_b WHERE teamname IS NOT NULL ORDER BY 1, 3 DESC, 2",
    "team_stats_full": """
SELECT hero_id, teamname, sum(bans)::bigint AS bans, sum(picks)::bigint AS picks,
       CASE WHEN sum(picks) > 0 THEN sum(wins)::bigint / sum(picks)::bigint ELSE 0.0::double END AS winrate
FROM (SELECT hero_id, teamname, bans, 0 AS picks, 0 AS wins FROM team_b
      UNION ALL SELECT hero_id, teamname, 0, picks, 0 FROM team_p
      UNION ALL SELECT hero_id, teamname, 0, 0, wins FROM team_w)
GROUP BY hero_id, teamname""",
    "one_team_picks": """
SELECT p.teamname, p.hero_id, picks, wins / picks AS winrate
FROM team_p p JOIN team_w w ON w.hero_id = p.hero_id AND w.teamname = p.teamname
WHERE p.teamname = 'TEAM_5' ORDER BY 1, 3 DESC, 2""",
}

# Lines of quantity 48 are cut off; in lines of quantity 49 a pick flag is the
# number 1, which only coercion accepts.
_PLAIN_PB = _pb_sql(
    "l_quantity <> 48",
    "CASE l_returnflag WHEN 'N' THEN CASE WHEN l_quantity <> 49 THEN true END WHEN 'R' THEN false END",
    "CASE WHEN l_linestatus = 'F' THEN CASE WHEN l_quantity <> 49 THEN true END ELSE false END",
) + "," + _pb_sql("l_quantity <> 48", _FIRST_PICK, _SECOND_PICK).replace("events_of_lines", "coerced_lines").replace(
    "pb AS", "coerced AS"
)

_PARSED_SQL = {
    "parsed_picks_bans": "SELECT * FROM pb",
    "coerced_hero_stats": """
SELECT hero_id, count(*) AS totals, count(*) FILTER (WHERE NOT is_pick) AS bans,
       count(*) FILTER (WHERE is_pick) AS picks,
       CASE WHEN count(*) FILTER (WHERE is_pick) > 0
            THEN count(*) FILTER (WHERE is_pick AND winner) / count(*) FILTER (WHERE is_pick)
            ELSE 0.0::double END AS winrate
FROM coerced GROUP BY hero_id""",
}

# Ids of heroes are numbers in all of these lines, so only the flags that are the number 1 stay unread.
_PARSED_SQL["hero_ids_coerced"] = _PARSED_SQL["coerced_hero_stats"].replace("FROM coerced", "FROM pb")

_MALFORMED_SQL = """
SELECT l_orderkey AS match_id, l_quantity = 48 AS whole_line FROM lineitem
WHERE l_quantity = 48
   OR (l_quantity = 49 AND l_tax NOT IN (0.08::double, 0.0::double) AND (l_returnflag = 'N' OR l_linestatus = 'F'))"""

# SQL for the item queries ----------------------------------------------------

_PURCHASED = """
purchases AS (
  SELECT CASE WHEN l_partkey % 50 <> 0 THEN 'item_' || (l_partkey % 300) END AS "key",
         CASE WHEN l_tax <> 0 THEN l_quantity::bigint * 60 - 90 END AS "time" FROM lineitem
  UNION ALL SELECT 'item_' || l_returnflag, l_linenumber::bigint * 100 FROM lineitem
  UNION ALL SELECT 'item_' || (l_suppkey % 90), l_quantity::bigint - 25 FROM lineitem WHERE l_linestatus = 'F')"""

_PURCHASES_SQL = {
    "item_purchases": "SELECT * FROM purchases",
    "item_totals": 'SELECT "key", count(*) AS totals FROM purchases GROUP BY "key"',
    "item_first_purchase": 'SELECT "key", min("time") AS timings FROM purchases GROUP BY "key"',
    "item_stats": """
SELECT t."key", totals, timings
FROM (SELECT "key", count(*) AS totals FROM purchases GROUP BY "key") t
JOIN (SELECT "key", min("time") AS timings FROM purchases GROUP BY "key") f ON f."key" = t."key"
ORDER BY totals DESC, 1""",
}

_PLAYER_ROWS_SQL = """
SELECT l_partkey AS hero_id, 'player_' || l_suppkey AS name, 2 AS purchases FROM lineitem
UNION ALL SELECT l_suppkey, NULL, CASE WHEN l_linestatus = 'F' THEN 1 ELSE -1 END FROM lineitem"""

# SQL for the ingest queries --------------------------------------------------

_LISTING = f"""
lists AS (
  SELECT o_orderkey AS match_id, coalesce({list(LEAGUE_IDS)}[2 * month(o_orderdate)], 1)::bigint AS leagueid,
         o_orderstatus, o_orderpriority FROM orders),
listing AS (
  SELECT match_id, leagueid FROM (
    SELECT match_id, leagueid FROM lists WHERE o_orderstatus <> 'P'
    UNION ALL SELECT match_id, leagueid FROM lists WHERE o_orderpriority < '4')
  WHERE leagueid IN {LEAGUE_IDS})"""

_LISTING_SQL = {
    "listing_union": "SELECT * FROM listing",
    "listing_dedup": "SELECT DISTINCT match_id FROM listing",
    "new_listing_rows": """
SELECT DISTINCT match_id, leagueid FROM lists WHERE o_orderpriority < '4'
EXCEPT SELECT match_id, leagueid FROM lists WHERE o_orderstatus <> 'P'""",
    "pending_matches": """
SELECT DISTINCT match_id FROM listing WHERE NOT EXISTS (
  SELECT 1 FROM lineitem WHERE l_orderkey = match_id AND l_linestatus = 'F')""",
}

_NEW_DOCUMENTS_SQL = f"""
WITH docs AS (
  SELECT l_orderkey AS match_id,
         concat_ws('/', l_linenumber, l_partkey, l_suppkey, l_quantity::int, round(l_tax * 100)::int,
                   round(l_discount * 100)::int, l_returnflag, l_linestatus) AS source_file,
         CASE l_tax WHEN 0.08::double THEN -1 WHEN 0.0::double THEN 0 ELSE 2 END AS events, {_HEADER}
  FROM lineitem),
ranked AS (SELECT *, row_number() OVER (PARTITION BY match_id ORDER BY source_file) AS copy FROM docs)
SELECT match_id, source_file, events, radiant_name, dire_name, radiant_win FROM ranked
WHERE copy = 1 AND NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = match_id AND l_linestatus = 'F')"""

_LANDED_INDEX_SQL = """
SELECT CASE WHEN l_orderkey > 0 THEN 1 + (l_orderkey - 1) // 32768 ELSE -(-l_orderkey // 32768) END AS bucket,
       count(DISTINCT l_orderkey) AS ids
FROM lineitem WHERE l_linestatus = 'F' GROUP BY 1"""

_LANDED = """
docs AS (
  SELECT o_orderkey AS match_id, CASE WHEN o_orderkey % 3 = 0 THEN 0 ELSE 1 END AS batch,
         CASE WHEN o_custkey % 9 <> 0 THEN 'TEAM_' || (o_custkey % 25) END AS radiant_name,
         'TEAM_' || (o_custkey % 40) AS dire_name, o_totalprice > 100000 AS radiant_win,
         o_custkey % 100 AS hero_id, o_orderstatus = 'F' AS is_pick, o_orderkey % 2 AS team
  FROM orders WHERE o_orderkey % 2 = 0 OR o_orderkey % 3 = 0)"""

_LANDED_FILES_SQL = f"WITH {_LANDED} SELECT match_id, batch, 1 AS events, radiant_name, dire_name, radiant_win FROM docs"

_LANDED_COUNTS_SQL = f"""
WITH {_LANDED},
pb AS (SELECT hero_id, is_pick, CASE WHEN team = 0 THEN radiant_name ELSE dire_name END AS teamname,
              radiant_win = (team = 0) AS winner FROM docs)
SELECT hero_id, teamname, count(*) AS totals, count(*) FILTER (WHERE NOT is_pick) AS bans,
       count(*) FILTER (WHERE is_pick) AS picks, count(*) FILTER (WHERE is_pick AND winner) AS wins
FROM pb GROUP BY hero_id, teamname"""

# SQL for the stage and task queries ------------------------------------------

_STAGE = """
e AS (
  SELECT 'app-' || (user_id % 7) AS app_id, user_id * 100 + day(ts) AS stage_id, 0::bigint AS attempt, event_id, ts,
         event_type, floor(value * 100 + 0.5)::bigint AS cents, event_type IN ('view', 'click', 'purchase') AS is_task
  FROM events),
st AS (
  SELECT app_id, stage_id, attempt, CASE WHEN count(*) = 1 THEN 'SKIPPED' ELSE 'COMPLETE' END AS status,
         date_trunc('millisecond', min(ts)) AS submitted, date_trunc('millisecond', max(ts)) AS completed,
         date_trunc('millisecond', min(ts) FILTER (WHERE is_task)) AS launched,
         coalesce(sum(cents) FILTER (WHERE event_type = 'purchase'), 0) AS write_bytes,
         coalesce(sum(cents * 1000) FILTER (WHERE event_type = 'purchase'), 0) AS write_ns,
         coalesce(sum(cents) FILTER (WHERE event_type = 'click'), 0) AS remote_bytes,
         count(*) FILTER (WHERE event_type = 'error') AS failed_tasks
  FROM e GROUP BY ALL),
d AS (
  SELECT *, date_diff('microsecond', submitted, completed) / 1e6 AS completion_s,
         date_diff('microsecond', submitted, launched) / 1e6 AS scheduling_s
  FROM st WHERE status <> 'SKIPPED'),
tk AS (
  SELECT app_id, stage_id, attempt, event_id::varchar AS task_id, cents AS run_ms, cents % 97 AS deserialize_ms
  FROM e WHERE is_task)"""


def _summary_sql(stage: str, timed: str, task: str, group: bool) -> str:
    """The report as separate aggregates: all stages, computed stages, tasks of computed stages."""
    key = "app_id, " if group else ""
    by = "GROUP BY app_id" if group else ""
    on = "ON {0}.app_id = s.app_id" if group else "ON true"
    return f"""
SELECT {"s." if group else ""}{key}computed_stages, skipped_stages, avg_stage_s, p99_stage_s, max_stage_s,
       avg_scheduling_wait_s, avg_task_run_s, avg_task_deserialize_s, coalesce(disk_accesses, 0) AS disk_accesses,
       round(coalesce(disk_accesses, 0) / stages, 6) AS disk_access_fraction,
       round(skipped_stages / stages, 6) AS skipped_fraction,
       coalesce(disk_bytes_written, 0) AS disk_bytes_written, avg_shuffle_write_s,
       coalesce(data_exchanges, 0) AS data_exchanges, coalesce(bytes_exchanged, 0) AS bytes_exchanged
FROM (SELECT {key}count(*) AS stages, count(*) FILTER (WHERE status <> 'SKIPPED') AS computed_stages,
             count(*) FILTER (WHERE status = 'SKIPPED') AS skipped_stages FROM {stage} {by}) s
LEFT JOIN (SELECT {key}round(avg(completion_s), 6) AS avg_stage_s,
             round(quantile_cont(completion_s, 0.99), 6) AS p99_stage_s, round(max(completion_s), 6) AS max_stage_s,
             round(avg(scheduling_s), 6) AS avg_scheduling_wait_s,
             count(*) FILTER (WHERE write_bytes > 0) AS disk_accesses,
             (sum(write_bytes) FILTER (WHERE write_bytes > 0))::bigint AS disk_bytes_written,
             round(avg(write_ns / 1e9) FILTER (WHERE write_bytes > 0), 6) AS avg_shuffle_write_s,
             count(*) FILTER (WHERE remote_bytes > 0) AS data_exchanges,
             (sum(remote_bytes) FILTER (WHERE remote_bytes > 0))::bigint AS bytes_exchanged
           FROM {timed} {by}) d {on.format("d")}
LEFT JOIN (SELECT {key}round(avg(run_ms) / 1000, 6) AS avg_task_run_s,
             round(avg(deserialize_ms) / 1000, 6) AS avg_task_deserialize_s
           FROM {task} SEMI JOIN {timed} USING (app_id, stage_id, attempt) {by}) t {on.format("t")}"""


_STAGES_SQL = {
    "stage_durations": """
SELECT app_id, stage_id, attempt, round(completion_s, 6) AS completion_s, round(scheduling_s, 6) AS scheduling_s
FROM d""",
    "failed_stages": "SELECT app_id, stage_id, attempt, failed_tasks FROM d WHERE failed_tasks > 0",
    "stage_completion_cdf": """
SELECT app_id, completion_s, (row_number() OVER (PARTITION BY app_id ORDER BY completion_s) - 1)
       / count(*) OVER (PARTITION BY app_id) AS cdf FROM d""",
    "stage_completion_cdf_overall": """
SELECT completion_s, (row_number() OVER (ORDER BY completion_s) - 1) / count(*) OVER () AS cdf FROM d""",
    "stage_completion_cdf_compact": """
SELECT app_id, completion_s, count(*) AS stages, min(cdf) AS cdf FROM (
  SELECT app_id, completion_s, (row_number() OVER (PARTITION BY app_id ORDER BY completion_s) - 1)
         / count(*) OVER (PARTITION BY app_id) AS cdf FROM d) GROUP BY app_id, completion_s""",
    "stage_task_totals": """
SELECT s.app_id, s.stage_id, s.attempt, s.status, count(t.task_id) AS timed_tasks,
       coalesce(sum(t.run_ms), 0)::bigint AS run_ms, coalesce(sum(t.deserialize_ms), 0)::bigint AS deserialize_ms
FROM st s LEFT JOIN tk t ON t.app_id = s.app_id AND t.stage_id = s.stage_id AND t.attempt = s.attempt GROUP BY ALL""",
    "stage_summary": _summary_sql("st", "d", "tk", True),
    "stage_summary_overall": _summary_sql("st", "d", "tk", False),
    "stage_percentile_sketch": "SELECT app_id, count(*) AS timed_stages, true AS is_within_error FROM d GROUP BY app_id",
    "task_rows": "SELECT * FROM tk",
    "task_summary": """
SELECT app_id, count(*) AS timed_tasks, round(avg(run_ms) / 1000, 6) AS avg_task_run_s,
       round(avg(deserialize_ms) / 1000, 6) AS avg_task_deserialize_s FROM tk GROUP BY app_id""",
}

_LOG = """
e AS (
  SELECT 'app-' || (user_id % 7) AS app_id, user_id, day(ts) AS attempt, event_type, epoch_us(ts) // 1000 AS ms,
         floor(value * 100 + 0.5)::bigint AS cents FROM events),
attempts AS (
  SELECT app_id, user_id AS stage_id, attempt,
         bool_or(event_type = 'error') AS is_completed, bool_or(event_type = 'error' AND cents % 10 = 0) AS is_failure,
         min(ms) FILTER (WHERE event_type IN ('view', 'error')) AS submitted,
         max(ms + cents) FILTER (WHERE event_type = 'error') AS completed,
         min(ms) FILTER (WHERE event_type IN ('click', 'purchase')) AS launched,
         coalesce(sum(cents) FILTER (WHERE event_type = 'purchase'), 0)::bigint AS write_bytes,
         coalesce(sum(cents * 1000) FILTER (WHERE event_type = 'purchase'), 0)::bigint AS write_ns,
         coalesce(sum(cents) FILTER (WHERE event_type = 'click'), 0)::bigint AS remote_bytes,
         count(*) FILTER (WHERE event_type IN ('click', 'purchase') AND cents % 20 = 0) AS failed_tasks,
         count(*) FILTER (WHERE event_type IN ('click', 'purchase')) AS timed_tasks,
         coalesce(sum(cents) FILTER (WHERE event_type IN ('click', 'purchase')), 0)::bigint AS run_ms,
         coalesce(sum(cents % 97) FILTER (WHERE event_type IN ('click', 'purchase')), 0)::bigint AS deserialize_ms
  FROM e WHERE event_type <> 'signup' GROUP BY ALL),
planned AS (
  SELECT DISTINCT app_id, unnest([user_id, user_id + 1000000]) AS stage_id FROM e WHERE event_type = 'signup'),
st AS (
  SELECT *, CASE WHEN is_failure THEN 'FAILED' WHEN is_completed THEN 'COMPLETE' ELSE 'ACTIVE' END AS status
  FROM attempts
  UNION ALL BY NAME
  SELECT app_id, stage_id, 0::bigint AS attempt, 'SKIPPED' AS status, 0 AS write_bytes, 0 AS write_ns,
         0 AS remote_bytes, 0 AS failed_tasks, 0 AS timed_tasks, 0 AS run_ms, 0 AS deserialize_ms
  FROM planned ANTI JOIN attempts USING (app_id, stage_id)),
d AS (
  SELECT *, (completed - submitted) / 1e3 AS completion_s, (launched - submitted) / 1e3 AS scheduling_s
  FROM st WHERE status <> 'SKIPPED'),
tk AS (
  SELECT app_id, user_id AS stage_id, attempt, cents AS run_ms, cents % 97 AS deserialize_ms
  FROM e WHERE event_type IN ('click', 'purchase'))"""

_LOG_SQL = {
    "event_log_files": """
SELECT app_id || '-0001' AS app_id, stage_id, attempt, status, write_bytes AS shuffle_write_bytes,
       write_ns AS shuffle_write_ns, remote_bytes AS remote_bytes_read, failed_tasks, timed_tasks, run_ms, deserialize_ms
FROM st""",
    "event_log_planned_stages": """
SELECT app_id, stage_id, CASE WHEN app_id IN ('app-0', 'app-1', 'app-2') THEN 'PENDING' ELSE 'SKIPPED' END AS status
FROM planned ANTI JOIN attempts USING (app_id, stage_id)""",
    "event_log_stages": """
SELECT app_id, stage_id, attempt, status, write_bytes AS shuffle_write_bytes, write_ns AS shuffle_write_ns,
       remote_bytes AS remote_bytes_read, failed_tasks, timed_tasks, run_ms, deserialize_ms FROM st""",
    "event_log_durations": """
SELECT app_id, stage_id, attempt, round(completion_s, 6) AS completion_s, round(scheduling_s, 6) AS scheduling_s
FROM d WHERE completion_s IS NOT NULL""",
    "event_log_summary": _summary_sql("st", "d", "tk", True),
    "event_log_task_summary": """
SELECT app_id, count(*) AS timed_tasks, round(avg(run_ms) / 1000, 6) AS avg_task_run_s,
       round(avg(deserialize_ms) / 1000, 6) AS avg_task_deserialize_s FROM tk GROUP BY app_id""",
}
