"""Match-, listing- and job-shaped relations derived from the star-schema tables.

There is no public match data to test on, so a line item stands for a match
document and an event for a task. Documents are built from one row each, never
by collecting a group: the derivation is a projection of the scan without any
exchange, and no array grows with the data.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import MATCH, STAGE_RECORD
from .leagues import LEAGUE_IDS

# A line gives a document with two events, or with none (empty or null array).
PICKS_BANS = """
CASE l_tax WHEN 0.08D THEN NULL
           WHEN 0.0D THEN array()
           ELSE array(
    named_struct(
        'hero_id', CASE WHEN l_quantity <> 50 THEN l_partkey END,
        'is_pick', CASE l_returnflag WHEN 'N' THEN true WHEN 'R' THEN false END,
        'order', CAST(l_linenumber AS bigint),
        'team', CAST(l_linenumber % 3 AS bigint)),
    named_struct(
        'hero_id', l_suppkey,
        'is_pick', l_linestatus = 'F',
        'order', CAST(l_linenumber + 7 AS bigint),
        'team', CASE WHEN l_linenumber <> 7 THEN CAST((l_linenumber + 1) % 2 AS bigint) END))
END"""
RADIANT_NAME = """
CASE l_suppkey % 25 WHEN 7 THEN NULL
                    WHEN 8 THEN ''
                    WHEN 9 THEN 'a/b'
                    ELSE concat('TEAM_', CAST(l_suppkey % 25 AS string)) END"""
DIRE_NAME = "CASE WHEN l_partkey % 40 <> 3 THEN concat('TEAM_', CAST(l_partkey % 40 AS string)) END"
RADIANT_WIN = "CASE WHEN l_discount < 0.05D THEN true WHEN l_discount < 0.10D THEN false END"

# Two players, the second sometimes without a purchase log.
PLAYERS = """
array(
    named_struct(
        'purchase_log', array(
            named_struct(
                'time', CASE WHEN l_tax <> 0 THEN CAST(l_quantity * 60 AS bigint) - 90 END,
                'key', CASE WHEN l_partkey % 50 <> 0 THEN concat('item_', CAST(l_partkey % 300 AS string)) END),
            named_struct(
                'time', CAST(l_linenumber * 100 AS bigint),
                'key', concat('item_', l_returnflag))),
        'name', concat('player_', CAST(l_suppkey AS string)), 'hero_id', l_partkey),
    named_struct(
        'purchase_log', CASE WHEN l_linestatus = 'F' THEN array(
            named_struct(
                'time', CAST(l_quantity AS bigint) - 25,
                'key', concat('item_', CAST(l_suppkey % 90 AS string)))) END,
        'name', CAST(NULL AS string), 'hero_id', l_suppkey))"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def draft_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """match_id, picks_bans and the header fields."""
    return table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey AS match_id",
        f"{PICKS_BANS} AS picks_bans",
        f"{RADIANT_NAME} AS radiant_name",
        f"{DIRE_NAME} AS dire_name",
        f"{RADIANT_WIN} AS radiant_win",
    )


def arriving_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Draft documents with a source file: the lines of an order are copies of one match.

    The file is named after everything the document depends on, so copies from
    the same file are equal.
    """
    return table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey AS match_id",
        """concat_ws('/', l_linenumber, l_partkey, l_suppkey, CAST(l_quantity AS int), CAST(round(l_tax * 100) AS int),
                     CAST(round(l_discount * 100) AS int), l_returnflag, l_linestatus) AS source_file""",
        f"{PICKS_BANS} AS picks_bans",
        f"{RADIANT_NAME} AS radiant_name",
        f"{DIRE_NAME} AS dire_name",
        f"{RADIANT_WIN} AS radiant_win",
    )


def order_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Draft documents of one event with an id of their own: an order is a match."""
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS match_id",
        """array(named_struct('hero_id', CAST(o_custkey % 100 AS bigint), 'is_pick', o_orderstatus = 'F',
                              'order', 0L, 'team', CAST(o_orderkey % 2 AS bigint))) AS picks_bans""",
        "CASE WHEN o_custkey % 9 <> 0 THEN concat('TEAM_', CAST(o_custkey % 25 AS string)) END AS radiant_name",
        "concat('TEAM_', CAST(o_custkey % 40 AS string)) AS dire_name",
        "o_totalprice > 100000 AS radiant_win",
    )


def loadout_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """match_id and players."""
    return table(spark, sf_dir, "lineitem").selectExpr("l_orderkey AS match_id", f"{PLAYERS} AS players")


def document_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON text of the draft documents, some of it damaged.

    Lines of quantity 49 write their pick flags as 1, lines of quantity 48 are
    cut off at the end.
    """
    event_type = MATCH["picks_bans"].dataType.simpleString()
    text = F.to_json(
        F.struct(
            F.expr(f"CAST({PICKS_BANS} AS {event_type})").alias("picks_bans"),
            F.expr(RADIANT_NAME).alias("radiant_name"),
            F.expr(DIRE_NAME).alias("dire_name"),
            F.expr(RADIANT_WIN).alias("radiant_win"),
        )
    )
    quantity = F.col("l_quantity")
    damaged = (
        F.when(quantity == 49, F.replace(text, F.lit('"is_pick":true'), F.lit('"is_pick":1')))
        .when(quantity == 48, F.substr(text, F.lit(1), F.length(text) - 1))
        .otherwise(text)
    )
    return table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("match_id"), damaged.alias("value"))


def listings(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Two overlapping match lists. Each month is a league; the last two are not in the default list."""
    orders = table(spark, sf_dir, "orders")
    ids = ", ".join(str(i) for i in LEAGUE_IDS)
    league = f"CAST(coalesce(get(array({ids}), 2 * month(o_orderdate) - 1), 1) AS bigint) AS leagueid"
    return [
        orders.filter("o_orderstatus <> 'P'").selectExpr("o_orderkey AS match_id", league),
        orders.filter("o_orderpriority < '4'").selectExpr("o_orderkey AS match_id", league),
    ]


def landed_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Matches with at least one shipped line count as landed."""
    return table(spark, sf_dir, "lineitem").filter("l_linestatus = 'F'").selectExpr("l_orderkey AS match_id")


# A user's day is a stage: of its events, views, clicks and purchases are tasks.
_STAGE = "user_id * 100 + day(ts)"
_CENTS = "CAST(floor(value * 100 + 0.5D) AS bigint)"
_IS_TASK = "event_type IN ('view', 'click', 'purchase')"
_ISO = "yyyy-MM-dd'T'HH:mm:ss.SSS'GMT'"


def stage_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dumped stage records, without their task maps. Days of one event are skipped stages."""
    return (
        table(spark, sf_dir, "events")
        .selectExpr(
            "concat('app-', CAST(user_id % 7 AS string)) AS app_id",
            f"{_STAGE} AS stageId",
            "ts",
            "event_type",
            f"{_CENTS} AS cents",
            f"{_IS_TASK} AS is_task",
        )
        .groupBy("app_id", "stageId")
        .agg(
            F.expr("CASE WHEN count(*) = 1 THEN 'SKIPPED' ELSE 'COMPLETE' END").alias("status"),
            F.date_format(F.min("ts"), _ISO).alias("submissionTime"),
            F.date_format(F.expr("min(ts) FILTER (WHERE is_task)"), _ISO).alias("firstTaskLaunchedTime"),
            F.date_format(F.max("ts"), _ISO).alias("completionTime"),
            F.expr("coalesce(sum(cents) FILTER (WHERE event_type = 'purchase'), 0)").alias("shuffleWriteBytes"),
            F.expr("coalesce(sum(cents * 1000) FILTER (WHERE event_type = 'purchase'), 0)").alias("shuffleWriteTime"),
            F.expr("coalesce(sum(cents) FILTER (WHERE event_type = 'click'), 0)").alias("shuffleRemoteBytesRead"),
            F.expr("count_if(event_type = 'error')").alias("numFailedTasks"),
        )
        .withColumn("attemptId", F.lit(0).cast("bigint"))
        .withColumn("tasks", F.lit(None).cast(STAGE_RECORD["tasks"].dataType))
    )


def task_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dumped stage records that hold one task each, as a map from task id to metrics."""
    return table(spark, sf_dir, "events").filter(_IS_TASK).selectExpr(
        "concat('app-', CAST(user_id % 7 AS string)) AS app_id",
        f"{_STAGE} AS stageId",
        "CAST(0 AS bigint) AS attemptId",
        f"""map(CAST(event_id AS string), named_struct('taskMetrics', named_struct(
              'executorRunTime', {_CENTS}, 'executorDeserializeTime', {_CENTS} % 97))) AS tasks""",
    )


def event_log(spark: SparkSession, sf_dir: str, unfinished: int = 0) -> DataFrame:
    """Event-log lines, one per event: a user is a stage, a day an attempt of it.

    signup plans the user's stage and one more that never runs, view submits,
    error completes, click and purchase end a task. Applications that plan
    anything end, but for the first `unfinished`.
    """
    events = table(spark, sf_dir, "events")
    lines = (
        events
        .withColumn("ms", F.expr("unix_millis(CAST(ts AS timestamp))"))
        .withColumn("cents", F.expr(_CENTS))
        .selectExpr(
            "concat('app-', CAST(user_id % 7 AS string)) AS app_id",
            """CASE event_type WHEN 'signup' THEN 'SparkListenerJobStart'
                               WHEN 'view' THEN 'SparkListenerStageSubmitted'
                               WHEN 'error' THEN 'SparkListenerStageCompleted'
                               ELSE 'SparkListenerTaskEnd' END AS Event""",
            "CASE WHEN event_type = 'signup' THEN array(user_id, user_id + 1000000) END AS `Stage IDs`",
            "CASE WHEN event_type IN ('click', 'purchase') THEN user_id END AS `Stage ID`",
            "CASE WHEN event_type IN ('click', 'purchase') THEN CAST(day(ts) AS bigint) END AS `Stage Attempt ID`",
            """CASE WHEN event_type IN ('view', 'error') THEN named_struct(
                 'Stage ID', user_id,
                 'Stage Attempt ID', CAST(day(ts) AS bigint),
                 'Submission Time', ms,
                 'Completion Time', CASE WHEN event_type = 'error' THEN ms + cents END,
                 'Failure Reason', CASE WHEN event_type = 'error' AND cents % 10 = 0 THEN 'lost' END)
               END AS `Stage Info`""",
            """CASE WHEN event_type IN ('click', 'purchase') THEN named_struct(
                 'Task ID', event_id, 'Launch Time', ms, 'Failed', cents % 20 = 0) END AS `Task Info`""",
            """CASE WHEN event_type IN ('click', 'purchase') THEN named_struct(
                 'Executor Run Time', cents,
                 'Executor Deserialize Time', cents % 97,
                 'Shuffle Read Metrics', named_struct(
                   'Remote Bytes Read', CASE event_type WHEN 'click' THEN cents ELSE 0 END),
                 'Shuffle Write Metrics', named_struct(
                   'Shuffle Bytes Written', CASE event_type WHEN 'purchase' THEN cents ELSE 0 END,
                   'Shuffle Write Time', CASE event_type WHEN 'purchase' THEN cents * 1000 ELSE 0 END))
               END AS `Task Metrics`""",
        )
    )
    ends = events.filter(f"event_type = 'signup' AND user_id % 7 >= {unfinished}").selectExpr(
        "concat('app-', CAST(user_id % 7 AS string)) AS app_id", "'SparkListenerApplicationEnd' AS Event"
    )
    return lines.unionByName(ends, allowMissingColumns=True)
