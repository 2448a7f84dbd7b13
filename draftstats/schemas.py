"""Declared schemas. Every file scan uses one of these; nothing is inferred."""

from pyspark.sql import types as T

CORRUPT = "_corrupt_record"


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in fields.items()])


def with_corrupt(schema: T.StructType) -> T.StructType:
    """The schema plus the column in which a permissive scan keeps unreadable text."""
    return T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])


DRAFT_EVENT = _struct(
    hero_id=T.LongType(),
    is_pick=T.BooleanType(),
    order=T.LongType(),
    team=T.LongType(),
)

# The same event with the coercible fields left as text, for documents that
# quote their numbers (`"12"`) or write flags as 0 / 1.
DRAFT_EVENT_TEXT = _struct(
    hero_id=T.StringType(),
    is_pick=T.StringType(),
    order=T.StringType(),
    team=T.StringType(),
)

# Only the hero's id left as text.
DRAFT_EVENT_TEXT_ID = _struct(
    hero_id=T.StringType(),
    is_pick=T.BooleanType(),
    order=T.LongType(),
    team=T.LongType(),
)

PURCHASE = _struct(time=T.LongType(), key=T.StringType())

PLAYER = _struct(
    purchase_log=T.ArrayType(PURCHASE),
    name=T.StringType(),
    hero_id=T.LongType(),
    pings=T.LongType(),
    kills=T.LongType(),
    deaths=T.LongType(),
    assists=T.LongType(),
    net_worth=T.LongType(),
)


def _match(event: T.StructType) -> T.StructType:
    return _struct(
        match_id=T.LongType(),
        picks_bans=T.ArrayType(event),
        radiant_name=T.StringType(),
        dire_name=T.StringType(),
        radiant_win=T.BooleanType(),
        players=T.ArrayType(PLAYER),
    )


MATCH = _match(DRAFT_EVENT)
MATCH_TEXT_EVENTS = _match(DRAFT_EVENT_TEXT)
MATCH_TEXT_IDS = _match(DRAFT_EVENT_TEXT_ID)

LISTING = _struct(match_id=T.LongType(), leagueid=T.LongType())

# One stage of a finished job as the monitoring service dumps it.
TASK_RECORD = _struct(
    taskMetrics=_struct(executorRunTime=T.LongType(), executorDeserializeTime=T.LongType()),
)
STAGE_RECORD = _struct(
    status=T.StringType(),
    stageId=T.LongType(),
    attemptId=T.LongType(),
    submissionTime=T.StringType(),
    firstTaskLaunchedTime=T.StringType(),
    completionTime=T.StringType(),
    shuffleWriteBytes=T.LongType(),
    shuffleWriteTime=T.LongType(),
    shuffleRemoteBytesRead=T.LongType(),
    numFailedTasks=T.LongType(),
    tasks=T.MapType(T.StringType(), TASK_RECORD),
)

# Union of the Spark event-log line kinds that describe stages and tasks. Field
# names are those of the log, spaces included.
EVENT_LOG = T.StructType(
    [
        T.StructField("Event", T.StringType()),
        T.StructField("Stage IDs", T.ArrayType(T.LongType())),
        T.StructField("Stage ID", T.LongType()),
        T.StructField("Stage Attempt ID", T.LongType()),
        T.StructField(
            "Stage Info",
            _struct(
                **{
                    "Stage ID": T.LongType(),
                    "Stage Attempt ID": T.LongType(),
                    "Submission Time": T.LongType(),
                    "Completion Time": T.LongType(),
                    "Failure Reason": T.StringType(),
                }
            ),
        ),
        T.StructField(
            "Task Info",
            _struct(
                **{
                    "Task ID": T.LongType(),
                    "Launch Time": T.LongType(),
                    "Failed": T.BooleanType(),
                }
            ),
        ),
        T.StructField(
            "Task Metrics",
            _struct(
                **{
                    "Executor Run Time": T.LongType(),
                    "Executor Deserialize Time": T.LongType(),
                    "Shuffle Read Metrics": _struct(**{"Remote Bytes Read": T.LongType()}),
                    "Shuffle Write Metrics": _struct(
                        **{"Shuffle Bytes Written": T.LongType(), "Shuffle Write Time": T.LongType()}
                    ),
                }
            ),
        ),
    ]
)
