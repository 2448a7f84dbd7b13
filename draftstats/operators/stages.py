"""Stage and task statistics of finished Spark jobs.

A stage row has: app_id, stage_id, attempt, status, submitted, first_launch,
completed (timestamps), shuffle_write_bytes, shuffle_write_ns,
remote_bytes_read, failed_tasks, timed_tasks, run_ms, deserialize_ms. The key is
(app_id, stage_id, attempt), so a retried stage is as many rows as attempts.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import micros_between, parse_iso, seconds
from . import distribution

STAGE_KEY = ("app_id", "stage_id", "attempt")
SKIPPED, PENDING, ACTIVE, FAILED, COMPLETE = "SKIPPED", "PENDING", "ACTIVE", "FAILED", "COMPLETE"

_SUMS = (
    "stages",
    "pending_stages",
    "computed_stages",
    "timed_stages",
    "launched_stages",
    "scheduling_us",
    "timed_tasks",
    "run_ms",
    "deserialize_ms",
    "disk_accesses",
    "disk_bytes_written",
    "write_ns",
    "data_exchanges",
    "bytes_exchanged",
)


# Stage and task rows from dumped records -------------------------------------


def stages_from_records(records: DataFrame) -> DataFrame:
    """Stage rows of dumped records; the record's own task map gives the task sums."""
    metrics = F.transform(F.map_values("tasks"), lambda task: task.taskMetrics)
    timed = F.filter(metrics, lambda m: m.executorRunTime.isNotNull())

    def total(field: str) -> Column:
        return F.aggregate(timed, F.lit(0).cast("bigint"), lambda acc, m: acc + F.coalesce(m[field], F.lit(0)))

    return records.select(
        *_record_key(),
        "status",
        parse_iso(F.col("submissionTime")).alias("submitted"),
        parse_iso(F.col("firstTaskLaunchedTime")).alias("first_launch"),
        parse_iso(F.col("completionTime")).alias("completed"),
        F.col("shuffleWriteBytes").alias("shuffle_write_bytes"),
        F.col("shuffleWriteTime").alias("shuffle_write_ns"),
        F.col("shuffleRemoteBytesRead").alias("remote_bytes_read"),
        F.col("numFailedTasks").alias("failed_tasks"),
        F.coalesce(F.array_size(timed), F.lit(0)).cast("bigint").alias("timed_tasks"),
        F.coalesce(total("executorRunTime"), F.lit(0)).alias("run_ms"),
        F.coalesce(total("executorDeserializeTime"), F.lit(0)).alias("deserialize_ms"),
    )


def tasks_from_records(records: DataFrame) -> DataFrame:
    """A row per entry of the records' task maps: key columns, task_id, run_ms, deserialize_ms."""
    return records.select(*_record_key(), F.explode("tasks").alias("task_id", "task")).select(
        *STAGE_KEY,
        "task_id",
        F.col("task.taskMetrics.executorRunTime").alias("run_ms"),
        F.col("task.taskMetrics.executorDeserializeTime").alias("deserialize_ms"),
    )


def _record_key() -> list[Column]:
    return [
        F.col("app_id"),
        F.col("stageId").alias("stage_id"),
        F.coalesce("attemptId", F.lit(0)).cast("bigint").alias("attempt"),
    ]


# Stage and task rows from event logs -----------------------------------------


def stages_from_log(events: DataFrame) -> DataFrame:
    """Stage rows of event logs in one pass over the lines.

    A stage that a job planned but that was never submitted is SKIPPED if its
    application ended, by the event that says so in any of its files, else PENDING.
    """
    kind, info, task = F.col("Event"), F.col("`Stage Info`"), F.col("`Task Info`")
    submitted = kind == "SparkListenerStageSubmitted"
    completed = kind == "SparkListenerStageCompleted"
    ended = kind == "SparkListenerTaskEnd"
    write = F.col("`Task Metrics`.`Shuffle Write Metrics`")
    read = F.col("`Task Metrics`.`Shuffle Read Metrics`")
    run_ms = F.col("`Task Metrics`.`Executor Run Time`")

    def in_stage(value: Column) -> Column:
        return F.when(submitted | completed, value)

    def in_task(value: Column) -> Column:
        return F.when(ended, value)

    app_ended = kind == "SparkListenerApplicationEnd"
    lines = events.filter(submitted | completed | ended | app_ended | (kind == "SparkListenerJobStart")).select(
        "app_id",
        app_ended.alias("app_ended"),
        F.explode(
            F.when(kind == "SparkListenerJobStart", F.col("`Stage IDs`"))
            .when(app_ended, F.array(F.lit(None).cast("bigint")))
            .when(ended, F.array("`Stage ID`"))
            .otherwise(F.array(info["Stage ID"]))
        ).alias("stage_id"),
        F.coalesce(in_stage(info["Stage Attempt ID"]), in_task(F.col("`Stage Attempt ID`"))).alias("attempt"),
        completed.alias("is_completed"),
        (completed & info["Failure Reason"].isNotNull()).alias("is_failure"),
        in_stage(info["Submission Time"]).alias("submitted_ms"),
        in_stage(info["Completion Time"]).alias("completed_ms"),
        in_task(task["Launch Time"]).alias("launch_ms"),
        in_task(write["Shuffle Bytes Written"]).alias("write_bytes"),
        in_task(write["Shuffle Write Time"]).alias("write_ns"),
        in_task(read["Remote Bytes Read"]).alias("remote_bytes"),
        (ended & task["Failed"]).alias("task_failed"),
        in_task(run_ms).alias("run_ms"),
        F.when(ended & run_ms.isNotNull(), F.col("`Task Metrics`.`Executor Deserialize Time`")).alias("deserialize_ms"),
    )
    attempts = lines.groupBy(*STAGE_KEY).agg(
        F.max("app_ended").alias("app_ended"),
        F.max("is_completed").alias("is_completed"),
        F.max("is_failure").alias("is_failure"),
        F.timestamp_millis(F.min("submitted_ms")).alias("submitted"),
        F.timestamp_millis(F.min("launch_ms")).alias("first_launch"),
        F.timestamp_millis(F.max("completed_ms")).alias("completed"),
        _sum_or_zero("write_bytes").alias("shuffle_write_bytes"),
        _sum_or_zero("write_ns").alias("shuffle_write_ns"),
        _sum_or_zero("remote_bytes").alias("remote_bytes_read"),
        F.count_if("task_failed").alias("failed_tasks"),
        F.count("run_ms").alias("timed_tasks"),
        _sum_or_zero("run_ms").alias("run_ms"),
        _sum_or_zero("deserialize_ms").alias("deserialize_ms"),
    )
    # A planned stage has no attempt number; it stands for itself only if no
    # attempt of the stage was ever made.
    last_attempt = F.max("attempt").over(Window.partitionBy("app_id", "stage_id"))
    # Always true where the application's end is, which is a row without a stage. It makes both readers need
    # all columns, so they share one pass over the lines.
    whole = F.greatest(*[F.col(c) for c in ("failed_tasks", "timed_tasks", "run_ms", "deserialize_ms")]) >= 0
    whole &= F.greatest("shuffle_write_bytes", "shuffle_write_ns", "remote_bytes_read") >= 0
    whole &= F.coalesce("submitted", "first_launch", "completed").isNull() & ~F.col("is_completed") & ~F.coalesce("is_failure", F.lit(False))
    ends = attempts.filter(F.col("app_ended") & whole).select(F.col("app_id").alias("ended_app"))
    status = (
        F.when(F.col("attempt").isNull() & F.col("ended_app").isNull(), F.lit(PENDING))
        .when(F.col("attempt").isNull(), F.lit(SKIPPED))
        .when(F.col("is_failure"), F.lit(FAILED))
        .when(F.col("is_completed"), F.lit(COMPLETE))
        .otherwise(F.lit(ACTIVE))
    )
    return (
        attempts.filter(~F.col("app_ended"))
        .withColumn("last_attempt", last_attempt)
        .filter("attempt IS NOT NULL OR last_attempt IS NULL")
        .join(ends, F.col("app_id").eqNullSafe(F.col("ended_app")), "left")
        .withColumn("status", status)
        .select(
            "app_id",
            "stage_id",
            F.coalesce("attempt", F.lit(0)).cast("bigint").alias("attempt"),
            "status",
            "submitted",
            "first_launch",
            "completed",
            "shuffle_write_bytes",
            "shuffle_write_ns",
            "remote_bytes_read",
            "failed_tasks",
            "timed_tasks",
            "run_ms",
            "deserialize_ms",
        )
    )


def unread_lines(events: DataFrame) -> DataFrame:
    """(app_id, lines): how many lines of a log are no events."""
    return events.filter(F.col("Event").isNull()).groupBy("app_id").agg(F.count("*").alias("lines"))


def tasks_from_log(events: DataFrame) -> DataFrame:
    """A row per finished task of event logs."""
    return events.filter(F.col("Event") == "SparkListenerTaskEnd").select(
        "app_id",
        F.col("`Stage ID`").alias("stage_id"),
        F.col("`Stage Attempt ID`").alias("attempt"),
        F.col("`Task Info`.`Task ID`").cast("string").alias("task_id"),
        F.col("`Task Metrics`.`Executor Run Time`").alias("run_ms"),
        F.col("`Task Metrics`.`Executor Deserialize Time`").alias("deserialize_ms"),
    )


# Statistics ------------------------------------------------------------------


def with_task_totals(stages: DataFrame, tasks: DataFrame) -> DataFrame:
    """Stage rows with their task sums taken from separately read task rows.

    Tasks are summed per stage before the join; stages without tasks get zeros.
    """
    timed = tasks.filter(F.col("run_ms").isNotNull())
    totals = timed.groupBy(*STAGE_KEY).agg(
        F.count("*").alias("timed_tasks"),
        F.sum("run_ms").alias("run_ms"),
        _sum_or_zero("deserialize_ms").alias("deserialize_ms"),
    )
    sums = ["timed_tasks", "run_ms", "deserialize_ms"]
    return stages.drop(*sums).join(totals, [*STAGE_KEY], "left").fillna(0, sums)


def computed(stages: DataFrame) -> DataFrame:
    """Stages that ran: every status but SKIPPED and PENDING."""
    return stages.filter(_ran())


def stage_durations(stages: DataFrame) -> DataFrame:
    """Key columns, completion_s and scheduling_s of the finished, computed stages."""
    return (
        _timed(computed(stages))
        .filter(F.col("stage_us").isNotNull())
        .select(
            *STAGE_KEY,
            seconds(F.col("stage_us")).alias("completion_s"),
            seconds(F.col("scheduling_us")).alias("scheduling_s"),
        )
    )


def failed_stages(stages: DataFrame) -> DataFrame:
    """Computed stages in which a task failed."""
    return computed(stages).filter("failed_tasks > 0").select(*STAGE_KEY, "failed_tasks")


def task_summary(tasks: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Mean run and deserialize time over all tasks, each task counting once."""
    timed = tasks.filter(F.col("run_ms").isNotNull())
    return timed.groupBy(*by).agg(
        F.count("*").alias("timed_tasks"),
        (F.avg("run_ms") / 1000).alias("avg_task_run_s"),
        (F.avg("deserialize_ms") / 1000).alias("avg_task_deserialize_s"),
    )


def completion_cdf(stages: DataFrame, by: Sequence[str] = (), splits: int = 1) -> DataFrame:
    """(by, completion_s, cdf), a row per finished stage. `splits` is how often crowded durations are split."""
    cdf = distribution.empirical_cdf(_duration_counts(stages, by), by, splits)
    return cdf.select(*by, seconds(F.col("value")).alias("completion_s"), "cdf")


def completion_cdf_compact(stages: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(by, completion_s, stages, cdf) with one row per distinct duration, `cdf` of its first stage."""
    cdf = distribution.empirical_cdf_compact(_duration_counts(stages, by), by)
    return cdf.select(
        *by,
        seconds(F.col("value")).alias("completion_s"),
        F.col("n").alias("stages"),
        (F.col("first") / F.col("total")).alias("cdf"),
    )


def duration_sketches(stages: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(by, sketch) of the durations of finished stages: what may be kept per day, and merged."""
    return distribution.sketches(_timed(computed(stages)), "stage_us", by)


def sketched_duration(sketches: DataFrame, fraction: float, by: Sequence[str] = ()) -> DataFrame:
    """(by, n, percentile_s) of the union of sketches; the rank is within 0.2 % of all."""
    found = distribution.sketched_percentile(distribution.merged_sketches(sketches, by), fraction, by)
    return found.select(*by, "n", seconds(F.col("percentile")).alias("percentile_s"))


def stage_profile(stages: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Every sum the summary needs, per distinct stage duration: the one pass over the stage rows."""
    ran = _ran()
    wrote = ran & (F.col("shuffle_write_bytes") > 0)
    fetched = ran & (F.col("remote_bytes_read") > 0)

    def total(column: str, condition: Column = ran) -> Column:
        return _sum_or_zero(F.when(condition, F.col(column)))

    return (
        _timed(stages)
        .withColumn("stage_us", F.when(ran, F.col("stage_us")))
        .groupBy(*by, "stage_us")
        .agg(
            F.count_if(~F.col("status").eqNullSafe(PENDING)).alias("stages"),
            F.count_if(F.col("status").eqNullSafe(PENDING)).alias("pending_stages"),
            F.count_if(ran).alias("computed_stages"),
            F.count("stage_us").alias("timed_stages"),
            F.count(F.when(ran, F.col("scheduling_us"))).alias("launched_stages"),
            total("scheduling_us").alias("scheduling_us"),
            total("timed_tasks").alias("timed_tasks"),
            total("run_ms").alias("run_ms"),
            total("deserialize_ms").alias("deserialize_ms"),
            F.count_if(wrote).alias("disk_accesses"),
            total("shuffle_write_bytes", wrote).alias("disk_bytes_written"),
            total("shuffle_write_ns", wrote).alias("write_ns"),
            F.count_if(fetched).alias("data_exchanges"),
            total("remote_bytes_read", fetched).alias("bytes_exchanged"),
        )
    )


def summary_of_profile(profile: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The job report: one row per group, or exactly one row when `by` is empty.

    Fractions are of all stages, skipped ones included; stages that are only
    pending are none yet. Means, percentile and
    maximum are null where nothing was measured; counts and byte sums are 0.
    """
    # Always true, as every row counts a stage. It makes each reader below need
    # all columns, so they share one exchange of the profile instead of pruning
    # it in different ways and scanning the stages again.
    profile = profile.filter(F.greatest(*_SUMS) > 0)
    sums = profile.groupBy(*by).agg(
        *[_sum_or_zero(c).alias(c) for c in _SUMS],
        F.sum(F.col("stage_us") * F.col("timed_stages")).alias("total_us"),
        F.max("stage_us").alias("max_us"),
    )
    p99 = distribution.exact_percentile(
        profile.filter("timed_stages > 0").select(
            *by, F.col("stage_us").alias("value"), F.col("timed_stages").alias("n")
        ),
        0.99,
        by,
    ).withColumnRenamed("percentile", "p99_us")
    # The parts have one row per group each: lining them up by union needs no
    # join, and keeps the single row when nothing is grouped.
    parts = sums.unionByName(p99, allowMissingColumns=True)
    row = parts.groupBy(*by).agg(*[F.max(c).alias(c) for c in (*_SUMS, "total_us", "max_us", "p99_us")])

    def mean(total: str, count: str, unit: float) -> Column:
        return F.try_divide(F.col(total), F.col(count)) / F.lit(unit)

    def fraction(count: Column) -> Column:
        return F.try_divide(count, F.col("stages"))

    skipped = F.col("stages") - F.col("computed_stages")
    return row.select(
        *by,
        "computed_stages",
        skipped.alias("skipped_stages"),
        mean("total_us", "timed_stages", 1e6).alias("avg_stage_s"),
        seconds(F.col("p99_us")).alias("p99_stage_s"),
        seconds(F.col("max_us")).alias("max_stage_s"),
        mean("scheduling_us", "launched_stages", 1e6).alias("avg_scheduling_wait_s"),
        mean("run_ms", "timed_tasks", 1e3).alias("avg_task_run_s"),
        mean("deserialize_ms", "timed_tasks", 1e3).alias("avg_task_deserialize_s"),
        "disk_accesses",
        fraction(F.col("disk_accesses")).alias("disk_access_fraction"),
        fraction(skipped).alias("skipped_fraction"),
        "disk_bytes_written",
        mean("write_ns", "disk_accesses", 1e9).alias("avg_shuffle_write_s"),
        "data_exchanges",
        "bytes_exchanged",
    )


def stage_summary(stages: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """`summary_of_profile` of `stage_profile`."""
    return summary_of_profile(stage_profile(stages, by), by)


def _ran() -> Column:
    return ~(F.col("status").eqNullSafe(SKIPPED) | F.col("status").eqNullSafe(PENDING))


def _timed(stages: DataFrame) -> DataFrame:
    return stages.withColumns(
        {
            "stage_us": micros_between(F.col("submitted"), F.col("completed")),
            "scheduling_us": micros_between(F.col("submitted"), F.col("first_launch")),
        }
    )


def _duration_counts(stages: DataFrame, by: Sequence[str]) -> DataFrame:
    return distribution.value_counts(_timed(computed(stages)), "stage_us", by)


def _sum_or_zero(column: str | Column) -> Column:
    return F.coalesce(F.sum(column), F.lit(0))
