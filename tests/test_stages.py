import json
import math
import os
import subprocess
import sys
import textwrap

import pytest
from conftest import rows
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from draftstats.functions import parse_iso
from draftstats.operators import stages
from draftstats.schemas import STAGE_RECORD
from draftstats.sources import proxies, read_event_log, read_stage_records

START = "2025-05-06T10:00:00.000GMT"


def record(stage, status, launched=None, completed=None, written=None, write_ns=None, remote=None, failed=None, tasks=()):
    return {
        "status": status,
        "stageId": stage,
        "attemptId": 0,
        "submissionTime": START,
        "firstTaskLaunchedTime": launched,
        "completionTime": completed,
        "shuffleWriteBytes": written,
        "shuffleWriteTime": write_ns,
        "shuffleRemoteBytesRead": remote,
        "numFailedTasks": failed,
        "tasks": {
            str(10 * stage + i): {"taskMetrics": {"executorRunTime": run, "executorDeserializeTime": deserialize}}
            for i, (run, deserialize) in enumerate(tasks)
        },
    }


RECORDS = [
    record(0, "SKIPPED"),
    record(1, "COMPLETE", "2025-05-06T10:00:00.500GMT", "2025-05-06T10:00:02.000GMT", 100, 2_000_000, 0, 0, [(100, 10), (300, 30)]),
    record(2, "COMPLETE", "2025-05-06T10:00:01.000GMT", "2025-05-06T10:00:10.000GMT", 0, 0, 50, 0, [(200, 20)]),
    record(3, "FAILED", "2025-05-06T10:00:00.000GMT", "2025-05-07T10:00:01.500GMT", 300, 4_000_000, 70, 1, [(400, 40)]),
]
SUMMARY = {
    "computed_stages": 3,
    "skipped_stages": 1,
    "avg_stage_s": 28804.5,
    "p99_stage_s": 84673.67,
    "max_stage_s": 86401.5,
    "avg_scheduling_wait_s": 0.5,
    "avg_task_run_s": 0.25,
    "avg_task_deserialize_s": 0.025,
    "disk_accesses": 2,
    "disk_access_fraction": 0.5,
    "skipped_fraction": 0.25,
    "disk_bytes_written": 400,
    "avg_shuffle_write_s": 0.003,
    "data_exchanges": 2,
    "bytes_exchanged": 120,
}


@pytest.fixture(scope="module")
def records(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("records")
    (folder / "app-20250506174016-0000.json").write_text(json.dumps(RECORDS, indent=1))
    return read_stage_records(spark, str(folder), multi_line=True).cache()


@pytest.fixture(scope="module")
def stage_rows(records):
    return stages.stages_from_records(records)


def test_stage_and_task_rows(records, stage_rows):
    assert {r.app_id for r in stage_rows.collect()} == {"app-20250506174016-0000"}
    assert rows(stage_rows.select("stage_id", "timed_tasks", "run_ms", "deserialize_ms")) == [
        (0, 0, 0, 0),
        (1, 2, 400, 40),
        (2, 1, 200, 20),
        (3, 1, 400, 40),
    ]
    tasks = stages.tasks_from_records(records)
    assert rows(tasks.select("stage_id", "task_id", "run_ms", "deserialize_ms")) == [
        (1, "10", 100, 10),
        (1, "11", 300, 30),
        (2, "20", 200, 20),
        (3, "30", 400, 40),
    ]


def test_summary(stage_rows):
    row = stages.stage_summary(stage_rows).first().asDict()
    assert list(row) == list(SUMMARY)
    assert row == pytest.approx(SUMMARY)
    grouped = stages.stage_summary(stage_rows, ["app_id"]).first().asDict()
    assert grouped == pytest.approx({"app_id": "app-20250506174016-0000", **SUMMARY})


def test_durations_keep_whole_days(stage_rows):
    durations = stages.stage_durations(stage_rows).select("stage_id", "completion_s", "scheduling_s")
    assert rows(durations) == [(1, 2.0, 0.5), (2, 10.0, 1.0), (3, 86401.5, 0.0)]


def test_durations_keep_their_sign(spark):
    early = record(1, "COMPLETE", START, "2025-05-06T09:59:58.500GMT")
    df = spark.createDataFrame([early], STAGE_RECORD).withColumn("app_id", F.lit("a"))
    assert stages.stage_durations(stages.stages_from_records(df)).first().completion_s == -1.5


def test_cdf_and_failed_stages(stage_rows):
    assert rows(stages.completion_cdf(stage_rows)) == [(2.0, 0.0), (10.0, 1 / 3), (86401.5, 2 / 3)]
    assert rows(stages.completion_cdf_compact(stage_rows)) == [(2.0, 1, 0.0), (10.0, 1, 1 / 3), (86401.5, 1, 2 / 3)]
    assert rows(stages.failed_stages(stage_rows).select("stage_id", "failed_tasks")) == [(3, 1)]


def test_task_summary_weighs_tasks_not_stages(records):
    row = stages.task_summary(stages.tasks_from_records(records)).first()
    assert (row.timed_tasks, row.avg_task_run_s, row.avg_task_deserialize_s) == (4, 0.25, 0.025)


def test_tasks_read_separately_give_the_same_totals(records, stage_rows):
    joined = stages.with_task_totals(stage_rows.drop("timed_tasks", "run_ms", "deserialize_ms"), stages.tasks_from_records(records))
    assert rows(joined.select(sorted(joined.columns))) == rows(stage_rows.select(sorted(stage_rows.columns)))


@pytest.mark.parametrize("kept, skipped", [([], None), (RECORDS[:1], 1.0)])
def test_nothing_ran(spark, kept, skipped):
    df = spark.createDataFrame(kept, STAGE_RECORD).withColumn("app_id", F.lit("a"))
    stage_rows = stages.stages_from_records(df)
    row = stages.stage_summary(stage_rows).first().asDict()
    zero = {"computed_stages", "disk_accesses", "disk_bytes_written", "data_exchanges", "bytes_exchanged"}
    assert all(row[c] == 0 for c in zero) and row["skipped_stages"] == len(kept)
    assert row["skipped_fraction"] == skipped and row["disk_access_fraction"] == (0.0 if kept else None)
    assert all(row[c] is None for c in row if c.startswith(("avg_", "p99_", "max_")))
    assert rows(stages.completion_cdf(stage_rows)) == []
    assert stages.task_summary(stages.tasks_from_records(df)).first().avg_task_run_s is None


def test_running_stage_counts_but_has_no_duration(spark):
    df = spark.createDataFrame([record(1, "ACTIVE", START), RECORDS[1]], STAGE_RECORD).withColumn("app_id", F.lit("a"))
    row = stages.stage_summary(stages.stages_from_records(df)).first()
    assert (row.computed_stages, row.avg_stage_s) == (2, 2.0)


def test_iso_timestamps(spark):
    texts = [START, "2025-05-06T10:00:00.123456UTC", "2025-05-06T10:00:00GMT", "2025-05-06 10:00", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(F.unix_micros(parse_iso(F.col("t"))).alias("us"))
    base = 1746525600_000000
    assert [r.us for r in df.collect()] == [base, base + 123456, base, None, None]


# Event logs ------------------------------------------------------------------


def log_line(kind, **fields):
    return json.dumps({"Event": f"SparkListener{kind}", **{k.replace("_", " "): v for k, v in fields.items()}})


def stage_info(stage, attempt, submitted=None, completed=None, reason=None):
    info = {"Stage ID": stage, "Stage Attempt ID": attempt, "Submission Time": submitted, "Completion Time": completed}
    return {k: v for k, v in {**info, "Failure Reason": reason}.items() if v is not None}


def task_end(stage, attempt, task, launch, run, failed=False, written=0, remote=0):
    return log_line(
        "TaskEnd",
        Stage_ID=stage,
        Stage_Attempt_ID=attempt,
        Task_Info={"Task ID": task, "Launch Time": launch, "Failed": failed},
        Task_Metrics={
            "Executor Run Time": run,
            "Executor Deserialize Time": run // 10,
            "Shuffle Read Metrics": {"Remote Bytes Read": remote},
            "Shuffle Write Metrics": {"Shuffle Bytes Written": written, "Shuffle Write Time": written * 1000},
        },
    )


@pytest.fixture(scope="module")
def log_rows(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("log")
    lines = [
        log_line("LogStart", Spark_Version="4.1.2"),
        log_line("JobStart", Job_ID=0, Stage_IDs=[0, 1, 2]),
        log_line("StageSubmitted", Stage_Info=stage_info(1, 0, 1000)),
        task_end(1, 0, 1, 1500, 100, written=10),
        task_end(1, 0, 2, 1400, 300, failed=True),
        log_line("StageCompleted", Stage_Info=stage_info(1, 0, 1000, 3000, "fetch failed")),
        log_line("StageSubmitted", Stage_Info=stage_info(1, 1, 4000)),
        task_end(1, 1, 3, 4000, 500, written=20),
        log_line("StageCompleted", Stage_Info=stage_info(1, 1, 4000, 4500)),
        log_line("StageSubmitted", Stage_Info=stage_info(2, 0, 5000)),
        task_end(2, 0, 4, 5100, 50, remote=30),
        log_line("JobEnd", Job_ID=0),
        log_line("ApplicationEnd", Timestamp=9000),
    ]
    (folder / "application_17_0001_1").write_text("\n".join(lines))
    return read_event_log(spark, str(folder)).cache()


def test_log_stages(log_rows):
    found = stages.stages_from_log(log_rows)
    columns = ["stage_id", "attempt", "status", "failed_tasks", "timed_tasks", "run_ms", "shuffle_write_bytes", "remote_bytes_read"]
    assert rows(found.select(columns)) == [
        (0, 0, "SKIPPED", 0, 0, 0, 0, 0),
        (1, 0, "FAILED", 1, 2, 400, 10, 0),
        (1, 1, "COMPLETE", 0, 1, 500, 20, 0),
        (2, 0, "ACTIVE", 0, 1, 50, 0, 30),
    ]
    assert {r.app_id for r in found.collect()} == {"application_17_0001_1"}
    assert rows(stages.stage_durations(found).select("stage_id", "attempt", "completion_s", "scheduling_s")) == [
        (1, 0, 2.0, 0.4),
        (1, 1, 0.5, 0.0),
    ]


def test_each_attempt_counts_its_own_tasks(log_rows):
    tasks = stages.tasks_from_log(log_rows)
    assert rows(tasks.groupBy("stage_id", "attempt").count()) == [(1, 0, 2), (1, 1, 1), (2, 0, 1)]
    row = stages.stage_summary(stages.stages_from_log(log_rows)).first()
    assert (row.computed_stages, row.skipped_stages, row.disk_accesses, row.data_exchanges) == (3, 1, 2, 1)
    assert row.avg_task_run_s == stages.task_summary(tasks).first().avg_task_run_s == pytest.approx(0.2375)


def test_log_and_records_give_the_same_kind_of_row(log_rows, stage_rows):
    assert stages.stages_from_log(log_rows).dtypes == stage_rows.dtypes


@pytest.mark.parametrize("rolling, compress", [("false", "false"), ("true", "false"), ("true", "true")])
def test_log_of_a_real_run(spark, tmp_path, rolling, compress):
    program = textwrap.dedent(
        f"""
        from pyspark.sql import SparkSession, functions as F
        spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
                 .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", {str(tmp_path)!r})
                 .config("spark.eventLog.compress", "{compress}").config("spark.eventLog.rolling.enabled", "{rolling}")
                 .config("spark.sql.adaptive.enabled", "false").config("spark.sql.shuffle.partitions", "3").getOrCreate())
        counts = spark.sparkContext.parallelize(range(100), 4).map(lambda x: (x % 5, 1)).reduceByKey(lambda a, b: a + b)
        counts.count()
        counts.count()
        spark.stop()
        """
    )
    subprocess.run([sys.executable, "-c", program], check=True, timeout=180, env=os.environ, capture_output=True)
    log = read_event_log(spark, str(tmp_path), compressed=compress == "true")
    found = stages.stages_from_log(log)
    assert all(r.app_id.startswith("local-") for r in found.collect())
    row = stages.stage_summary(found).first()
    # The second count finds the shuffle of the first one and skips its map stage.
    assert (row.computed_stages, row.skipped_stages) == (3, 1)
    assert row.disk_accesses == 1 and row.disk_bytes_written > 0
    assert row.avg_stage_s > 0 and math.isclose(row.skipped_fraction, 0.25)
    assert stages.tasks_from_log(log).count() == 12


def test_compressed_log_is_refused(spark, tmp_path):
    (tmp_path / "events_1_local-123.zstd").write_bytes(b"\x28\xb5\x2f\xfd garbage")
    with pytest.raises((PySparkException, Py4JJavaError), match="compressed event log"):
        stages.task_summary(stages.tasks_from_log(read_event_log(spark, str(tmp_path)))).collect()


def test_one_stage_with_most_tasks(spark, sf_dir):
    tasks = stages.tasks_from_records(proxies.task_records(spark, sf_dir))
    hot = tasks.withColumn("stage_id", F.when(F.col("run_ms") % 3 == 0, 1).otherwise(F.col("stage_id")))
    keys = hot.select(*stages.STAGE_KEY).distinct().withColumn("status", F.lit("COMPLETE"))
    totals = stages.with_task_totals(keys, hot)
    assert totals.agg(F.sum("timed_tasks")).first()[0] == tasks.count()


def stage_log(start, seconds):
    return "\n".join(
        [
            log_line("StageSubmitted", Stage_Info=stage_info(0, 0, start)),
            log_line("StageCompleted", Stage_Info=stage_info(0, 0, start, start + 1000 * seconds)),
        ]
    )


def test_attempts_of_an_application_stay_apart(spark, tmp_path):
    for attempt in (1, 2):
        (tmp_path / f"application_17_0001_{attempt}").write_text(stage_log(1_000_000 * attempt, 2))
    found = stages.stage_durations(stages.stages_from_log(read_event_log(spark, str(tmp_path))))
    assert rows(found.select("app_id", "completion_s")) == [("application_17_0001_1", 2.0), ("application_17_0001_2", 2.0)]


def test_plain_and_compressed_logs_of_any_state_in_one_folder(spark, tmp_path):
    import zstandard

    compress = zstandard.ZstdCompressor().compress
    names = ["app-1-0001", "app-2-0001.zstd", "app-3-0001.zstd.compact", "app-4-0001.zstd.inprogress", "app-5-0001.compact"]
    for number, name in enumerate(names):
        # A space after a colon is JSON as well.
        text = stage_log(1_000 * number, 2).replace('":', '": ').encode()
        (tmp_path / name).write_bytes(compress(text) if ".zstd" in name else text)
    found = stages.stages_from_log(read_event_log(spark, str(tmp_path), compressed=True))
    assert rows(found.select("app_id")) == [(f"app-{n}-0001",) for n in range(1, 6)]
    (tmp_path / "app-6-0001.lz4").write_bytes(b"garbage")
    with pytest.raises((PySparkException, Py4JJavaError), match="unknown codec"):
        read_event_log(spark, str(tmp_path), compressed=True).collect()


def test_planned_stages_of_a_running_application_are_pending(spark, tmp_path):
    plan = log_line("JobStart", Job_ID=0, Stage_IDs=[0, 1, 2])
    (tmp_path / "app-1-0001").write_text(f"{plan}\n{stage_log(1000, 2)}")
    # The end is in another file of a rolled log, and there twice.
    (tmp_path / "events_1_app-2-0001").write_text(f"{plan}\n{stage_log(1000, 2)}")
    (tmp_path / "events_2_app-2-0001").write_text("\n".join([log_line("ApplicationEnd", Timestamp=9)] * 2))
    found = stages.stages_from_log(read_event_log(spark, str(tmp_path)))
    assert rows(found.select("app_id", "stage_id", "status")) == [
        ("app-1-0001", 0, "COMPLETE"),
        ("app-1-0001", 1, "PENDING"),
        ("app-1-0001", 2, "PENDING"),
        ("app-2-0001", 0, "COMPLETE"),
        ("app-2-0001", 1, "SKIPPED"),
        ("app-2-0001", 2, "SKIPPED"),
    ]
    summary = stages.stage_summary(found, ["app_id"])
    assert rows(summary.select("app_id", "computed_stages", "skipped_stages")) == [("app-1-0001", 1, 0), ("app-2-0001", 1, 2)]


def test_lines_that_are_no_events_are_counted(spark, tmp_path):
    import zstandard

    text = "\n".join(["{broken", stage_log(1000, 2), "", "also not"])
    (tmp_path / "app-1-0001").write_text(text)
    (tmp_path / "app-2-0001.zstd").write_bytes(zstandard.ZstdCompressor().compress(text.encode()))
    log = read_event_log(spark, str(tmp_path), compressed=True)
    assert rows(stages.unread_lines(log)) == [("app-1-0001", 2), ("app-2-0001", 2)]


def test_compressed_lines_over_several_frames_and_blocks(monkeypatch):
    import pyarrow as pa
    import zstandard

    from draftstats.sources import job_metrics

    compress = zstandard.ZstdCompressor().compress
    lines = [f'{{"Event": "é{i}"}}' for i in range(500)]
    text = ("\n".join(lines) + "\n").encode()
    frames = b"".join(compress(text[i : i + 700]) for i in range(0, len(text), 700))
    for block in (1, 64, 1 << 20):
        monkeypatch.setattr(job_metrics, "_BLOCK", block)
        found = [line for some in job_metrics._lines_of(pa.py_buffer(frames)) for line in some.to_pylist()]
        assert found == lines
    # A log that is still written ends inside a frame.
    cut = [line for some in job_metrics._lines_of(pa.py_buffer(frames[:-20])) for line in some.to_pylist()]
    assert cut[:400] == lines[:400]


def test_an_event_log_is_read_once(spark, sf_dir):
    found = stages.stages_from_log(proxies.event_log(spark, sf_dir))
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "ReusedExchange" in plan and plan.count("FileScan") == 2
