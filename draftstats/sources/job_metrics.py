"""Stage and task records of finished Spark jobs.

`operators.stages` turns the rows of either scan into the same stage rows, so the
statistics do not care where a record came from.
"""

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import EVENT_LOG, STAGE_RECORD

COMPRESSED = r"\.(zstd|lz4|lzf|snappy)(\.compact)?(\.inprogress)?$"
ZSTD = r"\.zstd(\.compact)?(\.inprogress)?$"
# Bytes of text that a task decompresses at a time.
_BLOCK = 8 << 20
# An attempt of an application is an application of its own: its stages are numbered from 0 again.
APP_ID = r"(application_\d+_\d+(?:_\d+)?|app-\d+-\d+|local-\d+|spark-[0-9a-f]+)"


def _app_id_from_file() -> Column:
    """The id in a file's name or else in its folder's; the name itself where there is none."""
    name, path = F.col("_metadata.file_name"), F.col("_metadata.file_path")
    own, folder = F.regexp_extract(name, APP_ID, 1), F.regexp_extract(path, APP_ID + r"[^/]*/[^/]*$", 1)
    return F.when(own != "", own).when(folder != "", folder).otherwise(name).alias("app_id")


def read_event_log(spark: SparkSession, path: str | list[str], compressed: bool = False) -> DataFrame:
    """Event logs of one or many applications, single files or rolled folders.

    The application id comes from the file name, or from the folder's. Logs of applications that still
    run may be among them: the planned stages of these are pending.

    A scan that meets a compressed log raises, unless `compressed`: then plain
    logs and those compressed with zstd, Spark's default, are read alike, and other codecs raise.
    Rolled, compacted and unfinished files count.

    A line that is not an event gives a row of nulls; `stages.unread_lines` counts these.
    """
    log = spark.read.schema(EVENT_LOG).option("recursiveFileLookup", True).json(path)
    file = F.col("_metadata.file_name")
    if compressed:
        known = F.assert_true(~file.rlike(COMPRESSED) | file.rlike(ZSTD), "event log of an unknown codec")
        plain = log.filter(~file.rlike(ZSTD) & known.isNull()).select(_app_id_from_file(), "*")
        event = F.from_json("value", EVENT_LOG)
        return plain.unionByName(_decompressed_lines(spark, path).select("app_id", F.inline(F.array(event))))
    readable = F.assert_true(~file.rlike(COMPRESSED), "compressed event log: pass compressed=True if zstd, else write it uncompressed")
    return log.filter(readable.isNull()).select(_app_id_from_file(), "*")


def _decompressed_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(app_id, value) for the lines of logs compressed with zstd.

    Spark's readers do not know the codec, so files arrive whole. Rolled logs
    are at most 128 MB each, and tasks take files up to maxPartitionBytes.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.zstd*")
        .load(path)
        .filter(F.col("_metadata.file_name").rlike(ZSTD))
        .select(_app_id_from_file(), "content")
    )
    return files.mapInArrow(_event_lines, "app_id string, value string")


def _event_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for app_id, content in zip(batch.column("app_id"), batch.column("content"), strict=True):
            for lines in _lines_of(content.as_buffer()):
                yield pa.RecordBatch.from_arrays([pa.repeat(app_id, len(lines)), lines], ["app_id", "value"])


def _lines_of(content: pa.Buffer) -> Iterator[pa.Array]:
    """Arrays of the lines of a log, block by block; no line is looked at by itself.

    A log is a sequence of frames, one per flush. One that is still written may
    end inside a frame: what is whole of it is read.
    """
    rest = b""
    for block in _blocks(content):
        whole, newline, rest = (rest + block).rpartition(b"\n")
        if newline:
            yield _split(whole)
    if rest:
        yield _split(rest)


def _blocks(content: pa.Buffer) -> Iterator[bytes]:
    """The decompressed log. Where it breaks off the last block is read again in smaller ones."""
    done = 0
    for size in (_BLOCK, 1 << 15, 1 << 7, 1):
        with pa.CompressedInputStream(pa.BufferReader(content), "zstd") as stream:
            at = 0
            while at < done:
                at += len(stream.read(min(_BLOCK, done - at)))
            try:
                while block := stream.read(size):
                    done += len(block)
                    yield block
                return
            except OSError as error:
                if "Truncated" not in str(error):
                    raise


def _split(text: bytes) -> pa.Array:
    lines = pc.split_pattern(pa.array([text], pa.large_binary()), b"\n").flatten()
    return lines.filter(pc.greater(pc.binary_length(lines), 0)).cast(pa.binary()).cast(pa.string())


def read_stage_records(spark: SparkSession, path: str | list[str], multi_line: bool = False) -> DataFrame:
    """Stage records, an object or an array of them per line; `multi_line` is for one pretty-printed value per file."""
    return (
        spark.read.schema(STAGE_RECORD)
        .option("multiLine", multi_line)
        .json(path)
        .select(_app_id_from_file(), "*")
    )
