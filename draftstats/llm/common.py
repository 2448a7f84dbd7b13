"""What several operators need: tables in the shared folder, and Arrow columns as bytes."""

import gc
import tempfile
import uuid
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_FOLDERS: dict[str, str] = {}
# log2 of the hashes that `told_apart` has bits for, and how many one bitmap holds.
_MARK_BITS, _PER_BITMAP = 27, 1 << 15


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: `spark.checkpoint.dir`, or one of its own where that is unset."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        app = spark.sparkContext.applicationId
        base = _FOLDERS.setdefault(app, "") or tempfile.mkdtemp(prefix="llm-")
        _FOLDERS[app] = base
    return base.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame, name: str) -> DataFrame:
    """The same rows read from a table in the shared folder, so lost executors cost no more than one step.

    The shuffle files of the steps before are then garbage; asking for a
    collection lets Spark's cleaner delete them instead of keeping all steps.
    """
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.parquet(path)
    # The scheduler lets go of the last job only when there is another.
    spark.range(1).count()
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    return spark.read.schema(df.schema).parquet(path)


def drop_cut(df: DataFrame) -> None:
    """Delete a table of `cut` that no later step reads."""
    spark = df.sparkSession
    for folder in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def read_if_there(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A table, empty before the first write."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], schema)
        raise


def unused(columns: Sequence[str], name: str) -> str:
    """A column name like `name` that none of `columns` has."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def told_apart(rows: DataFrame, key: Sequence[str], wanted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows whose key may be in `wanted`, which has columns of the key's types in its order, and those whose key is not.

    What is sent to every task is a bit for each hash of a key, 16 MB at most
    whatever the data. Large rows that a join would keep anyway, or drop
    anyway, so need not be shuffled; the others are for an exact join.
    """
    hashes = F.pmod(F.xxhash64(*wanted.columns), F.lit(1 << _MARK_BITS))
    bucket, place = F.floor(hashes / _PER_BITMAP), (hashes % _PER_BITMAP)
    bitmaps = cut(wanted.select(bucket.alias("bucket"), place.alias("place")).groupBy("bucket").agg(F.bitmap_construct_agg("place").alias("bits")), "marks")
    number, at, bits = (unused(rows.columns, name) for name in ("mark_no", "mark_at", "mark_bits"))
    numbered = rows.withColumn(number, F.pmod(F.xxhash64(*key), F.lit(1 << _MARK_BITS)))
    marks = bitmaps.toDF(at, bits)
    met = numbered.join(F.broadcast(marks), F.floor(F.col(number) / _PER_BITMAP) == F.col(at), "left")
    place = F.col(number) % _PER_BITMAP
    byte = F.conv(F.hex(F.substring(bits, F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    may = F.coalesce(F.getbit(byte, (place % 8).cast("int")) == 1, F.lit(False))
    return met.filter(may).select(*rows.columns), met.filter(~may).select(*rows.columns)


def utf8(column: pa.Array) -> Iterator[np.ndarray]:
    """Each value's bytes as an array, without a copy; a null is empty."""
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    size = len(column) + column.offset + 1
    ends = np.frombuffer(offsets, np.int64 if wide else np.int32, size)[column.offset :]
    content = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    valid = np.ones(len(column), bool) if not column.null_count else column.is_valid().to_numpy(zero_copy_only=False)
    for i in range(len(column)):
        yield content[ends[i] : ends[i + 1]] if valid[i] else content[:0]


def batches_of(schema: pa.Schema, rows: Iterator[tuple], size: int = 5_000) -> Iterator[pa.RecordBatch]:
    """Rows as record batches of a bounded number of rows."""
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield _batch(schema, held)
            held = []
    if held:
        yield _batch(schema, held)


def _batch(schema: pa.Schema, rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
