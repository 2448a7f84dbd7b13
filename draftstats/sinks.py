"""Distributed writes. Results never pass through the driver."""

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_UNFINISHED, _FINISHED = "_unfinished", "_finished"


def write_stats(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """Write a result as it is, in its own order."""
    df.write.format(fmt).mode(mode).save(path)


def write_by_team(
    df: DataFrame, path: str, order: list[str | Column], fmt: str = "parquet", mode: str = "overwrite"
) -> None:
    """One directory per team, rows of a file in the given order.

    The directory is named after `team_dir`, a copy of the team name: null and
    empty names share a default directory and special characters are escaped,
    so the name itself stays in the data. Rows are rebalanced by team, which
    gives few files per team and still splits a team that is very large.
    """
    (
        df.withColumn("team_dir", F.col("teamname"))
        .hint("rebalance", F.col("team_dir"))
        .sortWithinPartitions("team_dir", *order)
        .write.format(fmt)
        .mode(mode)
        .partitionBy("team_dir")
        .save(path)
    )


@contextmanager
def published(spark: SparkSession, output: str) -> Iterator[str]:
    """A folder for the tables of a report, which take their places below `output` together.

    Until the last table is written the old ones stay whole. Then one rename
    settles that the new ones are valid, and they are moved; should that be
    interrupted, `settle` or the next report moves the rest.
    """
    settle(spark, output)
    delete(spark, f"{output}/{_UNFINISHED}")
    yield f"{output}/{_UNFINISHED}"
    _rename(spark, f"{output}/{_UNFINISHED}", f"{output}/{_FINISHED}")
    settle(spark, output)


def settle(spark: SparkSession, output: str) -> None:
    """Move the tables of a report that is finished but not in its place yet."""
    for table in _tables(spark, f"{output}/{_FINISHED}"):
        delete(spark, f"{output}/{table}")
        _rename(spark, f"{output}/{_FINISHED}/{table}", f"{output}/{table}")
    delete(spark, f"{output}/{_FINISHED}")


def delete(spark: SparkSession, folder: str) -> None:
    """Delete a folder, if it is there."""
    files, path = _at(spark, folder)
    files.delete(path, True)


def _rename(spark: SparkSession, source: str, target: str) -> None:
    files, path = _at(spark, source)
    if not files.rename(path, _at(spark, target)[1]):
        raise OSError(f"{source} could not be renamed to {target}")


def _tables(spark: SparkSession, folder: str) -> list[str]:
    files, path = _at(spark, folder)
    return [found.getPath().getName() for found in files.listStatus(path)] if files.exists(path) else []


def _at(spark: SparkSession, folder: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path
