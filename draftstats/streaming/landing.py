"""Landing as a file stream: every run takes only files no earlier run has seen."""

from dataclasses import asdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..plans.landing import land_matches
from ..schemas import MATCH, with_corrupt
from ..sources.matches import identified, malformed_matches, match_id_from_file


def land_new_files(
    spark: SparkSession, source: str, table: str, checkpoint: str, max_files: int | None = None, unique: bool = False
) -> StreamingQuery:
    """Land what is new in `source`, then stop. Call it again for the next run.

    A batch that is repeated after a failure lands nothing twice, because
    landing skips matches already in the table. `max_files` bounds a batch,
    `unique` is that of `new_documents`. What a batch could not land is kept: its counts in `table`_counts,
    damaged lines in `table`_rejects, by batch.
    """
    # A file is new if no run has seen it, whatever its age.
    reader = spark.readStream.schema(with_corrupt(MATCH)).option("pathGlobFilter", "*.json").option("maxFileAge", "36500d")
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    docs = reader.json(source).select(
        match_id_from_file().alias("file_id"), F.col("_metadata.file_path").alias("source_file"), "*"
    )

    def land(batch: DataFrame, number: int) -> None:
        found = identified(batch)
        counts = land_matches(found, table, unique)
        # By batch, so that a repeated batch replaces its own rows.
        malformed_matches(found).write.mode("overwrite").parquet(f"{table}_rejects/batch={number}")
        spark.createDataFrame([asdict(counts)]).coalesce(1).write.mode("overwrite").parquet(f"{table}_counts/batch={number}")

    return (
        docs.writeStream.foreachBatch(land)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
