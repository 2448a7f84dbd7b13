"""Landing listings and documents into Parquet tables.

A match table has a partition per era, some landings in a row; a row keeps the
number of its landing as `batch`. Beside it stands `<table>_index`, the index of
landed ids with a partition per landing, which is all that later landings and
pending matches read of it. `<table>_staged` holds a landing's documents while
it is decided which of them land.
"""

from collections.abc import Sequence
from dataclasses import dataclass
from math import ceil

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import landed
from ..operators.ingest import new_listing_objects, new_listing_rows, of_leagues
from ..schemas import CORRUPT
from ..sinks import delete
from ..sources.matches import is_blank, read_landed
from .counting import Counted

# Landings whose documents share a partition.
BATCHES_PER_ERA = 100
# What is sent to every task at most: bits of staged rows. More are sent for some files after the other.
MARKS_BYTES = 64 << 20
# Size that compaction aims at, in bytes.
FILE_BYTES = 256 << 20
_BITMAP_BYTES = 4096


@dataclass(frozen=True)
class Landing:
    """What a landing read.

    Of all lines, `damaged` ones land without some field; `unreadable` ones gave
    no field and `unnamed` ones have no match id, so neither can land. `ambiguous`
    are different documents of one file that have nothing but the file's name for
    an id: which of them the match is cannot be told, so none lands.
    """

    lines: int
    damaged: int
    unreadable: int
    unnamed: int
    ambiguous: int = 0


@dataclass(frozen=True)
class Listed:
    """What a landing of listings read: all objects, those without a match id, and those that name no league."""

    objects: int
    unnamed: int
    without_league: int


def land_listing(listing: DataFrame, table: str, league_ids: Sequence[int] | None = None) -> Listed:
    """Append what is new in a listing to the listing table, which is never rewritten.

    With `read_listing_objects` the table keeps whole objects. Only the given
    leagues' rows land; objects without a league are of none, and are counted.
    """
    spark = listing.sparkSession
    counted = Counted(
        listing,
        objects=F.count("*"),
        unnamed=F.count_if(F.col("match_id").isNull()),
        without_league=F.count_if(F.col("leagueid").isNull()),
    )
    wanted = counted.rows if league_ids is None else of_leagues(counted.rows, league_ids)
    known = read_landed(spark, table)
    new = new_listing_objects if "listing" in listing.columns else new_listing_rows
    new(wanted, known).write.mode("append").parquet(table)
    return Listed(**counted.get())


def land_matches(docs: DataFrame, table: str, unique: bool = False) -> Landing:
    """Append the readable documents of matches that are not in the table yet.

    Lines that gave no field at all do not land; `malformed_matches` shows them.
    The input is read and parsed once, into staged files; documents with an id
    of their own that landed before are left out there. What lands is decided
    on ids, file names and digests alone; the chosen documents are then copied by
    their place in the staged files, so no document ever crosses an exchange.

    Running it again, also after a failure, adds nothing twice. `unique` states
    that no match occurs twice in the input, as in one folder of files named by
    match id; copies are then not looked for.
    """
    spark = docs.sparkSession
    known = read_index(spark, table)
    batch = _next_batch(known)
    folder = f"{table}_staged/landing-{batch}"
    counts = _stage(docs, f"{folder}/documents", known)
    staged = spark.read.parquet(f"{folder}/documents").select("*", *_place())
    if unique:
        picked = landed.not_landed(staged.select("match_id", *landed.PLACE), known)
    else:
        narrow = staged.select("match_id", "source_file", "file_named", "content", *landed.PLACE)
        landed.candidates(narrow).write.mode("overwrite").parquet(f"{folder}/candidates")
        found = spark.read.parquet(f"{folder}/candidates")
        counts["ambiguous"] = found.filter("ambiguous").agg(F.coalesce(F.sum("documents"), F.lit(0))).first()[0]
        picked = landed.chosen(found, known)
    _copy(staged, landed.marks(picked), counts["lines"], batch, table)
    _index_batches(spark, table, batch - 1)
    delete(spark, folder)
    return Landing(**counts)


def read_index(spark: SparkSession, table: str) -> DataFrame:
    """(bucket, bitmap, batch) of the table's landed ids; brought up to date first, if a landing ended before it could."""
    known = read_landed(spark, f"{table}_index")
    last = -1 if known is None else known.agg(F.max("batch")).first()[0]
    if _index_batches(spark, table, -1 if last is None else last) or known is None:
        known = read_landed(spark, f"{table}_index")
    return spark.createDataFrame([], f"{landed.INDEX}, batch int") if known is None else known


def pending(listing: DataFrame, table: str) -> DataFrame:
    """Listed match ids without a document in the table. The table itself is not read."""
    return landed.pending(listing, read_index(listing.sparkSession, table))


def compact(spark: SparkSession, table: str, file_bytes: int = FILE_BYTES) -> list[int]:
    """Merge the files of eras that have more than their bytes need; the eras that were rewritten.

    Documents are not shuffled: a task reads neighbouring files and writes one.
    An era is replaced as a whole, and one that is compact is left alone, so a
    repeated run changes nothing. Not to be run while something reads the table.
    """
    rewritten = []
    for era, files, size in _eras(spark, table):
        wanted = max(1, ceil(size / file_bytes))
        if files > wanted:
            rows = spark.read.parquet(f"{table}/era={era}").withColumn("era", F.lit(era))
            whole = rows.coalesce(wanted).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            whole.partitionBy("era").parquet(table)
            rewritten.append(era)
    return rewritten


def compact_index(spark: SparkSession, table: str) -> None:
    """Write the index as one row per bucket, under the number of its last landing."""
    known = read_index(spark, table)
    last = known.agg(F.max("batch")).first()[0]
    if last is None:
        return
    folders = [f"{table}_index/batch={r.batch}" for r in known.select("batch").distinct().collect() if r.batch != last]
    # Bits that are there twice are there once, so a failure before the last line costs nothing but space.
    rows = landed.merged(known).withColumn("batch", F.lit(last))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(f"{table}_index")
    for folder in folders:
        delete(spark, folder)


def _stage(docs: DataFrame, path: str, known: DataFrame) -> dict[str, int]:
    """Write the documents that can land, with a digest of each; the counts are observed meanwhile.

    Those that landed before are not written, but for those named by their file, which may be ambiguous.
    """
    corrupt = F.col(CORRUPT).isNotNull() if CORRUPT in docs.columns else F.lit(False)
    blank = corrupt & is_blank(docs) if CORRUPT in docs.columns else F.lit(False)
    if "file_named" not in docs.columns:
        docs = docs.withColumn("file_named", F.lit(False))
    counted = Counted(
        docs,
        lines=F.count("*"),
        damaged=F.count_if(corrupt & ~blank),
        unreadable=F.count_if(blank),
        unnamed=F.count_if(~blank & F.col("match_id").isNull()),
    )
    able = counted.rows.filter(~blank & F.col("match_id").isNotNull())
    if not known.isEmpty() and landed.fits_tasks(known):
        able = landed.not_landed_in_place(able, known, F.col("file_named"))
    # Only documents that may be ambiguous are digested.
    content = F.when(F.col("file_named"), landed.content_hash(docs)).alias("content")
    able.select("*", content).write.mode("overwrite").parquet(path)
    return counted.get()


def _copy(staged: DataFrame, marks: DataFrame, lines: int, batch: int, table: str) -> None:
    """Append the marked rows. Marks are sent to every task; if they are too many for that, for some files after the other."""
    columns = [c for c in staged.columns if c not in ("file_named", "content", *landed.PLACE)]
    # A bit per row, and for each file at most one bitmap that is not full.
    size = lines // 8 + _BITMAP_BYTES * len(staged.inputFiles())
    groups = max(1, ceil(size / MARKS_BYTES))
    for group in range(groups):
        # On the name alone, so that files of other groups are not opened.
        own = F.pmod(F.xxhash64("staged_file"), F.lit(groups)) == group
        rows = landed.marked(staged.filter(own), F.broadcast(marks.filter(own)))
        found = rows.select(*columns, F.lit(batch).alias("batch"), F.lit(batch // BATCHES_PER_ERA).alias("era"))
        found.write.mode("append").partitionBy("era").parquet(table)


def _index_batches(spark: SparkSession, table: str, last: int) -> bool:
    """Index the landings after `last` from the table. Each replaces its own part, so it may be done again."""
    rows = read_landed(spark, table)
    if rows is None:
        return False
    if "batch" not in rows.columns:
        raise ValueError(f"{table} has no landing numbers: it was not written by this version")
    new = rows.filter((F.col("era") >= max(last, 0) // BATCHES_PER_ERA) & (F.col("batch") > last)).select("match_id", "batch")
    if new.isEmpty():
        return False
    ids = new.groupBy("batch", F.bitmap_bucket_number("match_id").alias("bucket"))
    parts = ids.agg(F.bitmap_construct_agg(F.bitmap_bit_position("match_id")).alias("bitmap"))
    writer = parts.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch")
    writer.parquet(f"{table}_index")
    return True


def _next_batch(index: DataFrame) -> int:
    last = index.agg(F.max("batch")).first()[0]
    return 0 if last is None else last + 1


def _eras(spark: SparkSession, table: str) -> list[tuple[int, int, int]]:
    """(era, files, bytes) from the names and sizes of the files; none is opened."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(table)
    era = F.regexp_extract("path", r"/era=(\d+)/", 1).cast("int").alias("era")
    sizes = files.select(era, "length").groupBy("era").agg(F.count("*").alias("files"), F.sum("length").alias("bytes"))
    return [tuple(row) for row in sizes.orderBy("era").collect()]


def _place():
    return [F.col("_metadata.file_name").alias("staged_file"), F.col("_metadata.row_index").alias("row_index")]
