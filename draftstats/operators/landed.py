"""An exact index of landed match ids, and what landing decides with it.

The index is rows of (bucket, bitmap): a bucket is 32,768 consecutive ids, its
bitmap 4 KB with a bit for each. Rows of one bucket may be many, as each landing
appends its own; together they are the `or` of all. Ids that are close together,
as match ids are, cost a few bits each, and asking for ids reads the buckets
they are in and never the match table.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

INDEX = "bucket bigint, bitmap binary"
#: Where a staged document is, for `chosen`.
PLACE = ("staged_file", "row_index")
#: Bitmaps that are sent to every task at most, in bytes.
SENT_BYTES = 64 << 20
_IDS_PER_BUCKET = 32_768
_BITMAP_BYTES = _IDS_PER_BUCKET // 8


def index_of(rows: DataFrame, column: str = "match_id") -> DataFrame:
    """(bucket, bitmap) of the ids that are not null. Copies of an id collapse map-side into one bit."""
    ids = rows.filter(F.col(column).isNotNull())
    return ids.groupBy(_bucket(F.col(column)).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(column)).alias("bitmap")
    )


def merged(index: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One row per bucket. Merging again, or merging a part twice, changes nothing."""
    return index.groupBy(*by, "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def bucket_sizes(index: DataFrame) -> DataFrame:
    """(bucket, ids): how many ids of each bucket have landed."""
    return merged(index).select("bucket", F.bitmap_count("bitmap").alias("ids"))


def ids_of(index: DataFrame) -> DataFrame:
    """(match_id) of all ids in the index, one row each."""
    position = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(_IDS_PER_BUCKET - 1).cast("bigint")))
    bits = merged(index).select("bucket", "bitmap", position.alias("position"))
    above = (F.col("bucket") - 1) * _IDS_PER_BUCKET + F.col("position") + 1
    value = F.when(F.col("bucket") > 0, above).otherwise(F.col("bucket") * _IDS_PER_BUCKET - F.col("position"))
    return bits.filter(_holds(F.col("bitmap"), F.col("position"))).select(value.alias("match_id"))


def not_landed(rows: DataFrame, index: DataFrame, column: str = "match_id") -> DataFrame:
    """The rows whose id is not in the index; a null id is in none.

    Rows meet their bucket's bitmap. A bucket holds at most 32,768 ids, so rows
    of distinct ids cannot crowd one task; others should be reduced first.
    """
    bits = merged(index).select(F.col("bucket").alias("landed_bucket"), F.col("bitmap").alias("landed_bits"))
    met = rows.join(bits, _bucket(F.col(column)) == F.col("landed_bucket"), "left")
    landed = F.col("landed_bits").isNotNull() & _holds(F.col("landed_bits"), F.bitmap_bit_position(column))
    return met.filter(~F.coalesce(landed, F.lit(False))).drop("landed_bucket", "landed_bits")


def fits_tasks(index: DataFrame) -> bool:
    """Whether the index is small enough to send to every task. It is unless ids are few and far between."""
    return index.agg(F.count_distinct("bucket")).first()[0] <= SENT_BYTES // _BITMAP_BYTES


def not_landed_in_place(rows: DataFrame, index: DataFrame, always: Column | None = None) -> DataFrame:
    """`not_landed` without an exchange of the rows, for an index that `fits_tasks`. Rows where `always` is true stay as well."""
    bits = merged(index).select(F.col("bucket").alias("landed_bucket"), F.col("bitmap").alias("landed_bits"))
    met = rows.join(F.broadcast(bits), _bucket(F.col("match_id")) == F.col("landed_bucket"), "left")
    is_landed = F.coalesce(F.col("landed_bits").isNotNull() & _holds(F.col("landed_bits"), F.bitmap_bit_position("match_id")), F.lit(False))
    kept = ~is_landed if always is None else ~is_landed | always
    return met.filter(kept).drop("landed_bucket", "landed_bits")


def pending(listing: DataFrame, index: DataFrame) -> DataFrame:
    """Listed match ids without a landed document, from the index. A row without id cannot be landed."""
    return not_landed(listing.filter(F.col("match_id").isNotNull()).select("match_id").distinct(), index)


def content_hash(docs: DataFrame) -> Column:
    """Tells different documents of one file apart: a digest of all fields that are the document's own."""
    own = [c for c in docs.columns if c not in ("match_id", "source_file", "file_named", "_corrupt_record")]
    return F.md5(F.to_json(F.struct(*own)))


def candidates(narrow: DataFrame) -> DataFrame:
    """(match_id, source_file, documents, ambiguous, place): the documents of a file for one match, as one row.

    `narrow` has match_id, source_file, file_named, content and the place of a
    document. Different documents of one file that have only the file's name for
    an id are ambiguous: which of them the match is cannot be told.
    """
    place = F.struct("content", *PLACE)
    return narrow.groupBy("match_id", "source_file", "file_named").agg(
        F.count("*").alias("documents"),
        (F.col("file_named") & (F.min("content") != F.max("content"))).alias("ambiguous"),
        F.min(place).alias("place"),
    )


def chosen(candidates: DataFrame, index: DataFrame | None) -> DataFrame:
    """(match_id, staged_file, row_index) of the documents to land: the first source file's of each match not in the index."""
    first = (
        candidates.filter(~F.col("ambiguous"))
        .groupBy("match_id")
        .agg(F.min(F.struct("source_file", "place")).alias("first"))
        .select("match_id", *[F.col(f"first.place.{c}").alias(c) for c in PLACE])
    )
    return first if index is None else not_landed(first, index)


def marks(chosen: DataFrame) -> DataFrame:
    """(staged_file, bucket, bitmap) of chosen places: a bit per staged row, small enough to send to every task."""
    number = F.col("row_index") + 1
    return chosen.groupBy("staged_file", _bucket(number).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("bitmap")
    )


def marked(staged: DataFrame, marks: DataFrame) -> DataFrame:
    """The staged rows whose place is marked. `staged` has the columns of a place."""
    number = F.col("row_index") + 1
    own = marks.select(F.col("staged_file").alias("marked_file"), F.col("bucket").alias("marked_bucket"), F.col("bitmap").alias("marked_bits"))
    same = (F.col("staged_file") == F.col("marked_file")) & (_bucket(number) == F.col("marked_bucket"))
    met = staged.join(own, same)
    return met.filter(_holds(F.col("marked_bits"), F.bitmap_bit_position(number))).drop("marked_file", "marked_bucket", "marked_bits")


def _bucket(number: Column) -> Column:
    return F.bitmap_bucket_number(number)


def _holds(bitmap: Column, position: Column) -> Column:
    """Whether a bit is set: the byte it is in, then the bit."""
    byte = F.conv(F.hex(F.substring(bitmap, (position / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, F.pmod(position, F.lit(8)).cast("int")) == 1
