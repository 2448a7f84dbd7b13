"""Match documents: one JSON document per line, usually one per file."""

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import CORRUPT, MATCH, MATCH_TEXT_EVENTS, MATCH_TEXT_IDS, with_corrupt

PERMISSIVE, FAILFAST = "PERMISSIVE", "FAILFAST"
#: For `coerce`: accept heroes' ids in quotes, and nothing else that is not of its type.
HERO_ID = "hero_id"
#: What drafts need of a document.
DRAFT_FIELDS = ("match_id", "picks_bans", "radiant_name", "dire_name", "radiant_win")


def match_id_from_file() -> Column:
    """The id a file is named after, if its whole name is digits."""
    digits = F.regexp_extract("_metadata.file_name", r"^(\d+)\.json(?:\.\w+)?$", 1)
    return digits.try_cast("bigint").alias("match_id")


def identified(docs: DataFrame) -> DataFrame:
    """`file_id` and the document's own `match_id` as one `match_id`; `file_named` tells which it was.

    A file of several documents gives each its own id only if they carry it.
    """
    own = F.col("match_id")
    named = own.isNull() & F.col("file_id").isNotNull()
    rest = [c for c in docs.columns if c not in ("match_id", "file_id", "source_file")]
    return docs.select(F.coalesce(own, "file_id").alias("match_id"), "source_file", named.alias("file_named"), *rest)


def read_matches(
    spark: SparkSession,
    path: str | list[str],
    mode: str = PERMISSIVE,
    multi_line: bool = False,
    coerce: bool | str = False,
) -> DataFrame:
    """Scan match documents.

    In PERMISSIVE mode a line that is not JSON becomes a row of nulls and a
    field of the wrong type becomes null; both keep their text in
    `_corrupt_record`, see `malformed_matches`. FAILFAST raises on either.
    `coerce` accepts quoted numbers and 0 / 1 flags in draft events, or as
    `HERO_ID` quoted ids of heroes only.
    """
    schema = _schema(coerce, mode)
    docs = (
        spark.read.schema(schema)
        .option("mode", mode)
        .option("multiLine", multi_line)
        .json(path)
        .select(match_id_from_file().alias("file_id"), F.col("_metadata.file_path").alias("source_file"), "*")
    )
    return identified(_coerce_events(docs, coerce) if coerce else docs)


def read_match_lines(
    spark: SparkSession, path: str | list[str], mode: str = FAILFAST, coerce: bool | str = True
) -> DataFrame:
    """Scan files as text lines, then parse each line; raises on a bad one by default."""
    lines = spark.read.text(path).select(
        match_id_from_file(), F.col("_metadata.file_path").alias("source_file"), "value"
    )
    return parse_matches(lines, mode=mode, coerce=coerce)


def parse_matches(
    lines: DataFrame,
    column: str = "value",
    mode: str = PERMISSIVE,
    coerce: bool | str = False,
    fields: Sequence[str] | None = None,
) -> DataFrame:
    """Replace a column of JSON text by the fields of a match document, or by the given ones.

    Only these fields are parsed: a count of heroes that asks for `DRAFT_FIELDS` never parses the players.
    A match id among the lines' columns stands in for documents without one.
    """
    schema = _schema(coerce, mode, fields)
    lines = lines.withColumnRenamed("match_id", "line_match_id") if "match_id" in lines.columns else lines
    kept = [c for c in lines.columns if c != column]
    document = F.from_json(F.col(column), schema, {"mode": mode, "columnNameOfCorruptRecord": CORRUPT})
    # A generator, unlike a projection, lets no filter on the fields move below
    # it, which would parse the text once more for the filter.
    docs = lines.select(*kept, F.inline(F.array(document)))
    if "line_match_id" in kept:
        own = F.coalesce("match_id", "line_match_id") if "match_id" in docs.columns else F.col("line_match_id")
        rest = [c for c in docs.columns if c not in ("match_id", "line_match_id")]
        docs = docs.select(own.alias("match_id"), *rest)
    return _coerce_events(docs, coerce) if coerce else docs


def malformed_matches(docs: DataFrame) -> DataFrame:
    """Rows PERMISSIVE parsing could not fully read, with their text.

    `whole_line` tells a line that gave nothing from one that lost some fields.
    """
    kept = [c for c in ("match_id", "source_file") if c in docs.columns]
    return docs.filter(F.col(CORRUPT).isNotNull()).select(*kept, CORRUPT, is_blank(docs).alias("whole_line"))


def is_blank(docs: DataFrame) -> Column:
    """True where no declared field of the document is present."""
    present = [F.col(f.name).isNotNull() for f in MATCH.fields if f.name in docs.columns and f.name != "match_id"]
    return ~reduce(or_, present)


def read_landed(spark: SparkSession, path: str) -> DataFrame | None:
    """A landed table, or None before the first landing."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def _schema(coerce: bool | str, mode: str, fields: Sequence[str] | None = None) -> T.StructType:
    schema = MATCH_TEXT_IDS if coerce == HERO_ID else MATCH_TEXT_EVENTS if coerce else MATCH
    if fields is not None:
        schema = T.StructType([f for f in schema.fields if f.name in fields])
    return with_corrupt(schema) if mode == PERMISSIVE else schema


def _coerce_events(docs: DataFrame, coerce: bool | str) -> DataFrame:
    def event(e: Column) -> Column:
        if coerce == HERO_ID:
            return e.withField("hero_id", e.hero_id.try_cast("bigint"))
        return F.struct(
            e.hero_id.try_cast("bigint").alias("hero_id"),
            e.is_pick.try_cast("boolean").alias("is_pick"),
            e.order.try_cast("bigint").alias("order"),
            e.team.try_cast("bigint").alias("team"),
        )

    return docs.withColumn("picks_bans", F.transform("picks_bans", event))
