"""League match listings."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import LISTING


def read_listing(
    spark: SparkSession, path: str | list[str], multi_line: bool = False, schema: T.StructType = LISTING
) -> DataFrame:
    """Listings of any number of leagues as one relation, duplicates kept.

    A line is a JSON object or an array of them. `multi_line` is for files that
    hold one pretty-printed value, and reads nothing but the first value of others. Every path goes into the same scan.
    """
    return spark.read.schema(schema).option("multiLine", multi_line).json(path)


def read_listing_objects(spark: SparkSession, path: str | list[str], multi_line: bool = False) -> DataFrame:
    """(match_id, leagueid, listing): `read_listing` with the whole object as it was listed, as a variant.

    Whatever fields an object has are kept, without a schema. Lines that are not
    JSON give no rows. An object without a match id or a league has null for it.
    """
    return listing_objects(spark.read.text(path, wholetext=multi_line))


def listing_objects(lines: DataFrame, column: str = "value") -> DataFrame:
    """`read_listing_objects` of a column of JSON text."""
    value = lines.select(F.try_parse_json(column).alias("listed"))
    # An array of objects, or an object that stands for one.
    every = F.coalesce(F.try_variant_get("listed", "$", "array<variant>"), F.array("listed"))
    objects = value.filter(F.col("listed").isNotNull()).select(F.explode(every).alias("listing"))
    ids = [F.try_variant_get("listing", f"$.{name}", "bigint").alias(name) for name in LISTING.names]
    return objects.select(*ids, "listing")
