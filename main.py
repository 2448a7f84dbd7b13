"""spark-submit main.py JOB --input PATH --output PATH [options]

listing    append what is new in the league listings of a JSON folder to a listing table
pending    ids of a listing table without a document in the match table --matches
land       append the new match documents of a JSON folder to a Parquet table
compact    merge the small files of a match table, --output
malformed  lines of a JSON folder that could not be read in full
draft      hero and team statistics of a match table or JSON folder
items      item statistics of a match table or JSON folder
job        stage and task report of Spark event logs or of dumped stage records
"""

import argparse

from pyspark.sql import SparkSession

from draftstats.operators import stages
from draftstats.operators.ingest import of_league, pending_matches
from draftstats.plans import (
    compact,
    compact_index,
    draft_report,
    item_report,
    job_report,
    land_listing,
    land_matches,
    pending,
)
from draftstats.sinks import write_stats
from draftstats.sources import (
    LEAGUE_IDS,
    malformed_matches,
    read_event_log,
    read_listing,
    read_listing_objects,
    read_matches,
    read_stage_records,
)
from draftstats.streaming import land_new_files

# Settings a job starts from; spark-submit --conf takes precedence.

# Folders of one match per file: a file costs little to open next to its
# parsing, so a task takes thousands of them. Large input then makes few enough
# tasks for a shuffle; small input is split by the number of cores anyway.
SMALL_FILES = {
    "spark.sql.files.openCostInBytes": "65536",
    "spark.sql.files.maxPartitionBytes": "1g",
}

def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    parser.add_argument("job", choices=["listing", "pending", "land", "compact", "malformed", "draft", "items", "job"])
    parser.add_argument("--input", help="path or glob; needed by all jobs but compact")
    parser.add_argument("--output", required=True)
    parser.add_argument("--mode", choices=["full", "strict"], default="full", help="convention of the draft report")
    parser.add_argument("--format", default="parquet", help="format of the written results")
    parser.add_argument("--landed", action="store_true", help="the input is a landed Parquet table, not JSON")
    parser.add_argument("--failfast", action="store_true", help="raise on malformed documents")
    parser.add_argument("--compressed", action="store_true", help="job: the event logs are compressed with zstd")
    parser.add_argument("--records", action="store_true", help="the input is dumped stage records, not event logs")
    parser.add_argument("--leagues", type=int, nargs="*", default=list(LEAGUE_IDS), help="listing: leagues to keep")
    parser.add_argument("--ids-only", action="store_true", help="listing: keep match and league ids, not whole objects")
    parser.add_argument("--matches", help="pending: the match table")
    parser.add_argument("--unique", action="store_true", help="land: no match occurs twice in the input")
    parser.add_argument("--checkpoint", help="land: folder that remembers the files of earlier runs, to skip them")
    parser.add_argument("--max-files", type=int, help="land with --checkpoint: files per batch")
    parser.add_argument("--multi-line", action="store_true", help="listing, --records: each file is one pretty-printed value")
    args = parser.parse_args(argv)
    if not args.input and args.job != "compact":
        parser.error(f"--input is needed for {args.job}")
    if args.failfast and (args.job == "malformed" or args.checkpoint):
        parser.error("--failfast keeps no rejects: not for malformed, nor for land with --checkpoint")
    if args.landed and args.job in ("land", "malformed"):
        parser.error(f"--landed is not for {args.job}, which reads JSON")

    spark = SparkSession.builder.appName(f"draftstats-{args.job}").getOrCreate()
    if args.job == "job":
        if args.records:
            job_report(stages.stages_from_records(read_stage_records(spark, args.input, args.multi_line)), args.output, fmt=args.format)
            return
        events = read_event_log(spark, args.input, args.compressed)
        job_report(stages.stages_from_log(events), args.output, fmt=args.format)
        write_stats(stages.unread_lines(events), f"{args.output}/unread_lines", args.format)
        return

    if args.job == "listing":
        read = read_listing if args.ids_only else read_listing_objects
        listing = read(spark, args.input, args.multi_line)
        if len(args.leagues) == 1:
            listing = of_league(listing, args.leagues[0])
        print(land_listing(listing, args.output, args.leagues))
        return
    if args.job == "pending":
        listing = spark.read.parquet(args.input)
        # A path that is given must be there: a mistyped one would make all matches pending.
        landed = spark.read.parquet(args.matches) if args.matches else None
        if landed is not None and "batch" in landed.columns:
            found = pending(listing, args.matches)
        else:
            found = pending_matches(listing, landed)
        write_stats(found, args.output, args.format)
        return
    if args.job == "compact":
        print(f"eras rewritten: {compact(spark, args.output)}")
        compact_index(spark, args.output)
        return

    if not args.landed:
        set_defaults(spark, SMALL_FILES)
    if args.job == "land" and args.checkpoint:
        landing = land_new_files(spark, args.input, args.output, args.checkpoint, args.max_files, args.unique)
        landing.awaitTermination()
        return
    if args.landed:
        matches = spark.read.parquet(args.input)
    else:
        matches = read_matches(spark, args.input, mode="FAILFAST" if args.failfast else "PERMISSIVE")
    if args.job == "land":
        print(land_matches(matches, args.output, args.unique))
    elif args.job == "malformed":
        write_stats(malformed_matches(matches), args.output, args.format)
    elif args.job == "draft":
        print(draft_report(matches, args.output, args.mode, args.format))
    else:
        print(item_report(matches, args.output, args.format))


def set_defaults(spark: SparkSession, settings: dict[str, str]) -> None:
    submitted = spark.sparkContext.getConf()
    for key, value in settings.items():
        if not submitted.contains(key):
            spark.conf.set(key, value)


if __name__ == "__main__":
    main()
