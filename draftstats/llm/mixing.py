"""Mixing sources to target weights, by blocks.

Each source's documents, one after the other, are cut into blocks of a fixed
number of tokens (words here). Output shards have a fixed number of slots. The slots'
sources are drawn for all shards at once: a pseudorandom permutation deals the
slots of all sources to the shards, so a shard's source counts are multinomial
draws given that every source gets its target in total. A source's slots walk
its blocks in a pseudorandom permutation, a new one each time round. Slots and
blocks are joined by source and block index.

A permutation is the order of digests: an index goes to the place that the
digest of its source, round and number has among all others. Places are counted
within parts by the digests' first digits, so nothing is ordered in one task.

All of it is DataFrame operations, and all arithmetic is on whole numbers that
depend on the data only, so a second run mixes alike on any cluster.
"""

from collections.abc import Sequence
from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, told_apart, unused

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)

# Rows that one array makes, and documents of a source whose places are summed up together.
_RUN = 10_000
_TOGETHER = 2_000
# Leading hexadecimal digits of digests that are ordered together.
_DIGITS = 4
# A prime that spreads ids over parts, whatever the steps between them.
_SPREAD = 1_000_003


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def source_targets(sizes: DataFrame, share: float = 1.5, most: int = 2) -> DataFrame:
    """(source, source_no, source_size, target) of each source; sizes has (source, size).

    Sources, in order of code points with null last, weigh `WEIGHTS` in turn and
    share `share` times all tokens. No target exceeds `most` times its source's
    size; the excess is shared by weight among the others until that holds. The
    level at which targets per weight stand then is the largest of the levels
    found when the sources, by rising limit per weight, are taken as limited
    one after the other. The windows hold a row per source.
    """
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    number = F.row_number().over(order) - 1
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (number % len(WEIGHTS) + 1).cast("int"))
    limited = by_source.select(
        "source", "source_size", number.alias("source_no"), weight.alias("weight"), (most * F.col("source_size")).alias("limit")
    )
    rising = Window.orderBy(F.col("limit") / F.col("weight"), "source_no")
    before = rising.rowsBetween(Window.unboundedPreceding, -1)
    onwards = rising.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    left = share * F.sum("source_size").over(everything) - F.coalesce(F.sum("limit").over(before), F.lit(0))
    level = F.max("level").over(everything)
    return limited.withColumn("level", left / F.sum("weight").over(onwards)).select(
        "source", "source_no", "source_size", F.least(F.col("limit").cast("double"), level * F.col("weight")).alias("target")
    )


def place(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size, text_hash, start): where each document begins among its source's tokens.

    Documents of a source follow each other by their ids' part, then ids, then
    sizes. Sums run within bounded parts of a source and over the parts, so
    no source is summed up in one task. Null sources are one source; null texts
    have no tokens; rows that repeat have a place each.
    """
    sized = cut(docs.select("doc_id", "source", n_words(F.col("text")).alias("size"), F.xxhash64("text").alias("text_hash")), "sizes")
    parts = max(1, ceil(sized.count() / _TOGETHER))
    part = (F.pmod(F.pmod(F.coalesce("doc_id", F.lit(0)), F.lit(_SPREAD)) * 7919, F.lit(_SPREAD)) % parts).alias("part")
    parted = sized.select("doc_id", "source", "size", "text_hash", part)
    sums = parted.groupBy("source", "part").agg(F.sum("size").alias("part_size"))
    upto = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    begins = sums.select(
        F.col("source").alias("in_source"),
        F.col("part").alias("in_part"),
        (F.sum("part_size").over(upto) - F.col("part_size")).alias("part_start"),
    )
    within = (
        Window.partitionBy("source", "part")
        .orderBy("doc_id", "size")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    placed = parted.withColumn("in_part_start", F.sum("size").over(within) - F.col("size"))
    same = placed["source"].eqNullSafe(begins["in_source"]) & (placed["part"] == begins["in_part"])
    return placed.join(begins, same).select(
        "doc_id", "source", "size", "text_hash", (F.col("part_start") + F.col("in_part_start")).alias("start")
    )


def blocks(placed: DataFrame, block: int) -> DataFrame:
    """(source_no, index, start, from, words): the part of each document in each block it reaches."""
    last = F.floor((F.col("start") + F.col("size") - 1) / block)
    spread = placed.filter("size > 0").select(
        "source_no", "start", "size", F.explode(F.sequence(F.floor(F.col("start") / block), last)).alias("index")
    )
    begin = F.greatest(F.col("index") * block, F.col("start"))
    end = F.least((F.col("index") + 1) * block, F.col("start") + F.col("size"))
    return spread.select(
        "source_no", "index", "start", (begin - F.col("start")).alias("from"), (end - begin).alias("words")
    )


def slots(targets: DataFrame, block: int, shard_slots: int = 1024, most: int = 2) -> DataFrame:
    """(shard, slot, source_no, index, round): the block that each slot of each output shard takes.

    A source gets as many slots as its target is blocks, rounded, and takes no
    block more than `most` times.
    """
    n_blocks = F.ceil(F.col("source_size") / block)
    wanted = F.round(F.col("target") * n_blocks / F.col("source_size")).cast("bigint")
    runs = (
        targets.filter("source_size > 0")
        .select("source_no", n_blocks.alias("n_blocks"), F.least(wanted, most * n_blocks).alias("n_slots"))
        .withColumn("run", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n_blocks") - 1, F.lit(_RUN).cast("bigint"))))
        .withColumn("round", F.explode(F.sequence(F.lit(0), F.lit(most - 1))))
        .filter("round * n_blocks < n_slots")
    )
    # A source's blocks come from many rows, and these are dealt out, so that a large source is made by many tasks.
    tasks = int(targets.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    last = F.least(F.col("run") + _RUN, F.col("n_blocks")) - 1
    each = runs.repartition(tasks, "source_no", "run", "round").withColumn("index", F.explode(F.sequence("run", last)))
    walked = permuted(each.drop("run"), ["source_no", "round"], "index", "place")
    # The last time round only takes the blocks that come first.
    taking = walked.filter(F.col("round") * F.col("n_blocks") + F.col("place") < F.col("n_slots"))
    dealt = permuted(taking.select("source_no", "round", "index"), [], "source_no, round, index", "number")
    return dealt.select(
        F.floor(F.col("number") / shard_slots).alias("shard"),
        (F.col("number") % shard_slots).alias("slot"),
        "source_no",
        "index",
        "round",
    )


def permuted(rows: DataFrame, by: Sequence[str], key: str, name: str) -> DataFrame:
    """Rows with `name`, the place from 0 that the digest of `by` and `key` has among those of the same `by`.

    A permutation of any number of rows. Each part of a group, by the digests'
    first digits, is ordered by itself; where it starts enters as a row that
    sorts before all others. There are at most 65,536 parts to add up.
    """
    keys = [*by, *[k.strip() for k in key.split(",")]]
    digest = F.md5(F.concat_ws("/", F.lit(name), *[F.col(k).cast("string") for k in keys]))
    hashed = rows.withColumn("digest", digest).withColumn("part", F.substring("digest", 1, _DIGITS))
    sums = hashed.groupBy(*by, "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy(*by).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(*by, "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    part = Window.partitionBy(*by, "part")
    within = part.orderBy(F.asc_nulls_first("digest"), *key.split(", "))
    placed = hashed.unionByName(starts, allowMissingColumns=True).withColumn(
        name, F.max("first").over(part.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)) + F.row_number().over(within) - 2
    )
    return placed.filter("digest is not null").drop("digest", "part", "first")


def mix(docs: DataFrame, block: int = 64, shard_slots: int = 1024) -> tuple[DataFrame, DataFrame]:
    """(documents, mixture).

    documents: (doc_id, source, size, text_hash, start, source_no, source_size, target) of every row of `docs`.
    mixture: (shard, slot, round, source_no, start, from, words), the tokens that
    each slot takes, `words` from place `from` of the document at `start` of its
    source. No document is taken more than twice.

    Blocks of 64 words keep small sources near their targets; training would use
    the context length. No rows give none; other columns are ignored.
    """
    placed = place(docs)
    targets = cut(source_targets(placed), "targets")
    number = targets.select(F.col("source").alias("of_source"), "source_no", "source_size", "target")
    numbered = placed.join(number, placed["source"].eqNullSafe(number["of_source"])).drop("of_source")
    documents = cut(numbered, "documents")
    # Both sides grow out of few rows, by whose size alone Spark would broadcast them.
    taking = slots(targets, block, shard_slots).hint("merge")
    mixture = taking.join(blocks(documents, block), ["source_no", "index"])
    return documents, mixture.select("shard", "slot", "round", "source_no", "start", "from", "words")


def taken(documents: DataFrame, mixture: DataFrame) -> DataFrame:
    """Every row of `documents` with `taken`, the tokens that the mixture takes of it, repeats counted."""
    sums = mixture.groupBy("source_no", "start").agg(F.sum("words").alias("words"))
    # Documents without tokens share a start with the next one.
    key = F.when(F.col("size") > 0, F.col("start")).alias("place")
    found = documents.withColumn("place", key).join(
        sums.select(F.col("source_no").alias("at_source"), F.col("start").alias("at"), "words"),
        (F.col("source_no") == F.col("at_source")) & (F.col("place") == F.col("at")),
        "left",
    )
    return found.drop("at_source", "at", "place").withColumn("taken", F.coalesce("words", F.lit(0))).drop("words")


def mixed_documents(docs: DataFrame, block: int = 64) -> DataFrame:
    """The mixture as documents with the columns of `docs`: a row per document and time round, with the words taken then.

    A document of which all words are taken is itself; one of which nothing is
    taken, or that has no words, is none. `n_chars`, where there is such a column, is the new text's.
    """
    documents, mixture = mix(docs, block)
    times = mixture.groupBy("source_no", "start", "from", "words").agg(F.count("*").alias("times"))
    spans = times.groupBy("source_no", "start").agg(F.sort_array(F.collect_list(F.struct("from", "words", "times"))).alias("spans"))
    # Columns of `docs` may have any name, so these get names of their own.
    names = ("mixed_doc", "mixed_source", "mixed_at", "mixed_size", "mixed_spans", "mixed_hash", "mixed_round", "mixed_words")
    doc, source, at, size, spans_of, hashed, round_no, words_of = (unused(docs.columns, name) for name in names)
    placed = (
        documents.filter("size > 0")
        .join(spans, ["source_no", "start"])
        .select("doc_id", "source", "text_hash", "size", "spans")
        .toDF(doc, source, at, size, spans_of)
    )
    # Rows that repeat are one text here, and as many places above; only texts that may repeat are compared.
    texts = docs.withColumn(hashed, F.xxhash64("text"))
    key = ["doc_id", "source", hashed]
    repeated = texts.groupBy(*key).agg(F.count("*").alias("copies")).filter("copies > 1").select(*key)
    some, others = told_apart(texts, key, repeated)
    texts = others.union(some.dropDuplicates(key))
    same = F.col("doc_id").eqNullSafe(F.col(doc)) & F.col("source").eqNullSafe(F.col(source)) & (F.col(hashed) == F.col(at))
    most = F.array_max(F.transform(spans_of, lambda s: s["times"]))
    rounds = texts.join(placed, same).withColumn(round_no, F.explode(F.sequence(F.lit(1).cast("bigint"), most)))
    now = F.filter(spans_of, lambda s: s["times"] >= F.col(round_no))
    n_now = F.aggregate(now, F.lit(0).cast("bigint"), lambda n, s: n + s["words"])
    words = F.regexp_extract_all("text", F.lit(WORD + r"[\x20\x09-\x0D]*"), F.lit(0))
    cuts = F.transform(now, lambda s: F.slice(words_of, s["from"].cast("int") + 1, s["words"].cast("int")))
    mixed = rounds.withColumn(words_of, F.when(n_now < F.col(size), words)).withColumn(
        "text", F.when(n_now < F.col(size), F.array_join(F.flatten(cuts), "")).otherwise(F.col("text"))
    )
    if "n_chars" in docs.columns:
        mixed = mixed.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return mixed.select(*docs.columns)


def taken_sql(block: int = 64) -> str:
    """DuckDB SQL for `taken(*mix(documents))`: the same places, targets and permutations, stated for each source at once."""
    return f"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size
  FROM documents),
parts AS (SELECT greatest(1, ceil(count(*) / {_TOGETHER}))::BIGINT AS n FROM sized),
numbered AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS source_no
  FROM sized GROUP BY source),
limited AS (
  SELECT *, {list(WEIGHTS)}[source_no % {len(WEIGHTS)} + 1] AS weight, 2 * source_size AS most FROM numbered),
levels AS (
  SELECT *, (1.5::DOUBLE * sum(source_size) OVER ()
    - coalesce(sum(most) OVER (ORDER BY most / weight, source_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY most / weight, source_no ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM limited),
targets AS (
  SELECT source, source_no, source_size, least(most::DOUBLE, max(level) OVER () * weight) AS target,
         ceil(source_size / {block})::BIGINT AS n_blocks FROM levels),
placed AS (
  SELECT doc_id, source, size, sum(size) OVER (PARTITION BY source ORDER BY part, doc_id NULLS FIRST, size
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)::BIGINT - size AS start
  FROM (SELECT *, (((coalesce(doc_id, 0) % {_SPREAD} + {_SPREAD}) % {_SPREAD}) * 7919 % {_SPREAD}) % n AS part
        FROM sized, parts)),
documents_at AS (
  SELECT p.*, source_no, source_size, target FROM placed p JOIN targets t ON p.source IS NOT DISTINCT FROM t.source),
wanted AS (
  SELECT source_no, n_blocks, least(round(target * n_blocks / source_size)::BIGINT, 2 * n_blocks) AS n_slots
  FROM targets WHERE source_size > 0),
walked AS (
  SELECT *, row_number() OVER (PARTITION BY source_no, round ORDER BY md5(concat_ws('/', 'place', source_no, round, index)), index) - 1 AS place
  FROM (SELECT *, unnest(range(0, n_blocks)) AS index FROM (SELECT *, unnest([0, 1]) AS round FROM wanted))),
taken_blocks AS (
  SELECT source_no, index, count(*) AS times FROM walked WHERE round * n_blocks + place < n_slots GROUP BY ALL),
pieces AS (
  SELECT source_no, start, size, unnest(range(start // {block}, (start + size - 1) // {block} + 1)) AS index
  FROM documents_at WHERE size > 0),
sums AS (
  SELECT source_no, start, sum(times * (least((index + 1) * {block}, start + size) - greatest(index * {block}, start)))
           ::BIGINT AS taken
  FROM pieces JOIN taken_blocks USING (source_no, index) GROUP BY ALL)
SELECT doc_id, size, source_size, target, CASE WHEN size > 0 THEN coalesce(taken, 0) ELSE 0 END AS taken
FROM documents_at LEFT JOIN sums USING (source_no, start)"""
