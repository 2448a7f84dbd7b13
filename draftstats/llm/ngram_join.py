"""Similarity join on the Jaccard coefficient of word n-grams, by T-occurrence search.

A document that is similar enough occurs in at least T of the inverted lists of
a query's shingles. Where the lists of all documents lie together, the search
merges the short ones, and probes the long ones by binary search for what the
short ones left (DivideSkip). To bring together only what may be similar:

1. Equal sets are one class. Of each class a prefix of the shingles, in order of their hashes, is
   counted over the corpus. Similar sets share a stated number of prefix
   shingles, so a class with fewer that occur elsewhere has no partner.
2. Of the others the rarest prefix shingles, by the counts, are short lists; partners share one.
3. Classes that share their longest list are put into chunks of bounded size. A task
   searches a chunk, or of two chunks the classes that share a list across.
4. What a task links is joined into connected components.

Each step keeps every pair that reaches the threshold: the result is exact, up to collisions of 64-bit hashes.
"""

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import blake2b
from itertools import groupby
from math import log2

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import batches_of, cut, drop_cut, told_apart, utf8
from .components import components
from .hash_counts import frequent_hashes, is_set
from .shingles import Shingler

# Shingles of the classes of one chunk, about.
CHUNK = 400_000
# log2 of the hashes that tell shingles of one class apart from shared ones, at most: 32 MB of bits.
_BITS = 28
# The weight of a probe against a merge, in the choice of long lists. A constant of the method.
_PROBE = 0.0085

_SHINGLED = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n", pa.int64()),
        ("digest", pa.binary()),
        ("key", pa.int64()),
        ("prefix", pa.list_(pa.int64())),
        ("text_hash", pa.int64()),
    ]
)
_SHINGLED_DDL = "doc_id bigint, n bigint, digest binary, key bigint, prefix array<bigint>, text_hash bigint"
_LINKED = pa.schema([("node", pa.binary()), ("parent", pa.binary()), ("n_links", pa.int64())])


@dataclass(frozen=True)
class Similarity:
    """Two sets link when 100 * intersection >= percent * union; sets of n-word shingles."""

    n: int = 5
    percent: int = 80

    def least_shared(self, size: int) -> int:
        """Of a set of this size, with any set it links with."""
        return -(-self.percent * size // 100)

    def shared_in_prefix(self, size: int) -> int:
        return max(1, self.least_shared(size) // 8)

    def prefix(self, size: int) -> int:
        return size - self.least_shared(size) + self.shared_in_prefix(size)

    def needed(self, n: Column) -> Column:
        """Prefix shingles that a set of n shares with any set it links with, at least: what the smallest such set promises."""
        smallest = F.ceil(n * self.percent / 100)
        return F.greatest(F.lit(1), F.floor(F.ceil(smallest * self.percent / 100) / 8))

    def overlap(self, size: int, other: np.ndarray) -> np.ndarray:
        """Shared shingles that make sets of these sizes link."""
        return -(-self.percent * (size + other) // (100 + self.percent))


def linked_documents(docs: DataFrame, similarity: Similarity = Similarity()) -> DataFrame:
    """(doc_id, n_shingles, component_id, n_links) of every row of `docs`.

    `component_id` is the smallest doc_id reachable by links, `n_links` the
    number of rows the document links with. A text without words, or a null, has
    no shingles and links with nothing; its component is itself. Repeated rows
    link with each other. A null id is no component's id while there is another.
    No rows give none; other columns are ignored.
    """
    return _linked(docs, similarity)[0]


def _linked(docs: DataFrame, similarity: Similarity) -> tuple[DataFrame, list[DataFrame]]:
    """The result of `linked_documents`, and the tables that it reads."""
    texts = _texts(docs).select("doc_id", "text", "text_hash")
    shingled = cut(texts.mapInArrow(_shingle(similarity), _SHINGLED_DDL), "shingles")
    # A class is read again from one row, told by its id and text: others may share the id, or have none.
    row = F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")
    classes = (
        shingled.filter("n > 0")
        .groupBy("digest")
        .agg(F.min(row).alias("row"), F.count("*").alias("copies"))
        .select("digest", F.col("row.doc_id").alias("first_id"), F.col("row.text_hash").alias("first_hash"), "copies")
    )
    lists = cut(_short_lists(shingled, similarity), "lists")
    chunks = cut(_chunks(lists), "chunks")
    tasks = _tasks(lists, chunks)
    records = _records(docs, shingled, classes, chunks, similarity)
    linked = cut(
        tasks.join(records, "key")
        .repartition("a", "b")
        .sortWithinPartitions("a", "b", "n", "digest")
        .select("a", "b", "chunk", "digest", "copies", "shingles")
        .mapInArrow(_search(similarity), "node binary, parent binary, n_links bigint"),
        "links",
    )
    roots = cut(components(linked.select(F.col("node").alias("a"), F.col("parent").alias("b"))), "roots")
    links = linked.groupBy(F.col("node").alias("digest")).agg(F.sum("n_links").alias("outside"))
    rooted = classes.join(roots.withColumnRenamed("node", "digest"), "digest", "left").join(links, "digest", "left")
    firsts = classes.join(roots.withColumnRenamed("node", "digest"), "digest").groupBy("root").agg(F.min("first_id").alias("reached"))
    known = rooted.join(firsts, "root", "left").select(
        F.col("digest").alias("of_class"),
        F.coalesce("reached", "first_id").alias("component"),
        (F.col("copies") - 1 + F.coalesce("outside", F.lit(0))).alias("linked"),
    )
    found = shingled.select("doc_id", "n", "digest").join(known, F.col("digest") == F.col("of_class"), "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.coalesce("component", "doc_id").alias("component_id"),
        F.coalesce("linked", F.lit(0)).alias("n_links"),
    )
    return found, [shingled, lists, chunks, linked, roots]


def one_of_each(docs: DataFrame, similarity: Similarity = Similarity()) -> DataFrame:
    """`docs` without documents that reach one with a smaller id by links. Rows that repeat an id stay together."""
    found, tables = _linked(docs, similarity)
    later = found.filter(F.col("component_id") < F.col("doc_id"))
    kind = docs.schema["doc_id"].dataType
    gone = cut(later.select(F.col("doc_id").cast(kind).alias("gone_id")).distinct(), "gone")
    for table in tables:
        drop_cut(table)
    some, others = told_apart(docs, ["doc_id"], gone)
    return others.union(some.join(gone, some["doc_id"] == gone["gone_id"], "left_anti"))


def _shingle(similarity: Similarity):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(similarity.n)

        def rows() -> Iterator[tuple]:
            for batch in batches:
                ids, hashes = batch.column(0).to_pylist(), batch.column(2).to_pylist()
                for doc_id, text, text_hash in zip(ids, utf8(batch.column(1)), hashes, strict=True):
                    found = shingler.shingles(text)
                    digest = _digest(found)
                    key = int.from_bytes(digest[:8], "little", signed=True)
                    prefix = found[: similarity.prefix(len(found))].view(np.int64) if len(found) else []
                    yield doc_id, len(found), digest, key, prefix, text_hash

        return batches_of(_SHINGLED, rows(), 2_000)

    return run


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.xxhash64("text").alias("text_hash"))


def _digest(found: np.ndarray) -> bytes:
    return blake2b(found.tobytes(), digest_size=16).digest()


def _short_lists(shingled: DataFrame, similarity: Similarity) -> DataFrame:
    """(key, n, shingle): the rarest shared prefix shingles of each class that may have a partner.

    `key` is part of the class's digest; classes that share a key by chance
    are taken together and told apart by the search.
    """
    spark = shingled.sparkSession
    n_entries = shingled.agg(F.coalesce(F.sum(F.size("prefix")), F.lit(0))).first()[0]
    bits = min(_BITS, max(16, (8 * n_entries).bit_length()))
    mask = (1 << bits) - 1
    # Most shingles occur once. What the bits let through of these is dropped by the counts.
    shared_bits = spark.sparkContext.broadcast(frequent_hashes(shingled.select("prefix"), _masked(mask), 2, bits))

    def of_others(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shingles = batch.column(3)
            held = shingles.flatten().to_numpy()
            known = is_set(shared_bits.value, (held & mask).astype(np.uint32))
            edges = np.append(0, np.cumsum(known))[shingles.offsets.to_numpy() - shingles.offsets[0].as_py()]
            left = pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(held[known]))
            some = pa.array(np.diff(edges) > 0)
            yield pa.record_batch([*batch.columns[:3], left], names=["key", "digest", "n", "prefix"]).filter(some)

    rows = shingled.filter("n > 0").select("key", "digest", "n", "prefix")
    left = rows.mapInArrow(of_others, "key bigint, digest binary, n bigint, prefix array<bigint>")
    prefixes = left.groupBy("key", "digest", "n").agg(F.first("prefix").alias("prefix"))
    entries = prefixes.select("key", "n", F.explode("prefix").alias("shingle"))
    counts = entries.groupBy("shingle").agg(F.count("*").alias("classes")).filter("classes > 1")
    shared = entries.join(counts, "shingle")
    of_class = F.count("*").over(Window.partitionBy("key"))
    rarest = F.row_number().over(Window.partitionBy("key").orderBy("classes", "shingle"))
    needed = similarity.needed(F.col("n"))
    return (
        shared.withColumn("shared", of_class)
        .withColumn("rank", rarest)
        .filter((F.col("shared") >= needed) & (F.col("rank") <= F.col("shared") - needed + 1))
        .select("key", "n", "shingle")
    )


def _masked(mask: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        for batch in batches:
            yield (batch.column(0).flatten().to_numpy() & mask).astype(np.uint32)

    return run


def _chunks(lists: DataFrame) -> DataFrame:
    """(key, chunk) of every class that shares a list.

    A class's home is the longest of its lists, so the classes of a list that
    many share lie in as few chunks as they fill, of which any two are searched
    together. Homes of many shingles are dealt into several chunks by a hash.
    """
    lengths = lists.groupBy("shingle").agg(F.count("*").alias("classes")).filter("classes > 1")
    placed = lists.join(lengths, "shingle").groupBy("key", "n")
    homes = placed.agg(F.max(F.struct("classes", "shingle")).alias("longest")).select("key", "n", F.col("longest.shingle").alias("home"))
    sizes = homes.groupBy("home").agg(F.ceil(F.sum("n") / CHUNK).alias("parts"))
    return homes.join(sizes, "home").select(
        "key", F.xxhash64("home", F.pmod(F.xxhash64("key"), F.col("parts"))).alias("chunk")
    )


def _tasks(lists: DataFrame, chunks: DataFrame) -> DataFrame:
    """(a, b, key, chunk): the classes to be searched together, in chunk a = b or across chunks a < b that share a list."""
    placed = lists.join(chunks, "key").select("key", "shingle", "chunk")
    met = placed.select("shingle", F.col("chunk").alias("other")).distinct()
    return (
        placed.join(met, "shingle")
        .select(F.least("chunk", "other").alias("a"), F.greatest("chunk", "other").alias("b"), "key", "chunk")
        .distinct()
    )


def _records(
    docs: DataFrame, shingled: DataFrame, classes: DataFrame, chunks: DataFrame, similarity: Similarity
) -> DataFrame:
    """(key, digest, n, copies, shingles): the whole sets of the classes in `chunks`, from one document of each."""
    wanted = (
        shingled.filter("n > 0")
        .select("key", "digest")
        .distinct()
        .join(chunks.select("key").distinct(), "key")
        .join(classes, "digest")
        .select("first_id", "first_hash", "key", F.col("digest").alias("of_class"), "copies")
    )
    wanted = cut(wanted, "wanted")
    some, _ = told_apart(_texts(docs), ["doc_id", "text_hash"], wanted.select("first_id", "first_hash"))
    same = (F.col("text_hash") == F.col("first_hash")) & F.col("doc_id").eqNullSafe(F.col("first_id"))
    found = some.join(wanted.hint("shuffle_hash"), same)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(similarity.n)
        for batch in batches:
            keep, sets = [], []
            for digest, text in zip(batch.column(1).to_pylist(), utf8(batch.column(3)), strict=True):
                shingles = shingler.shingles(text)
                # Rows that repeat an id may have other texts.
                keep.append(_digest(shingles) == digest)
                sets.append(shingles.tobytes() if keep[-1] else None)
            columns = [batch.column(0), batch.column(1).cast(pa.binary()), batch.column(2), pa.array(sets, pa.binary())]
            yield pa.record_batch(columns, names=["key", "digest", "copies", "shingles"]).filter(pa.array(keep, pa.bool_()))

    sets = found.select("key", "of_class", "copies", "text").mapInArrow(
        run, "key bigint, digest binary, copies bigint, shingles binary"
    )
    return sets.withColumn("n", F.length("shingles"))


def _search(similarity: Similarity):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def records() -> Iterator[tuple]:
            for batch in batches:
                yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)

        def rows() -> Iterator[tuple]:
            for (a, b), members in groupby(records(), key=lambda r: r[:2]):
                # Rows that repeat an id give a class twice.
                distinct = {r[3]: r for r in members}
                yield from _links(list(distinct.values()), a != b, similarity)

        return batches_of(_LINKED, rows())

    return run


def _links(members: list[tuple], across: bool, similarity: Similarity) -> Iterator[tuple]:
    """(node, parent, n_links) of the linked members: a forest over them, and the documents each links with here."""
    members.sort(key=lambda r: (len(r[5]), r[3]))
    sets = [np.frombuffer(r[5], np.uint64) for r in members]
    chunk = np.array([r[2] for r in members])
    copies = np.array([r[4] for r in members])
    parents, n_links = list(range(len(members))), np.zeros(len(members), np.int64)

    def root(i: int) -> int:
        while parents[i] != i:
            parents[i] = parents[parents[i]]
            i = parents[i]
        return i

    index = InvertedLists(sets)
    for query in range(len(members)):
        found = index.search(query, similarity)
        if across:
            found = found[chunk[found] != chunk[query]]
        n_links[query] += copies[found].sum()
        n_links[found] += copies[query]
        for other in found:
            low, high = sorted((root(query), root(int(other))))
            parents[high] = low
    for i in np.flatnonzero(n_links):
        yield members[i][3], members[root(int(i))][3], int(n_links[i])


class InvertedLists:
    """For every shingle of some sets the sets that hold it, in order. The sets are in order of their sizes."""

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = np.array([len(s) for s in sets], np.int64)
        owners = np.repeat(np.arange(len(sets)), self.sizes)
        shingles = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
        _, list_of, lengths = np.unique(shingles, return_inverse=True, return_counts=True)
        order = np.argsort(list_of, kind="stable")
        self.owners = owners[order]
        self.ends = np.cumsum(lengths)
        self.lengths = lengths
        self.lists_of = np.split(list_of, np.cumsum(self.sizes)[:-1]) if sets else []

    def search(self, query: int, similarity: Similarity) -> np.ndarray:
        """The sets after `query` that link with it."""
        lists = self.lists_of[query]
        # Lists of the query alone are of no use; it is itself in all the others.
        lists = lists[self.lengths[lists] > 1]
        size = int(self.sizes[query])
        least = similarity.least_shared(size)
        if len(lists) < least:
            return np.zeros(0, np.int64)
        lists = lists[np.argsort(self.lengths[lists], kind="stable")]
        n_long = min(len(lists), least - 1, int(least / (_PROBE * log2(max(2, int(self.lengths[lists[-1]]))) + 1)))
        short, long = lists[: len(lists) - n_long], lists[len(lists) - n_long :]
        merged = [self.owners[self.ends[i] - self.lengths[i] : self.ends[i]] for i in short]
        found, shared = np.unique(np.concatenate(merged), return_counts=True) if merged else (np.zeros(0, np.int64),) * 2
        left = (found > query) & (shared >= least - n_long)
        found, shared = found[left], shared[left]
        left = 100 * size >= similarity.percent * self.sizes[found]
        found, shared = found[left], shared[left]
        needed = similarity.overlap(size, self.sizes[found])
        for k, i in enumerate(long):
            if not len(found):
                break
            members = self.owners[self.ends[i] - self.lengths[i] : self.ends[i]]
            at = np.searchsorted(members, found)
            shared = shared + (members[np.minimum(at, len(members) - 1)] == found)
            # What cannot reach its threshold in the lists that are left is given up.
            left = shared + (len(long) - k - 1) >= needed
            if not left.all():
                found, shared, needed = found[left], shared[left], needed[left]
        return found[shared >= needed]


def linked_documents_sql(similarity: Similarity = Similarity()) -> str:
    """DuckDB SQL for `linked_documents(documents)`: all pairs that share a shingle, counted."""
    n, percent = similarity.n, similarity.percent
    return f"""
WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, unnest(list_transform(range(1, greatest(len(words) - {n - 1}, least(len(words), 1)) + 1),
                                                lambda i: array_to_string(words[i:i + {n - 1}], ' '))) AS shingle
  FROM worded),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
links AS (
  SELECT a.doc_id AS x, b.doc_id AS y FROM shingles a JOIN shingles b USING (shingle)
  JOIN sizes s ON s.doc_id = a.doc_id JOIN sizes t ON t.doc_id = b.doc_id
  WHERE a.doc_id <> b.doc_id AND 100 * s.n >= {percent} * t.n AND 100 * t.n >= {percent} * s.n
  GROUP BY a.doc_id, b.doc_id, s.n, t.n HAVING 100 * count(*) >= {percent} * (s.n + t.n - count(*))),
reached AS (SELECT x, y FROM links UNION SELECT r.x, l.y FROM reached r JOIN links l ON l.x = r.y)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, least(d.doc_id, r.first) AS component_id, coalesce(l.n, 0) AS n_links
FROM documents d LEFT JOIN sizes s USING (doc_id)
LEFT JOIN (SELECT x AS doc_id, min(y) AS first FROM reached GROUP BY x) r USING (doc_id)
LEFT JOIN (SELECT x AS doc_id, count(*) AS n FROM links GROUP BY x) l USING (doc_id)"""
