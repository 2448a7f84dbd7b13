"""Exact removal of byte strings that repeat anywhere in the corpus.

A window of a given size is removed where it has been seen before, in an earlier
document or earlier in the same. Which windows are equal is read from the
Burrows-Wheeler transform and common prefixes of collections of short texts
(`collection_bwt`). The short texts are made so that equal windows come together:

1. A window's anchor is the least hash among its k-grams, so equal windows have equal anchors at
   equal places. Windows with one anchor follow each other; they and their bytes are an instance.
2. Anchors that occur once in the corpus leave no window to remove.
3. Of instances with equal bytes the first is kept; all windows of the others have been seen.
4. A window holds its anchor and, in one of four ways, at least three quarters of its other bytes
   around it. Different bytes that have none of these contexts in common with others leave no window to remove.
5. What is left of different bytes with one anchor, which overlap in part, are a collection's texts.

Every step keeps all equal windows together; nothing is sampled.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_128_digest

from .collection_bwt import equal_windows
from .common import batches_of, cut, drop_cut, utf8
from .shingles import mixed

#: Size of the k-grams among which anchors are chosen. A larger one is shared by chance less often and chosen more often.
GRAM = 32
#: Texts of one collection, and different texts of one anchor up to which they are one.
COLLECTION = 1_000
SMALL_GROUP = 1_000
# Windows of a very long text that are looked at together, and bytes up to which short texts are.
_SEGMENT = 1 << 20
_TOGETHER = 1 << 17
_PLACE = np.uint64((1 << 24) - 1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_CONTEXT = np.uint64(0xD6E8FEB86659FD93)
_BYTES = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))

_ANCHORED = pa.schema([("did", pa.int64()), ("tkey", pa.int64()), ("anchors", pa.list_(pa.int64()))])
_INSTANCE = pa.schema(
    [
        ("anchor", pa.int64()),
        ("digest", pa.binary()),
        ("did", pa.int64()),
        ("tkey", pa.int64()),
        ("start", pa.int64()),
        ("contexts", pa.list_(pa.int64())),
        ("length", pa.int64()),
    ]
)
_INSTANCE_DDL = (
    "anchor bigint, digest binary, did bigint, tkey bigint, start bigint, contexts array<bigint>, length bigint"
)
_TEXT = pa.schema(
    [
        ("anchor", pa.int64()),
        ("texts", pa.int64()),
        ("did", pa.int64()),
        ("tkey", pa.int64()),
        ("start", pa.int64()),
        ("bytes", pa.binary()),
    ]
)
_TEXT_DDL = "anchor bigint, texts bigint, did bigint, tkey bigint, start bigint, bytes binary"
_RANGE = pa.schema([("did", pa.int64()), ("tkey", pa.int64()), ("start", pa.int64()), ("stop", pa.int64())])
_RANGE_DDL = "did bigint, tkey bigint, start bigint, stop bigint"
_WINDOW = pa.schema([("digest", pa.binary()), ("did", pa.int64()), ("tkey", pa.int64()), ("start", pa.int64())])
_KEPT = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_bytes", pa.int64()),
        ("n_removed", pa.int64()),
        ("n_spans", pa.int64()),
        ("kept", pa.binary()),
    ]
)


def removed(docs: DataFrame, size: int = 100) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept) of every row of `docs`: kept has the bytes that remain.

    Documents come in order of doc_id, nulls first; of documents with one id, in
    order of a hash of the text. Rows that repeat id and text are one document, and get the same result each. Null
    texts are empty. No rows give none; other columns are ignored.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    # A null id is before all others.
    did = F.coalesce(F.col("doc_id").cast("bigint"), F.lit(-(1 << 63)))
    rows = docs.select(did.alias("did"), F.xxhash64(text).alias("tkey"), F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("text"))
    ranges = cut(_ranges(rows, size), "ranges")
    spans = ranges.groupBy("did", "tkey").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))
    joined = rows.join(spans.hint("shuffle_hash"), ["did", "tkey"], "left")
    return joined.select("doc_id", "text", "spans.start", "spans.stop").mapInArrow(
        _keep, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary"
    )


def anchored_runs(text: np.ndarray, size: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(first, last, at, anchor): windows first .. last have the anchor, which stands at `at`. For parts of the text, one after the other."""
    for first, last, at, hashes, begin in _segments(text, size):
        yield first + begin, last + begin, at + begin, hashes[at].view(np.int64)


def _segments(text: np.ndarray, size: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]]:
    for begin in range(0, max(0, len(text) - size + 1), _SEGMENT):
        part = text[begin : begin + _SEGMENT + size - 1]
        yield *_runs(part, size, np.array([len(part)])), begin


def _runs(part: np.ndarray, size: int, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first, last, at, hashes): windows first .. last have their anchor at `at`; the hashes of all k-grams. No window goes beyond the end of its text."""
    hashes = _gram_hashes(part)
    wide = size - GRAM + 1
    # The least hash, and of equal ones the first, with its place: doubling the number of grams looked at.
    least = (hashes & ~_PLACE) | np.arange(len(hashes), dtype=np.uint64)
    reach = 1
    while 2 * reach <= wide:
        least = np.minimum(least[:-reach], least[reach:])
        reach *= 2
    if reach < wide:
        least = np.minimum(least[: reach - wide], least[wide - reach :])
    place = least & _PLACE
    begins = np.ones(len(place), bool)
    begins[1:] = place[1:] != place[:-1]
    # From a text's last window on nothing is a window of it, up to the next text.
    begins[ends[:-1]] = True
    begins[ends[:-1] - size + 1] = True
    first = np.flatnonzero(begins)
    last = np.append(first[1:], len(place)) - 1
    if len(ends) > 1:
        inside = first <= ends[np.searchsorted(ends, first, "right")] - size
        first, last = first[inside], last[inside]
    return first, last, place[first].astype(np.int64), hashes


def _parts(texts: list[np.ndarray], size: int) -> Iterator[tuple]:
    """(part, begins, numbers, before, first, last, at, hashes) of all texts with a window, the short ones several at a time.

    Text numbers[i] begins at begins[i] of the part, and if it is very long, its first `before` bytes are in other parts.
    """
    held: list[int] = []
    room = _TOGETHER
    for number, text in enumerate(texts):
        if len(text) >= _TOGETHER:
            for first, last, at, hashes, before in _segments(text, size):
                yield text[before : before + _SEGMENT + size - 1], np.zeros(1, np.int64), np.array([number]), before, first, last, at, hashes
        elif len(text) >= size:
            if len(text) > room:
                yield _together(texts, held, size)
                held, room = [], _TOGETHER
            held.append(number)
            room -= len(text)
    if held:
        yield _together(texts, held, size)


def _together(texts: list[np.ndarray], numbers: list[int], size: int) -> tuple:
    part = np.concatenate([texts[i] for i in numbers])
    ends = np.cumsum([len(texts[i]) for i in numbers])
    return part, np.append(0, ends[:-1]), np.array(numbers), 0, *_runs(part, size, ends)


def _gram_hashes(text: np.ndarray) -> np.ndarray:
    """A hash of every k-gram, from hashes of its halves."""
    hashes, length = _BYTES[text], 1
    while length < GRAM:
        power = np.uint64(pow(int(_BASE), length, 1 << 64))
        longer = hashes[:-length] * power
        longer += hashes[length:]
        hashes = longer
        length *= 2
    return mixed(hashes)


def _ranges(rows: DataFrame, size: int) -> DataFrame:
    """(did, tkey, start, stop): bytes to be removed."""
    anchored = cut(rows.select("did", "tkey", "text").mapInArrow(_anchors(size), "did bigint, tkey bigint, anchors array<bigint>"), "anchors")
    # One number for a document is enough to tell it which of its anchors are shared; more of them do no harm.
    each = anchored.select(F.xxhash64("did", "tkey").alias("doc"), F.explode("anchors").alias("anchor"))
    shared = each.groupBy("anchor").agg(F.count("*").alias("instances")).filter("instances > 1").select("anchor")
    wanted = cut(each.join(shared.hint("shuffle_hash"), "anchor").groupBy("doc").agg(F.collect_set("anchor").alias("anchors")), "shared-anchors")
    drop_cut(anchored)
    texts = rows.select("did", "tkey", F.xxhash64("did", "tkey").alias("doc"), "text").join(wanted.hint("shuffle_hash"), "doc")
    instances = cut(texts.select("did", "tkey", "text", "anchors").mapInArrow(_instances(size), _INSTANCE_DDL), "instances")
    drop_cut(wanted)

    place = F.struct("did", "tkey", "start")
    firsts = cut(instances.groupBy("anchor", "digest").agg(F.min(place).alias("first"), F.max("length").alias("length"), F.max("contexts").alias("contexts")), "firsts")
    known = firsts.withColumnRenamed("first", "seen")
    again = instances.select("anchor", "digest", "did", "tkey", "start").join(known, ["anchor", "digest"])
    seen = cut(
        again.filter(place > F.col("seen")).select("did", "tkey", "start", (F.col("start") + F.col("length")).alias("stop")),
        "seen",
    )
    contexts = firsts.select("anchor", "digest", F.explode("contexts").alias("context"))
    common = contexts.groupBy("context").agg(F.count("*").alias("texts")).filter("texts > 1").select("context")
    alike = contexts.join(common, "context", "left_semi").select("anchor", "digest").distinct()
    left = cut(firsts.join(alike, ["anchor", "digest"]).select("anchor", "first.*", "length"), "alike")
    several = left.join(left.groupBy("anchor").agg(F.count("*").alias("texts")), "anchor")
    drop_cut(instances)
    asked = several.groupBy("did", "tkey").agg(F.collect_list(F.struct("anchor", "texts", "start", "length")).alias("asked"))
    sources = rows.select("did", "tkey", "text").join(asked.hint("shuffle_hash"), ["did", "tkey"])
    pieces = sources.select("did", "tkey", "text", "asked.anchor", "asked.texts", "asked.start", "asked.length")
    # Rows that repeat are one document.
    texts = cut(pieces.mapInArrow(_texts, _TEXT_DDL).dropDuplicates(["anchor", "did", "tkey", "start"]), "texts")
    small = (
        texts.filter(F.col("texts") <= SMALL_GROUP)
        .select("anchor", "did", "tkey", "start", "bytes")
        .repartition("anchor")
        .sortWithinPartitions("anchor")
        .mapInArrow(_collections(size), _RANGE_DDL)
    )
    # The many different texts of a frequent anchor don't come together in a task: their windows do, by digest,
    # with one row per window and task.
    windows = texts.filter(F.col("texts") > SMALL_GROUP).select("did", "tkey", "start", "bytes").mapInArrow(
        _windows(size), "digest binary, did bigint, tkey bigint, start bigint"
    )
    earliest = windows.groupBy("digest").agg(F.min(place).alias("seen"))
    large = windows.join(earliest, "digest").filter(place > F.col("seen")).select(
        "did", "tkey", "start", (F.col("start") + size).alias("stop")
    )
    return seen.union(small).union(large)


def _anchors(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of, anchors = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
            for _, begins, numbers, _, first, _, at, hashes in _parts(list(utf8(batch.column(2))), size):
                of.append(numbers[np.searchsorted(begins, first, "right") - 1])
                anchors.append(hashes[at])
            of, anchors = np.concatenate(of), np.concatenate(anchors).view(np.int64)
            order = np.lexsort((anchors, of))
            of, anchors = of[order], anchors[order]
            # Once each, and once more if the text itself repeats it, however often.
            third = np.zeros(len(of), bool)
            third[2:] = (of[2:] == of[:-2]) & (anchors[2:] == anchors[:-2])
            of, anchors = of[~third], anchors[~third]
            numbers, counts = np.unique(of, return_counts=True)
            rows = pa.array(numbers)
            lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(counts)), pa.int32()), pa.array(anchors))
            yield pa.record_batch([batch.column(0).take(rows), batch.column(1).take(rows), lists], schema=_ANCHORED)

    return run


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[tuple]:
        for batch in batches:
            for i, text in enumerate(utf8(batch.column(2))):
                did, tkey = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
                content = text.tobytes()
                for anchor, texts, start, length in zip(*(batch.column(c)[i].as_py() for c in (3, 4, 5, 6)), strict=True):
                    yield anchor, texts, did, tkey, start, content[start : start + length]

    return batches_of(_TEXT, rows())


def _contexts(hashes: np.ndarray, first: np.ndarray, stop: np.ndarray, at: np.ndarray, size: int) -> pa.ListArray:
    """Hashes of the bytes around each anchor of which each window in first .. stop has at least one whole."""
    quarter = (size - GRAM) // 4
    wide = GRAM + 3 * quarter
    out, whole = np.zeros((len(at), 4), np.uint64), np.zeros((len(at), 4), bool)
    for before in range(4):
        begin = at - before * quarter
        there = np.flatnonzero((first <= begin) & (begin + wide <= stop))
        begin = begin[there]
        hashed = np.full(len(there), before, np.uint64)
        # All of its bytes are in k-grams that follow each other, the last of which may overlap.
        for offset in (*range(0, wide - GRAM, GRAM), wide - GRAM):
            hashed = mixed(hashed * _CONTEXT + hashes[begin + offset])
        out[there, before], whole[there, before] = hashed, True
    edges = np.append(0, np.cumsum(whole.sum(axis=1)))
    return pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(out[whole].view(np.int64)))


def _instances(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # An anchor that one of the texts shares with others is shared by all that have it.
            wanted = np.unique(batch.column(3).flatten().to_numpy(zero_copy_only=False))
            for part, begins, numbers, before, first, last, at, hashes in _parts(list(utf8(batch.column(2))), size):
                anchors = hashes[at].view(np.int64)
                some = np.flatnonzero(wanted[np.minimum(np.searchsorted(wanted, anchors), len(wanted) - 1)] == anchors)
                first, stop, at, anchors = first[some], last[some] + size, at[some], anchors[some]
                content = part.tobytes()
                digests = [xxh3_128_digest(content[begin:end]) for begin, end in zip(first.tolist(), stop.tolist(), strict=True)]
                of = np.searchsorted(begins, first, "right") - 1
                rows = pa.array(numbers[of])
                columns = [
                    pa.array(anchors), pa.array(digests, pa.binary()), batch.column(0).take(rows), batch.column(1).take(rows),
                    pa.array(first - begins[of] + before), _contexts(hashes, first, stop, at, size), pa.array(stop - first),
                ]
                yield pa.record_batch(columns, schema=_INSTANCE)

    return run


def _collections(size: int):
    """Ranges of windows that an earlier text of the collection has. Texts of one anchor lie together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            held, last = [], None
            for batch in batches:
                for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    if len(held) >= COLLECTION and row[0] != last:
                        yield from _seen_in(held, size)
                        held = []
                    held.append(row[1:])
                    last = row[0]
            if held:
                yield from _seen_in(held, size)

        return batches_of(_RANGE, rows())

    return run


def _seen_in(texts: list[tuple], size: int) -> Iterator[tuple]:
    # In order of their places, so that the first of equal windows is the one of the least text.
    texts.sort(key=lambda t: t[:3])
    owners, offsets, classes = equal_windows([t[3] for t in texts], size)
    order = np.lexsort((offsets, owners, classes))
    owners, offsets, classes = owners[order], offsets[order], classes[order]
    later = np.flatnonzero(classes[1:] == classes[:-1]) + 1
    owners, offsets = owners[later], offsets[later]
    order = np.lexsort((offsets, owners))
    owners, offsets = owners[order], offsets[order]
    breaks = np.flatnonzero((np.diff(owners) != 0) | (np.diff(offsets) != 1)) + 1
    for first, end in zip(np.r_[0, breaks], np.r_[breaks, len(owners)], strict=True):
        if first < end:
            did, tkey, start, _ = texts[owners[first]]
            yield did, tkey, start + int(offsets[first]), start + int(offsets[end - 1]) + size


def _windows(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                for did, tkey, start, held in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    for offset in range(len(held) - size + 1):
                        yield xxh3_128_digest(held[offset : offset + size]), did, tkey, start + offset

        return batches_of(_WINDOW, rows())

    return run


def _keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[tuple]:
        for batch in batches:
            for i, text in enumerate(utf8(batch.column(1))):
                gone = np.zeros(len(text) + 1, np.int64)
                starts, stops = batch.column(2)[i], batch.column(3)[i]
                if starts.is_valid:
                    np.add.at(gone, starts.values.to_numpy(), 1)
                    np.add.at(gone, stops.values.to_numpy(), -1)
                gone = np.cumsum(gone)[:-1] > 0
                n_spans = int(gone[:1].sum() + np.count_nonzero(gone[1:] & ~gone[:-1]))
                yield batch.column(0)[i].as_py(), len(text), int(gone.sum()), n_spans, text[~gone].tobytes()

    return batches_of(_KEPT, rows(), 500)
