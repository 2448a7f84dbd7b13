"""Bounded-space online packing: a fixed number of open windows a partition.

Documents are encoded and placed as they come, in one pass over the texts. A
piece goes into the open window it fits best; where it fits none and no further
window may open, the fullest one is topped up with the start of the piece and
emitted. What is open at the end of a partition is handed on with its ids and
packed again, some partitions at a time, until one task holds the last windows.
"""

import os
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batches_of, cut

END = 1
# Windows that a partition keeps open, and partitions whose open windows one task packs again.
OPEN = 64
MERGED = 64
# Distinct words whose ids a task keeps at hand, and bytes of texts it encodes at a time.
_KNOWN = 400_000
_BYTES_AT_ONCE = 8 << 20
# Letters to every Unicode version that stay one letter each in lower case, so not U+0130.
_LETTERS = "A-Za-zÀ-ÖØ-öø-įı-ɏ"

_PIECE = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"
_HANDED_ON = "ids binary, part bigint, place bigint"
_SCHEMA = pa.schema(
    [(name.split()[0], pa.binary() if name.endswith("binary") else pa.int64()) for name in f"{_PIECE}, {_HANDED_ON}".split(", ")]
)


class Encoder:
    """Ids of whole texts, for tokenizers that split texts at blanks, drop these and end words with a suffix.

    No token spans a blank, so the ids of a text are those of its chunks between
    ASCII blanks one after the other. Most chunks are a word of letters, some
    with a mark after it, which is a word of its own to the tokenizer; case does
    not matter to it. The library is asked for each distinct word once.
    """

    def __init__(self, path: str):
        # Cores are Spark's to share out.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self._library = tokenizers.Tokenizer.from_file(path)
        suffix = self._library.model.end_of_word_suffix or ""
        ends = [i for token, i in self._library.get_vocab(False).items() if suffix and token.endswith(suffix)]
        self._ends = np.zeros(self._library.get_vocab_size() + 1, bool)
        self._ends[ends] = True
        self._forget()

    def encode(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """Each text's ids; a null is empty."""
        lists = pc.ascii_split_whitespace(pc.fill_null(texts, "").cast(pa.large_string()))
        chunks = lists.flatten().dictionary_encode()
        words, marks = _words(chunks.dictionary)
        if len(self._codes) > _KNOWN:
            self._forget()
        words, marks = self._coded(words), self._coded(marks)
        # A chunk is its word and its mark, of which either may be empty.
        codes = np.stack([words, marks], 1)[chunks.indices.to_numpy()].ravel()
        first, n = self._starts[codes], self._starts[codes + 1] - self._starts[codes]
        ends = np.cumsum(n)
        ids = self._ids[np.arange(n.sum()) + np.repeat(first - ends + n, n)]
        edges = np.append(0, ends)[2 * (lists.offsets.to_numpy() - lists.offsets[0].as_py())]
        for i, j in zip(edges[:-1], edges[1:], strict=True):
            yield ids[i:j]

    def _forget(self) -> None:
        self._codes = {"": 0}
        self._ids, self._starts = np.zeros(0, "<u4"), np.zeros(2, np.int64)

    def _coded(self, words: pa.Array) -> np.ndarray:
        found = words.dictionary_encode()
        distinct = found.dictionary.to_pylist()
        new = [word for word in distinct if word not in self._codes]
        # Marks and the like are few; words of letters take one call together.
        for some, encode in (([w for w in new if w.isalpha()], self._together), ([w for w in new if not w.isalpha()], self._alone)):
            ids, sizes = encode(some)
            self._codes.update(zip(some, range(len(self._codes), len(self._codes) + len(some)), strict=True))
            self._starts = np.append(self._starts, self._starts[-1] + np.cumsum(sizes))
            self._ids = np.append(self._ids, ids)
        known = np.fromiter(map(self._codes.__getitem__, distinct), np.int64, len(distinct))
        return known[found.indices.to_numpy()]

    def _together(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        (found,) = self._library.encode_batch_fast([" ".join(words)], add_special_tokens=False)
        ids = np.array(found.ids, "<u4")
        ends = np.flatnonzero(self._ends[ids]) + 1
        # One id ends each word, unless one is several to the tokenizer, as some letters in lower case are.
        return (ids, np.diff(ends, prepend=0)) if len(ends) == len(words) else self._alone(words)

    def _alone(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [encoding.ids for encoding in self._library.encode_batch_fast(words, add_special_tokens=False)]
        return np.array([i for ids in found for i in ids], "<u4"), np.array([len(ids) for ids in found], np.int64)


def _words(chunks: pa.Array) -> tuple[pa.Array, pa.Array]:
    """The word of each chunk, and the mark after it or nothing. Chunks that are not letters and a mark stay whole."""
    closed = pc.match_substring_regex(chunks, f"^[{_LETTERS}]+[.,;:!?]$")
    plain = pc.match_substring_regex(chunks, f"^[{_LETTERS}]+$")
    body = pc.if_else(closed, pc.utf8_slice_codeunits(chunks, 0, -1), chunks)
    words = pc.if_else(pc.or_(closed, plain), pc.ascii_lower(body), chunks)
    return words, pc.if_else(closed, pc.utf8_slice_codeunits(chunks, -1), pa.scalar("", chunks.type))


class Windows:
    """At most `most` open windows of `capacity`. `placed` gets (window, offset, piece) for every piece."""

    def __init__(self, capacity: int, most: int):
        self.capacity, self.most = capacity, most
        self.open: dict[int, list[tuple]] = {}
        self._free: list[tuple[int, int]] = []
        self._next = 0

    def add(self, doc_id: int | None, doc_tokens: int, start: int, ids: np.ndarray) -> Iterator[tuple[int, list[tuple]]]:
        """Place ids; yields (number, pieces) of each window that this fills."""
        while len(ids):
            at = bisect_left(self._free, (min(len(ids), self.capacity), -1))
            if at == len(self._free) and len(self._free) < self.most:
                insort(self._free, (self.capacity, self._next))
                self.open[self._next] = []
                self._next += 1
                continue
            # The least space that is enough, else the fullest window, which the start of the piece then fills.
            free, window = self._free.pop(at if at < len(self._free) else 0)
            piece, rest = ids[:free], ids[free:]
            self.open[window].append((doc_id, doc_tokens, start, self.capacity - free, piece))
            if len(piece) < free:
                insort(self._free, (free - len(piece), window))
            else:
                yield window, self.open.pop(window)
            start, ids = start + len(piece), rest

    def drain(self) -> Iterator[tuple[int, list[tuple]]]:
        """Merge what is open: full windows, then windows of falling powers of two. Nothing needs padding."""
        pieces = [p for _, window in sorted(self._free) for p in self.open[window]]
        left = sum(len(p[-1]) for p in pieces)
        held, space, fill = [], 0, 0
        for doc_id, doc_tokens, start, _, ids in pieces:
            while len(ids):
                if not space:
                    space = min(self.capacity, 1 << (left.bit_length() - 1))
                piece, ids = ids[: space - fill], ids[space - fill :]
                held.append((doc_id, doc_tokens, start, fill, piece))
                start, fill, left = start + len(piece), fill + len(piece), left - len(piece)
                if fill == space:
                    yield self._next, held
                    held, space, fill, self._next = [], 0, 0, self._next + 1


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = 2048, windows: int = OPEN, merged: int = MERGED) -> DataFrame:
    """Where each piece of each document's ids lies in sequences of at most `capacity` ids.

    (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset). A
    document is the ids of its whole text and the end id. For tokenizers that
    drop white space; `capacity` is a power of two. All sequences are full but
    those of the very last windows, which have the lengths of smaller powers of two.

    Null texts are empty and leave the end id. Null ids and repeated rows are
    rows like any other; other columns are ignored. No rows give none. A task
    holds `windows` open windows and one batch of texts; a merge holds the
    windows of `merged` tasks.
    """
    if capacity & (capacity - 1):
        raise ValueError(f"capacity must be a power of two, not {capacity}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, held, part = Encoder(tokenizer_path), Windows(capacity, windows), TaskContext.get().partitionId()

        def rows() -> Iterator[tuple]:
            for doc_id, ids in _documents(batches, encoder):
                yield from _emitted(held.add(doc_id, len(ids), 0, ids), 0, part)
            yield from _handed_on(held, part)

        return batches_of(_SCHEMA, rows(), 1_000)

    texts = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    step = cut(texts.mapInArrow(run, f"{_PIECE}, {_HANDED_ON}"), "packed")
    results, round_no = [], 0
    while True:
        results.append(step.filter("sequence_id is not null").drop("ids", "part", "place"))
        left = step.filter("sequence_id is null")
        last = left.agg(F.max("part")).first()[0]
        if last is None:
            break
        round_no += 1
        step = cut(_merge(left, round_no, last < merged, capacity, windows, merged), "packed")
    whole = results[0]
    for some in results[1:]:
        whole = whole.union(some)
    return whole


def _merge(left: DataFrame, round_no: int, is_last: bool, capacity: int, windows: int, merged: int) -> DataFrame:
    """The open windows of `merged` tasks packed in one; what stays open is handed on, or drained by the last."""

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        group, held = key[0].as_py(), Windows(capacity, windows)
        rows = rows.sort_by([("part", "ascending"), ("place", "ascending")])

        def found() -> Iterator[tuple]:
            for row in rows.to_pylist():
                ids = np.frombuffer(row["ids"], "<u4")
                yield from _emitted(held.add(row["doc_id"], row["doc_tokens"], row["start"], ids), round_no, group)
            yield from _emitted(held.drain(), round_no, group) if is_last else _handed_on(held, group)

        return pa.Table.from_batches(batches_of(_SCHEMA, found()), _SCHEMA)

    grouped = left.withColumn("group", F.floor(F.col("part") / merged)).groupBy("group")
    return grouped.applyInArrow(run, f"{_PIECE}, {_HANDED_ON}")


def _documents(batches: Iterable[pa.RecordBatch], encoder: Encoder) -> Iterator[tuple[int | None, np.ndarray]]:
    for batch in batches:
        for part in _slices(batch):
            for doc_id, ids in zip(part.column(0).to_pylist(), encoder.encode(part.column(1)), strict=True):
                yield doc_id, np.append(ids, np.array([END], "<u4"))


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Parts of a batch of a bounded number of bytes; a longer text is a part of its own."""
    sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    number = (np.cumsum(sizes) - sizes) // _BYTES_AT_ONCE
    starts = np.flatnonzero(np.diff(number, prepend=-1))
    for i, j in zip(starts, [*starts[1:], batch.num_rows], strict=True):
        yield batch.slice(i, j - i)


def _emitted(full: Iterable[tuple[int, list[tuple]]], round_no: int, part: int) -> Iterator[tuple]:
    """Rows of full windows. Rounds, tasks and windows number the sequences."""
    for window, pieces in full:
        sequence = (round_no << 56) + (part << 26) + window
        for doc_id, doc_tokens, start, offset, ids in pieces:
            yield doc_id, start, len(ids), zlib.crc32(ids.tobytes()), doc_tokens, sequence, offset, None, None, None


def _handed_on(held: Windows, part: int) -> Iterator[tuple]:
    """Rows of open windows, with their ids."""
    place = 0
    for pieces in held.open.values():
        for doc_id, doc_tokens, start, _, ids in pieces:
            yield doc_id, start, len(ids), None, doc_tokens, None, None, ids.tobytes(), part, place
            place += 1
