"""Packing of documents into sequences: best fit, then swaps between underfull bins.

Documents are cut into pieces of at most a sequence, in tasks over the texts.
The pieces, a few numbers each, are dealt into groups of a bounded size, and
each group is packed by itself: it costs less than one sequence per group.
"""

import base64
import os
import re
import zlib
from collections.abc import Iterator
from math import ceil

import numpy as np
import pandas as pd
import pyarrow as pa
import tiktoken
import tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batches_of, cut

END = 0
# Pieces packed together.
GROUP = 30_000
# Donors in a row that could not be emptied before the search ends, and items of a bin tried in pairs.
_PATIENCE = 24
_PAIRED = 8

# The pattern that splits text before the merges of rank files. A fixed value of this family of tokenizers.
_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# Characters that both libraries class alike, whatever their Unicode version.
_PLAIN = re.compile(r"[\t\n\r\x20-\x7e\xa1-\xac\xae-ɏ]*")

_PIECE = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("piece", pa.int32()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids_crc32", pa.int64()),
    ]
)
_PIECE_DDL = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


class Encoder:
    """Token ids as `tokenizers` gives them; a rank file of the same vocabulary gives plain texts' ids sooner."""

    def __init__(self, tokenizer_path: str, ranks_path: str | None = None):
        # Cores are Spark's to share out.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self._whole = tokenizers.Tokenizer.from_file(tokenizer_path)
        self._special = [t.content for t in self._whole.get_added_tokens_decoder().values()]
        self._fast = None
        if ranks_path:
            with open(ranks_path, "rb") as file:
                ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
            self._fast = tiktoken.Encoding("ranks", pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens={})

    def ids(self, text: str) -> np.ndarray:
        plain = self._fast and _PLAIN.fullmatch(text) and not any(s in text for s in self._special)
        if plain:
            return np.array(self._fast.encode_ordinary(text), "<u4")
        return np.array(self._whole.encode(text, add_special_tokens=False).ids, "<u4")


def pieces(docs: DataFrame, tokenizer_path: str, ranks_path: str | None = None, capacity: int = 2048) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of every document's ids and the end id.

    A document of more than `capacity` ids is cut; only its first piece may be
    shorter. Null texts are empty, which leaves the end id. Null ids and repeated
    rows are rows like any other; other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(tokenizer_path, ranks_path)

        def rows() -> Iterator[tuple]:
            for batch in batches:
                for i in range(batch.num_rows):
                    ids = np.append(encoder.ids(batch.column(1)[i].as_py() or ""), np.array([END], "<u4")).astype("<u4")
                    edges = [0, *range((len(ids) - 1) % capacity + 1, len(ids) + 1, capacity)]
                    doc_id = batch.column(0)[i].as_py()
                    for piece, (start, end) in enumerate(zip(edges, edges[1:], strict=False)):
                        yield doc_id, piece, start, end - start, zlib.crc32(ids[start:end].tobytes())

        return batches_of(_PIECE, rows())

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, _PIECE_DDL)


def pack(found: DataFrame, capacity: int = 2048, group: int = GROUP) -> DataFrame:
    """The rows of `pieces` with `sequence_id` and `offset`: their sequence, and their place in it without gaps.

    Ties and repeated rows are told apart by their place in the table that is
    written first. No rows give none.
    """
    placed = cut(found, "pieces")
    groups = max(1, ceil(placed.count() / group))
    # By row and not by document, so that rows that repeat don't share a group.
    number = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups)).alias("group")
    dealt = placed.select(number, "*")

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "doc_id", "piece"], ascending=[False, True, True], kind="stable")
        bins, offsets = packed(rows["length"].to_numpy(), capacity)
        sequence = (int(rows["group"].iloc[0]) << 32) + bins
        return rows.drop(columns="group").assign(sequence_id=sequence, offset=offsets)

    return dealt.groupBy("group").applyInPandas(run, f"{_PIECE_DDL}, sequence_id bigint, offset bigint")


def packed(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each item. `lengths` fall."""
    bins = _best_fit(lengths.tolist(), capacity)
    _local_search(lengths, bins, capacity)
    _, bins = np.unique(bins, return_inverse=True)
    order = np.argsort(bins, kind="stable")
    ends = np.cumsum(lengths[order])
    first = np.r_[True, np.diff(bins[order]) > 0] if len(order) else np.zeros(0, bool)
    starts = ends - lengths[order]
    offsets = np.empty(len(lengths), np.int64)
    offsets[order] = starts - np.maximum.accumulate(np.where(first, starts, 0))
    return bins.astype(np.int64), offsets


def _best_fit(lengths: list[int], capacity: int) -> np.ndarray:
    """Each item into the bin with the least room that still holds it. A bit of `rooms` is set if some bin has that room."""
    bins, rooms, by_room, used = [], 0, [[] for _ in range(capacity + 1)], 0
    for length in lengths:
        fitting = rooms >> length
        if fitting:
            room = (fitting & -fitting).bit_length() - 1 + length
            at = by_room[room].pop()
            if not by_room[room]:
                rooms &= ~(1 << room)
        else:
            room, at = capacity, used
            used += 1
        bins.append(at)
        left = room - length
        if left:
            by_room[left].append(at)
            rooms |= 1 << left
    return np.array(bins, np.int64)


def _local_search(lengths: np.ndarray, bins: np.ndarray, capacity: int) -> None:
    """Empty the emptiest bins by moves and exchanges with other underfull bins, in place.

    Every step raises the sum of squared fills, as the fuller bin of the two gets
    fuller. It ends at the least possible number of bins, or when no step helps.
    """
    if not len(lengths):
        return
    fill = np.bincount(bins, lengths).astype(np.int64)
    least = -(-int(lengths.sum()) // capacity)
    stuck: set[int] = set()
    while np.count_nonzero(fill) > least and len(stuck) < _PATIENCE:
        open_bins = np.flatnonzero((fill > 0) & (fill < capacity))
        open_bins = open_bins[~np.isin(open_bins, list(stuck))]
        if len(open_bins) < 2:
            break
        donor = int(open_bins[np.argmin(fill[open_bins])])
        search = _Donor(donor, lengths, bins, fill, capacity)
        while search.step():
            pass
        if fill[donor]:
            stuck.add(donor)
        elif search.changed:
            # What was impossible may be possible with the bins as they are now.
            stuck.clear()


class _Donor:
    """Steps that take from one bin. Items of underfull bins are kept as arrays and searched whole."""

    def __init__(self, donor: int, lengths: np.ndarray, bins: np.ndarray, fill: np.ndarray, capacity: int):
        self.donor, self.lengths, self.bins, self.fill, self.capacity = donor, lengths, bins, fill, capacity
        underfull = (fill > 0) & (fill < capacity)
        underfull[donor] = False
        self.others = np.flatnonzero(underfull[bins])
        self.own = list(np.flatnonzero(bins == donor))
        self.pairs = self._pairs()
        self.changed = False

    def _pairs(self) -> np.ndarray:
        """Pairs of items of one bin, the largest few of each."""
        order = self.others[np.argsort(self.bins[self.others], kind="stable")]
        found = []
        for gap in range(1, _PAIRED):
            a, b = order[:-gap], order[gap:]
            same = self.bins[a] == self.bins[b]
            found.append(np.stack([a[same], b[same]]))
        return np.concatenate(found, axis=1) if found else np.zeros((2, 0), np.int64)

    def step(self) -> bool:
        if not self.own:
            return False
        return self._move() or self._one_for_one() or self._two_for_one() or self._one_for_two()

    def _room(self, items: np.ndarray) -> np.ndarray:
        return self.capacity - self.fill[self.bins[items]]

    def _apply(self, given: list[int], taken: list[int], at: int) -> None:
        change = int(self.lengths[given].sum() - self.lengths[taken].sum())
        self.bins[given], self.bins[taken] = at, self.donor
        self.fill[at] += change
        self.fill[self.donor] -= change
        self.own = [i for i in self.own if i not in given] + taken
        gone = np.isin(self.others, taken)
        self.others = np.append(self.others[~gone], given).astype(np.int64)
        # Pairs stay pairs only while both items lie in one bin other than the donor.
        a, b = self.pairs
        self.pairs = self.pairs[:, (self.bins[a] == self.bins[b]) & (self.bins[a] != self.donor)]
        self.changed = True

    def _best(self, change: np.ndarray, room: np.ndarray, at: np.ndarray) -> int:
        """The feasible exchange that raises the squared fills most, or -1."""
        gain = change * (self.fill[at] - self.fill[self.donor] + change)
        gain = np.where((change > 0) & (change <= room) & (gain > 0), gain, 0)
        best = int(np.argmax(gain)) if len(gain) else -1
        return best if best >= 0 and gain[best] > 0 else -1

    def _move(self) -> bool:
        for item in sorted(self.own, key=lambda i: -self.lengths[i]):
            length = np.full(len(self.others), self.lengths[item])
            best = self._best(length, self._room(self.others), self.bins[self.others])
            if best >= 0:
                self._apply([item], [], int(self.bins[self.others[best]]))
                return True
        return False

    def _one_for_one(self) -> bool:
        room, at = self._room(self.others), self.bins[self.others]
        for item in self.own:
            best = self._best(self.lengths[item] - self.lengths[self.others], room, at)
            if best >= 0:
                self._apply([item], [int(self.others[best])], int(at[best]))
                return True
        return False

    def _two_for_one(self) -> bool:
        """Two of the donor's items for one of another bin."""
        room, at = self._room(self.others), self.bins[self.others]
        some = self.own[:_PAIRED]
        for k, first in enumerate(some):
            for second in some[:k]:
                both = self.lengths[first] + self.lengths[second]
                best = self._best(both - self.lengths[self.others], room, at)
                if best >= 0:
                    self._apply([first, second], [int(self.others[best])], int(at[best]))
                    return True
        return False

    def _one_for_two(self) -> bool:
        """One of the donor's items for two of another bin."""
        a, b = self.pairs
        if not len(a):
            return False
        room, at, both = self._room(a), self.bins[a], self.lengths[a] + self.lengths[b]
        for item in self.own:
            best = self._best(self.lengths[item] - both, room, at)
            if best >= 0:
                self._apply([item], [int(a[best]), int(b[best])], int(at[best]))
                return True
        return False
