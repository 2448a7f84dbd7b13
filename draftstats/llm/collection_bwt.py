"""Burrows-Wheeler transform and common prefixes of a collection of short texts, one column at a time.

Each round puts the next symbol, from the right, of every text before the
suffix that the text put in last. The transform and the lengths of common prefixes
lie in files in the order of the suffixes, and a round reads
and writes both from end to end. Common prefixes come from those of the round
before: two suffixes that begin with one symbol share one more byte than what follows it.
Which suffix is whose is read at the end, by steps from each whole text to its rest.
"""

import os
import tempfile
from contextlib import ExitStack

import numpy as np


class Collection:
    """Texts one after the other as one array of bytes."""

    def __init__(self, texts: list[bytes]):
        self.lengths = np.array([len(t) for t in texts], np.int64)
        self.ends = np.cumsum(self.lengths)
        self.bytes = np.frombuffer(b"".join(texts), np.uint8)


class _File:
    """An array that only grows, read and written whole and in order."""

    def __init__(self, folder: str, name: str, kind: type, opened: ExitStack):
        self.file = opened.enter_context(open(os.path.join(folder, name), "w+b", buffering=0))
        self.kind, self.size = kind, 0

    def read(self) -> np.ndarray:
        values = np.empty(self.size, self.kind)
        self.file.seek(0)
        self.file.readinto(values)
        return values

    def write(self, values: np.ndarray) -> None:
        self.size = len(values)
        self.file.seek(0)
        self.file.write(np.ascontiguousarray(values, self.kind))


def equal_windows(texts: list[bytes], size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, offset, class) of every window of `size` bytes; windows are equal if their classes are."""
    collection = Collection(texts)
    with tempfile.TemporaryDirectory() as folder, ExitStack() as opened:
        # Symbols are bytes + 1, as UTF-8 has no byte 255; 0 stands before a suffix whose text goes no further, or has not yet.
        bwt, lcp = (_File(folder, n, np.uint8, opened) for n in ("bwt", "lcp"))
        return _windows(collection, size, _transform(collection, size, bwt, lcp), bwt, lcp)


def _grown(values: np.ndarray, old: np.ndarray, into: np.ndarray, new: np.ndarray | int) -> np.ndarray:
    """The values in their order, with the new ones at their places."""
    out = np.empty(len(old), values.dtype)
    out[old] = values
    out[into] = new
    return out


def _least_between(values: np.ndarray, after: np.ndarray, to: np.ndarray) -> np.ndarray:
    """The least of the values behind each place `after` up to the place `to` behind it."""
    # From the right, as what reduceat does from the end of one range to the next begin is then nothing.
    from_right = np.argsort(-after)
    edges = np.stack((after[from_right] + 1, to[from_right] + 1), axis=1).ravel()
    out = np.empty(len(after), values.dtype)
    out[from_right] = np.minimum.reduceat(np.append(values, values[:1]), edges)[::2] if len(edges) else 0
    return out


def _transform(collection: Collection, size: int, bwt: _File, lcp: _File) -> np.ndarray:
    """Write the transform and the common prefixes, up to `size`; the places of the whole texts in them."""
    n = len(collection.lengths)
    # Empty suffixes come first, in the order of the texts.
    bwt.write(np.zeros(n))
    lcp.write(np.zeros(n))
    rank = np.arange(n)
    text_at = np.empty(n + int(collection.lengths.sum()), np.int32)
    for column in range(1, int(collection.lengths.max(initial=0)) + 1):
        live = np.flatnonzero(collection.lengths >= column)
        at = rank[live]
        before, shared = bwt.read(), lcp.read()
        before[at] = collection.bytes[collection.ends[live] - column] + np.uint8(1)
        # A suffix that starts with c stands, among all that are not empty, where its c stands in the
        # transform sorted by symbols: the stable order of the transform is the order of the suffixes.
        order = np.argsort(before, kind="stable")
        ends = len(before) - np.count_nonzero(before)
        # Only the places of the texts that go on are needed, in their order.
        text_at[at] = live
        going = np.zeros(len(before), bool)
        going[at] = True
        places = np.flatnonzero(going.take(order))
        texts, into = text_at[order[places]], n + places - ends
        old = np.ones(len(before) + len(into), bool)
        old[into] = False
        prefixes = _grown(shared, old, into, 0)
        # Only prefixes shared with a new suffix, or across one, have changed.
        touched = ~old
        touched[1:] |= touched[:-1].copy()
        changed = np.flatnonzero(touched)
        # Where the suffixes' rests stand, and those of the suffixes above them. Above the first are empty ones.
        lower, upper = order[changed - n + ends], order[changed - n + ends - 1]
        alike = (before[upper] == before[lower]) & (changed > n)
        prefixes[changed] = 0
        least = _least_between(shared, upper[alike], lower[alike])
        prefixes[changed[alike]] = np.minimum(least, size - 1) + 1
        bwt.write(_grown(before, old, into, 0))
        lcp.write(prefixes)
        done = collection.lengths < column
        if done.any():
            rank[done] += np.searchsorted(into - np.arange(len(into)), rank[done], "right")
        rank[texts] = into
    return rank


def _windows(collection: Collection, size: int, rank: np.ndarray, bwt: _File, lcp: _File) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    before = bwt.read()
    # The rest of the suffix at a place, without its first byte, stands at this place; empty suffixes are at the first n.
    rests = np.argsort(before, kind="stable")[len(before) - np.count_nonzero(before) :]
    classes = np.cumsum(lcp.read() < size)
    owners, offsets, places = [], [], []
    live, at = np.flatnonzero(collection.lengths >= size), rank[collection.lengths >= size]
    for offset in range(int(collection.lengths.max(initial=0)) - size + 1):
        owners.append(live)
        offsets.append(np.full(len(live), offset))
        places.append(at)
        on = collection.lengths[live] > offset + size
        live, at = live[on], rests[at[on] - len(rank)]
    none = np.zeros(0, np.int64)
    owners, offsets, places = (np.concatenate([none, *x]) for x in (owners, offsets, places))
    return owners, offsets, classes[places]
