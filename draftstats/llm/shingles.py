"""Word shingles of texts as 64-bit hashes, the same in every task."""

import numpy as np

_BASE = np.uint64(0x9E3779B97F4A7C15)
_JOIN = np.uint64(0xD1342543DE82EF95)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread bits; a bijection of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_LETTERS = mixed(np.arange(1, 257, dtype=np.uint64) * _BASE)
_IS_WORD = ~np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


class Shingler:
    """Sets of n-word shingles of UTF-8 texts. Powers of the hash's base are kept from text to text."""

    def __init__(self, n: int):
        self.n = n
        self._powers = np.ones(1, np.uint64)
        self._inverses = np.ones(1, np.uint64)

    def _grow(self, size: int) -> None:
        if len(self._powers) < size:
            size = max(size, 2 * len(self._powers), 1 << 15)
            inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
            self._powers = np.cumprod(np.r_[np.uint64(1), np.full(size - 1, _BASE)], dtype=np.uint64)
            self._inverses = np.cumprod(np.r_[np.uint64(1), np.full(size - 1, inverse)], dtype=np.uint64)

    def words(self, text: np.ndarray) -> np.ndarray:
        """A hash of each word, A-Z in lower case."""
        inside = np.empty(len(text) + 2, bool)
        inside[0] = inside[-1] = False
        inside[1:-1] = _IS_WORD[text]
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        starts, ends = edges[::2], edges[1::2]
        self._grow(len(text) + 1)
        sums = np.zeros(len(text) + 1, np.uint64)
        np.cumsum(_LETTERS[_LOWER[text]] * self._powers[: len(text)], out=sums[1:])
        # A polynomial of the word's bytes, whatever its place.
        return mixed((sums[ends] - sums[starts]) * self._inverses[starts] + (ends - starts).astype(np.uint64))

    def shingles(self, text: np.ndarray) -> np.ndarray:
        """The distinct shingles, in order of their hashes. With fewer words than n, all of them are one."""
        words = self.words(text)
        if not len(words):
            return words
        n = min(self.n, len(words))
        last = len(words) - n + 1
        joined = np.full(last, np.uint64(n))
        for k in range(n):
            joined = joined * _JOIN + words[k : k + last]
        return np.unique(mixed(joined))
