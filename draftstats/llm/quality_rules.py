"""Quality rules: base counts of each text, and a log-likelihood ratio of hashed n-grams.

Two multinomials over hashed byte n-grams are counted, one from trusted texts
and one from the whole raw corpus. A text's score is the sum of its n-grams'
log-likelihood ratios over their number; a fixed threshold decides on every text.
"""

from collections import Counter
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import utf8

ORDER = 4
BITS = 16
_MULTIPLIER = np.uint32(2654435761)
_BLANKS = b" \t\n\x0b\x0c\r"
_SYMBOLS = b"#*$%&|<>"

_COUNTED = pa.schema([("bucket", pa.int32()), ("n", pa.int64())])
_RULED = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_words", pa.int64()),
        ("word_chars", pa.int64()),
        ("n_symbols", pa.int64()),
        ("n_dup_lines", pa.int64()),
        ("n_repeat_words", pa.int64()),
        ("base_failed", pa.bool_()),
        ("kept", pa.bool_()),
        ("log_ratio", pa.float64()),
    ]
)


def buckets(text: np.ndarray) -> np.ndarray:
    """The hashed n-grams of a text's bytes, repeats included."""
    if len(text) < ORDER:
        return np.zeros(0, np.uint32)
    wide = text.astype(np.uint32)
    grams = wide[:-3] | wide[1:-2] << np.uint32(8) | wide[2:-1] << np.uint32(16) | wide[3:] << np.uint32(24)
    return (grams * _MULTIPLIER) >> np.uint32(32 - BITS)


def log_ratios(docs: DataFrame, trusted: DataFrame, smoothing: float = 1.0) -> np.ndarray:
    """log p_trusted - log p_raw of every bucket.

    The raw multinomial counts all of `docs`, the trusted one all of them whose
    id is in `trusted`. Ids that repeat there count once, null ids not at all.
    Without trusted texts every ratio is 0, and nothing is told apart.
    """
    raw = _counted(docs.select("text")) + smoothing
    # Merged at every size: a side that is broadcast while it is small changes what is shuffled as it grows.
    some = trusted.select("doc_id").hint("merge")
    good = _counted(docs.select("doc_id", "text").join(some, "doc_id", "left_semi").select("text"))
    if not good.any():
        return np.zeros(1 << BITS)
    good = good + smoothing
    return np.log(good / good.sum()) - np.log(raw / raw.sum())


def _counted(texts: DataFrame) -> np.ndarray:
    """How often each bucket occurs in all of `texts`."""
    # One row per bucket, however large the corpus.
    found = texts.mapInArrow(_count, "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(1 << BITS, np.int64)
    counts[found.column("bucket").to_numpy()] = found.column("n").to_numpy()
    return counts


def apply_rules(
    docs: DataFrame,
    ratios: np.ndarray,
    min_log_ratio: float = -0.6,
    min_words: int = 50,
    max_repeat_percent: int = 50,
) -> DataFrame:
    """Base counts, `base_failed`, `kept` and `log_ratio` of every row of `docs`.

    A text is kept if it does not fail the base rules and its mean log ratio is
    at least `min_log_ratio`. Null texts are empty, have no words and fail. Null
    ids and repeated rows stay as they are; no rows give none; other columns are
    ignored. A text is read whole, whatever its length.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns: list[list] = [[] for _ in _RULED.names[1:]]
            for text in utf8(batch.column(1)):
                counts = base_counts(text.tobytes())
                n_words, n_repeat = counts[0], counts[4]
                failed = n_words < min_words or 100 * n_repeat > max_repeat_percent * n_words
                grams = buckets(text)
                ratio = float(ratios[grams].mean()) if len(grams) else 0.0
                for column, value in zip(columns, (*counts, failed, not failed and ratio >= min_log_ratio, ratio), strict=True):
                    column.append(value)
            arrays = [pa.array(c, f.type) for c, f in zip(columns, list(_RULED)[1:], strict=True)]
            yield pa.record_batch([batch.column(0), *arrays], schema=_RULED)

    ddl = (
        "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
        "n_repeat_words bigint, base_failed boolean, kept boolean, log_ratio double"
    )
    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, ddl)


def base_counts(text: bytes) -> tuple[int, int, int, int, int]:
    """(words, code points in words, symbols, repeated lines, words in repeated windows of three) of UTF-8 text."""
    words = text.split()
    in_words = text.translate(None, _BLANKS)
    continuing = np.frombuffer(in_words, np.uint8) & 0xC0 == 0x80
    symbols = len(text) - len(text.translate(None, _SYMBOLS))
    lines = [line for line in text.split(b"\n") if line.strip()]
    return (
        len(words),
        len(in_words) - int(continuing.sum()),
        symbols,
        len(lines) - len(set(lines)),
        _repeat_words(words),
    )


def _repeat_words(words: list[bytes]) -> int:
    windows = list(zip(words, islice(words, 1, None), islice(words, 2, None), strict=False))
    found = Counter(windows)
    if len(found) == len(windows):
        return 0
    repeated = np.zeros(len(words), bool)
    starts = np.fromiter((found[w] > 1 for w in windows), bool, len(windows))
    for offset in range(3):
        repeated[offset : offset + len(starts)] |= starts
    return int(repeated.sum())


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(1 << BITS, np.int64)
    for batch in batches:
        for text in utf8(batch.column(0)):
            if len(text) > 1 << BITS:
                counts += np.bincount(buckets(text), minlength=1 << BITS)
            else:
                # Few n-grams of many buckets: add them up without a pass over all buckets.
                some, n = np.unique(buckets(text), return_counts=True)
                counts[some] += n
    at = np.flatnonzero(counts)
    yield pa.record_batch([pa.array(at, pa.int32()), pa.array(counts[at])], schema=_COUNTED)
