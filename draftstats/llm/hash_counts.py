"""Which hashes occur often: bits of a bounded size, from counts that tasks make and add up.

Things that share a hash are counted together, so whatever occurs often enough
passes, and some that do not may pass as well: a filter before exact counts.
"""

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import batches_of

# log2 of the hashes whose counts are added up together.
_BLOCK = 16
_COUNTED = pa.schema([("block", pa.int64()), ("hashes", pa.binary()), ("counts", pa.binary())])
_SUMMED = pa.schema([("block", pa.int64()), ("bits", pa.binary())])


def frequent_hashes(
    rows: DataFrame, hashes_of: Callable[[Iterator[pa.RecordBatch]], Iterator[np.ndarray]], least: int, bits: int
) -> np.ndarray:
    """2 ** `bits` bits, set where a hash occurs `least` times in all.

    `hashes_of` gives a task's hashes, below 2 ** `bits` and repeats included, in
    arrays of a bounded size. A task sends each hash of an array once, with its
    count; a block of hashes is added up by one task, a row after the other.
    The result has the same size whatever the data, so the driver may hold it.
    """
    if not _BLOCK <= bits <= 30:
        raise ValueError(f"bits must be {_BLOCK} to 30, not {bits}")
    kind, wide = np.min_scalar_type(least), np.min_scalar_type(2 * least)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for hashes in hashes_of(batches):
            found, n = np.unique(hashes, return_counts=True)
            # From `least` on it doesn't matter how often.
            n = np.minimum(n, least).astype(kind)
            blocks, starts = np.unique(found >> _BLOCK, return_index=True)
            ends = np.append(starts, len(found))[1:]
            low = (found & ((1 << _BLOCK) - 1)).astype(np.uint16)
            parts = zip(blocks.tolist(), starts.tolist(), ends.tolist(), strict=True)
            yield from batches_of(_COUNTED, ((b, low[i:j].tobytes(), n[i:j].tobytes()) for b, i, j in parts), 256)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, hashes, counts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                total = sums.setdefault(block, np.zeros(1 << _BLOCK, wide))
                at = np.frombuffer(hashes, np.uint16)
                total[at] = np.minimum(total[at] + np.frombuffer(counts, kind), least)
        yield from batches_of(_SUMMED, ((block, np.packbits(total >= least).tobytes()) for block, total in sums.items()), 256)

    counted = rows.mapInArrow(count, "block bigint, hashes binary, counts binary")
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    summed = counted.repartition(tasks, "block").mapInArrow(add, "block bigint, bits binary")
    found, size = np.zeros(1 << (bits - 3), np.uint8), 1 << (_BLOCK - 3)
    for row in summed.collect():
        found[row.block * size : (row.block + 1) * size] = np.frombuffer(row.bits, np.uint8)
    return found


def is_set(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which of the hashes have their bit set."""
    return (bits[hashes >> 3] >> (7 - (hashes & 7)).astype(np.uint8)) & 1 == 1
