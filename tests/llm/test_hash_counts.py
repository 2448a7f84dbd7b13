from collections import Counter

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from draftstats.llm import hash_counts


def reader():
    # A function of a function travels with the job; executors need not have this module.
    def hashes_of(batches):
        for batch in batches:
            yield batch.column(0).to_numpy().astype(np.uint32)

    return hashes_of


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.sampled_from([0, 1, 7, 65535, 65536, 65537, (1 << 18) - 1]), max_size=60), st.sampled_from([1, 2, 5, 300]))
def test_against_counter(spark, values, least):
    rows = spark.createDataFrame([(v,) for v in values], "h long").repartition(3)
    bits = hash_counts.frequent_hashes(rows, reader(), least, 18)
    assert len(bits) == 1 << 15
    found = set(np.flatnonzero(np.unpackbits(bits)).tolist())
    assert found == {v for v, n in Counter(values).items() if n >= least}
    asked = np.array([0, 7, 65536, 5], np.uint32)
    assert hash_counts.is_set(bits, asked).tolist() == [int(v) in found for v in asked]


def test_sums_do_not_overflow(spark):
    rows = spark.range(0, 3_000, 1, 6).selectExpr("3L AS h")
    assert hash_counts.is_set(hash_counts.frequent_hashes(rows, reader(), 2_900, 16), np.array([3, 4], np.uint32)).tolist() == [True, False]


def test_bits_are_bounded(spark):
    with pytest.raises(ValueError):
        hash_counts.frequent_hashes(spark.range(1), reader(), 2, 31)
