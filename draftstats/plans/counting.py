"""Counts of rows as they are read, at the cost of no pass of their own."""

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation


class Counted:
    """A relation, as `rows`, whose rows are counted while they are read by the first action on it."""

    def __init__(self, df: DataFrame, **counts: Column):
        self._df, self._counts = df, [column.alias(name) for name, column in counts.items()]
        self._seen = Observation()
        self.rows = df.observe(self._seen, *self._counts)

    def get(self) -> dict[str, int]:
        try:
            return dict(self._seen.get)
        except Py4JJavaError:
            # Where a later stage turns out to be empty, Spark drops it and what it counted; then they are counted by themselves.
            return self._df.agg(*self._counts).first().asDict()
