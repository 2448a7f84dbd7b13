"""Connected components of a graph given as edges, by alternating stars."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, drop_cut


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of the edges (a, b); the root is the least node of its component.

    Each round links every node's larger neighbours, then its smaller ones, to
    the least of its neighbourhood, until the edges are stars. The rounds grow with the logarithm
    of the longest path. No neighbourhood is gathered anywhere: minima
    combine before they are sent, and a hub's edges are rows of a join that can be split.
    """
    pairs = cut(edges.filter("a <> b").select("a", "b").distinct(), "edges")
    seen = _fingerprint(pairs)
    while True:
        stars = cut(_small_star(_large_star(pairs)), "edges")
        drop_cut(pairs)
        pairs, before, seen = stars, seen, _fingerprint(stars)
        if seen == before:
            roots = pairs.select(F.col("b").alias("root")).distinct()
            return pairs.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                roots.select(F.col("root").alias("node"), "root")
            )


def _fingerprint(pairs: DataFrame) -> tuple:
    row = pairs.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("bits")).first()
    return row.n, row.bits


def _large_star(pairs: DataFrame) -> DataFrame:
    both = pairs.select("a", "b").union(pairs.select(F.col("b"), F.col("a")))
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("least"))
    return both.filter("b > a").join(least, "a").filter("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()


def _small_star(pairs: DataFrame) -> DataFrame:
    down = pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("least"))
    moved = down.join(least, "a").filter("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.union(least.select("a", F.col("least").alias("b"))).distinct()
