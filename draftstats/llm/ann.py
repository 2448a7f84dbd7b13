"""Approximate nearest neighbours by largest inner product; exact in tables of up to some 339,000 vectors.

Vectors lie in cells, each around a landmark, and near cells together in parts.
Queries walk from part to part, the most promising first, and multiply themselves with all vectors of
the cells that they look into, so that a step is a product of matrices and no vector is moved for a query.

Vectors get one more component that gives all of them the same norm, so the
cells follow distances, while a query, with nothing there, asks for inner products.
Equal vectors are one node. What is rounded is always a difference of near
vectors, so neither one very long vector nor a dense cluster costs precision.
"""

from collections.abc import Iterator
from math import ceil
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, drop_cut

#: Landmarks: so many nodes by a hash for the root of the number of nodes, some SPREAD at most, and LONGEST of the largest norms.
PER_ROOT = 4
SPREAD = 16_384
LONGEST = 1_024
#: Cells are dealt to so many parts, all of one size; a cell that is larger goes to several.
PARTS = 96
#: A query looks into cells of BEAM times SCORED nodes in a table of up to BEAM_NODES nodes; beyond, the beam
#: grows as their number to the power BEAM_GROWTH.
BEAM = 160
BEAM_NODES = 10_000
BEAM_GROWTH = 0.6
SCORED = 256
#: Parts that a query visits in its first round, and how many times as many as before in each further one, EXPANDED at most.
FIRST = 2
GROWING = 4
EXPANDED = 40

# Lists of one node that are merged before there are more; nodes of a block; queries and nodes that are multiplied at once,
# and how many of their products are held before only the best are.
_HUB = 20_000
_BLOCK = 2_000
_QUERIES, _PIECE = 2_048, 256
_MET = 1_000_000
# What scores of vectors of norm 1 at most may be wrong by, with much to spare.
_ROUNDED = 1e-4

_LISTS = "node bigint, packed binary, ids array<bigint>, scores array<double>, fresh array<boolean>"
_LIST_SCHEMA = pa.schema(
    [("node", pa.int64()), ("packed", pa.binary()), ("ids", pa.list_(pa.int64())), ("scores", pa.list_(pa.float64())), ("fresh", pa.list_(pa.bool_()))]
)


class Cells(NamedTuple):
    """The index. Of each cell: its landmark's node and vector, how many nodes it has, and the first and the last part that hold some.

    blocks: (part, ids, cells, packed), some nodes of a part with their cells and vectors.
    """

    blocks: DataFrame
    ids: np.ndarray
    landmarks: np.ndarray
    sizes: np.ndarray
    first: np.ndarray
    last: np.ndarray


def nearest(
    vectors: DataFrame, queries, k: int = 20, id_column: str = "vec_id", vector_column: str = "embedding"
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found for each row of which `queries`, a condition on vec_id, holds.

    A row's candidates are all rows but itself; if there are k or fewer, all
    are found. Scores are inner products in double precision of the vectors as given; ties
    go to the smaller id. Vectors that are null, zero, of another length than
    most, or hold nulls or numbers that are not finite take no part, nor do null
    ids. Of rows with one id the least vector counts. Other columns are ignored.
    """
    rows = vectors.select(F.col(id_column).cast("bigint").alias("vec_id"), F.col(vector_column).alias("vector"))
    members, asked, nodes = _nodes(rows, queries, k)
    return search(nodes, members, asked, build(nodes), k)


def _nodes(rows: DataFrame, queries, k: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Three tables; a vector's node is the least id that has it.

    members: (vec_id, node, vector) of the first k + 1 rows of each vector, as no query needs more copies;
    asked: (query_id, query, asked), the queries with their nodes and vectors;
    nodes: (node, packed).
    Vectors are bytes here that have the order of their numbers, see `_ordered`.
    """
    # Single precision stays single, with half of the bytes.
    kind = np.float32 if rows.schema["vector"].dataType.simpleString() == "array<float>" else np.float64
    given = rows.select("vec_id", F.col("vector").cast(f"array<{'float' if kind == np.float32 else 'double'}>").alias("vector")).filter("vec_id is not null")

    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = _lengths(batch.column(1))[_valid(batch.column(1))]
            yield pa.record_batch([*map(pa.array, np.unique(lengths, return_counts=True))], names=["size", "rows"])

    size = given.mapInArrow(sizes, "size int, rows bigint").groupBy("size").agg(F.sum("rows").alias("rows")).orderBy(F.desc("rows"), "size").first()
    of_size = size["size"] if size else 0

    def ordered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            some = batch.filter(pa.array(_valid(batch.column(1)) & (_lengths(batch.column(1)) == of_size)))
            if some.num_rows:
                vectors = some.column(1).flatten().to_numpy().reshape(some.num_rows, -1)
                yield pa.record_batch([some.column(0), _ordered(vectors)], names=["vec_id", "vector"])

    def distinct(of: DataFrame) -> DataFrame:
        return of.mapInArrow(ordered, "vec_id bigint, vector binary").groupBy("vec_id").agg(F.min("vector").alias("vector"))

    same = Window.partitionBy("vector").orderBy("vec_id")
    few = distinct(given).withColumn("copy", F.row_number().over(same)).filter(F.col("copy") <= k + 1)
    members = cut(few.withColumn("node", F.min("vec_id").over(Window.partitionBy("vector"))).drop("copy"), "members")
    one = members.filter("vec_id = node").select("node", "vector")
    wanted = distinct(given.filter(queries(F.col("vec_id")))).withColumnRenamed("vec_id", "query_id").join(one, "vector")
    asked = cut(wanted.select("query_id", F.col("node").alias("query"), F.col("vector").alias("asked")), "asked")

    def longest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.record_batch([pa.array([(_given(batch.column(1)) ** 2).sum(1).max()])], names=["most"])

    largest = one.mapInArrow(longest, "most double").agg(F.max("most").alias("most")).first()["most"] or 1.0

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                vectors = _given(batch.column(1))
                rests = np.sqrt(np.maximum(largest - (vectors**2).sum(1), 0.0))
                packed = (np.column_stack([vectors, rests]) / largest**0.5).astype(np.float32)
                yield pa.record_batch([batch.column(0), _binary(packed)], names=["node", "packed"])

    return members, asked, cut(one.mapInArrow(pack, "node bigint, packed binary"), "nodes")


def _lengths(vectors: pa.Array) -> np.ndarray:
    return pc.fill_null(pc.list_value_length(vectors), 0).to_numpy()


def _valid(vectors: pa.Array) -> np.ndarray:
    """Which vectors are not null nor zero and hold finite numbers only."""
    lengths = _lengths(vectors)
    ends = np.cumsum(lengths)
    # A null among the numbers is not a number here.
    numbers = vectors.flatten().to_numpy(zero_copy_only=False)
    finite, nonzero = (np.append(0, np.cumsum(which))[np.array([ends - lengths, ends])] for which in (np.isfinite(numbers), numbers != 0))
    return (finite[1] - finite[0] == lengths) & (nonzero[1] > nonzero[0])


def _binary(matrix: np.ndarray) -> pa.Array:
    """The bytes of each row."""
    size = matrix.shape[1] * matrix.itemsize
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(size), len(matrix), [None, pa.py_buffer(np.ascontiguousarray(matrix))]).cast(pa.binary())


def _ordered(vectors: np.ndarray) -> pa.Array:
    """Vectors as bytes that are equal if the numbers are, and have their order: how many bytes a number has, then these,
    most significant first, with the sign bit turned, or all bits of what is negative."""
    whole = np.dtype(f"u{vectors.itemsize}")
    # Adding zero makes a negative zero positive.
    bits = (vectors + vectors.dtype.type(0)).view(whole)
    sign = whole.type(1) << whole.type(8 * whole.itemsize - 1)
    content = np.where(bits & sign, ~bits, bits | sign).astype(whole.newbyteorder(">")).view(np.uint8)
    return _binary(np.column_stack([np.full(len(vectors), whole.itemsize, np.uint8), content]))


def _given(ordered: pa.Array) -> np.ndarray:
    """The numbers of `_ordered`, some rows at least, in double precision."""
    content = _content(ordered).reshape(len(ordered), -1)
    whole = np.dtype(f"u{content[0, 0]}")
    bits = np.ascontiguousarray(content[:, 1:]).view(whole.newbyteorder(">")).astype(whole)
    sign = whole.type(1) << whole.type(8 * whole.itemsize - 1)
    return np.where(bits & sign, bits ^ sign, ~bits).view(f"f{whole.itemsize}").astype(np.float64)


def build(nodes: DataFrame) -> Cells:
    """The index of the nodes: cells around landmarks, one after the other, cut into parts of one size."""
    n_nodes = nodes.count()
    ids, landmarks = _landmarks(nodes, n_nodes)
    held = cut(_in_cells(nodes, landmarks), "cells")
    sizes = np.zeros(len(ids), np.int64)
    for row in held.groupBy("cell").count().collect():
        sizes[row["cell"]] = row["count"]
    starts = np.cumsum(sizes) - sizes

    def part_of(cells: np.ndarray, places: np.ndarray) -> np.ndarray:
        """Where a node is: its place, from 0 to 1, within its cell is a hash."""
        return np.floor((starts[cells] + places * sizes[cells]) * PARTS / n_nodes).astype(np.int32)

    def in_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.record_batch([pa.array(part_of(batch.column(0).to_numpy(), batch.column(1).to_numpy())), *batch.select(["cell", "node", "packed"]).columns], names=["part", "cell", "node", "packed"])

    places = 1 << 20
    placed = held.select("cell", (F.pmod(F.xxhash64("node"), F.lit(places)) / places).alias("place"), "node", "packed")
    dealt = placed.mapInArrow(in_parts, "part int, cell int, node bigint, packed binary")
    blocks = cut(_blocks(dealt), "blocks")
    drop_cut(held)
    of_all = np.arange(len(ids))
    return Cells(blocks, ids, landmarks, sizes, *((part_of(of_all, at) if n_nodes else of_all) for at in (0.0, (places - 1) / places)))


def _landmarks(nodes: DataFrame, n_nodes: int) -> tuple[np.ndarray, np.ndarray]:
    """Nodes and vectors of a bounded sample: some by a hash of the node, and the LONGEST of the largest norms. Near ones follow each other."""

    def shortest_rests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The last component is least for the largest norm.
        for batch in batches:
            if batch.num_rows:
                rests = _matrix(batch.column(1))[:, -1]
                some = pa.array(np.lexsort((batch.column(0).to_numpy(), rests))[:LONGEST])
                yield pa.record_batch([*(c.take(some) for c in batch.columns), pa.array(rests).take(some)], names=["node", "packed", "rest"])

    long = nodes.select("node", "packed").mapInArrow(shortest_rests, "node bigint, packed binary, rest float").orderBy("rest", "node").limit(LONGEST)
    spread = nodes.filter(F.pmod(F.xxhash64("node"), F.lit(max(1, n_nodes))) < min(ceil(PER_ROOT * n_nodes**0.5), SPREAD))
    of_node = {row.node: bytes(row.packed) for of in (spread, long) for row in of.select("node", "packed").collect()}
    if not of_node:
        return np.zeros(0, np.int64), np.zeros((0, 1), np.float32)
    ids = np.array(sorted(of_node), np.int64)
    matrix = np.frombuffer(b"".join(of_node[i] for i in ids.tolist()), np.float32).reshape(len(ids), -1)
    seeds = np.random.default_rng(0).permutation(len(ids))[:PARTS]
    order = np.argsort(_nearest_of(matrix, matrix[seeds], np.median(matrix, axis=0)), kind="stable")
    return ids[order], matrix[order]


def _nearest_of(vectors: np.ndarray, centres: np.ndarray, middle: np.ndarray) -> np.ndarray:
    """Which centre each vector is nearest to. Both are taken from the middle, as distances of far vectors would be rounded."""
    bases = centres - middle
    towards = np.column_stack([bases, (bases * bases).sum(1) / -2])
    return np.concatenate(
        [np.argmax(np.column_stack([v - middle, np.ones(len(v), np.float32)]) @ towards.T, axis=1) for v in np.split(vectors, range(512, len(vectors), 512))]
    )


def _in_cells(nodes: DataFrame, landmarks: np.ndarray) -> DataFrame:
    """(cell, node, packed): each node in the cell of its nearest landmark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        middle = np.median(landmarks, axis=0)
        for batch in batches:
            if batch.num_rows:
                cells = _nearest_of(_matrix(batch.column(1)), landmarks, middle).astype(np.int32)
                yield pa.record_batch([pa.array(cells), *batch.columns], names=["cell", "node", "packed"])

    return nodes.select("node", "packed").mapInArrow(run, "cell int, node bigint, packed binary")


def _blocks(dealt: DataFrame) -> DataFrame:
    """(part, ids, cells, packed): up to _BLOCK nodes of a part in one row, in the order of their cells, as bytes of int64, int32 and float32."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in _runs(batch):
                for at in range(0, some.num_rows, _BLOCK):
                    part, cells, ids, packed = some.slice(at, _BLOCK).columns
                    content = (ids.to_numpy().tobytes(), cells.to_numpy().tobytes(), _content(packed).tobytes())
                    yield pa.record_batch([part.slice(0, 1), *(pa.array([c], pa.binary()) for c in content)], names=["part", "ids", "cells", "packed"])

    return dealt.repartition("part").sortWithinPartitions("part", "cell").mapInArrow(run, "part int, ids binary, cells binary, packed binary")


def _runs(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The rows that follow each other with equal first columns."""
    if batch.num_rows:
        keys = batch.column(0).to_numpy()
        edges = [0, *(np.flatnonzero(np.diff(keys)) + 1).tolist(), len(keys)]
        for begin, end in zip(edges, edges[1:]):
            yield batch.slice(begin, end - begin)


def _content(column: pa.Array) -> np.ndarray:
    """All bytes of a column without nulls, one value after the other."""
    _, offsets, data = column.buffers()
    wide = pa.types.is_large_binary(column.type)
    ends = np.frombuffer(offsets, np.int64 if wide else np.int32, len(column) + column.offset + 1)[column.offset :]
    return np.frombuffer(data, np.uint8, ends[-1] - ends[0], ends[0]) if ends[-1] > ends[0] else np.zeros(0, np.uint8)


def _matrix(packed: pa.Array) -> np.ndarray:
    """Vectors of one length, none of them null, as a matrix."""
    return _content(packed).view(np.float32).reshape(len(packed), -1)


def _lists(rows: list[tuple]) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _LIST_SCHEMA, strict=True)], schema=_LIST_SCHEMA)


def _flat_lists(nodes: np.ndarray, packed: pa.Array, ends: np.ndarray, ids, scores, fresh) -> pa.RecordBatch:
    """Lists from their values one after the other and where each list ends."""
    edges = pa.array(np.append(0, ends), pa.int32())
    lists = [pa.ListArray.from_arrays(edges, pa.array(v, t)) for v, t in ((ids, pa.int64()), (scores, pa.float32()), (fresh, pa.bool_()))]
    return pa.record_batch([pa.array(nodes, pa.int64()), packed, *lists], schema=_LIST_SCHEMA)


def _merged(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Lists that follow each other with equal nodes as one list of the `most` best, without the node itself."""
    left = None
    for batch in batches:
        held = batch if left is None else pa.concat_batches([left, batch.cast(left.schema)])
        if not held.num_rows:
            continue
        nodes = held.column(0).to_numpy()
        last = int(np.searchsorted(nodes, nodes[-1]))
        if last:
            yield _merge(held.slice(0, last), most)
        left = held.slice(last)
        if left.num_rows > _HUB:
            left = _merge(left, 8 * most)
    if left is not None and left.num_rows:
        yield _merge(left, most)


def _merge(lists: pa.RecordBatch, most: int) -> pa.RecordBatch:
    nodes, group = np.unique(lists.column(0).to_numpy(), return_inverse=True)
    of = np.repeat(group, pc.list_value_length(lists.column(2)).to_numpy())
    ids, scores, fresh = (lists.column(c).flatten().to_numpy(zero_copy_only=False) for c in (2, 3, 4))
    # Each id once; one met already is not fresh again.
    others = np.flatnonzero(ids != nodes[of])
    order = others[np.lexsort((ids[others], of[others]))]
    of, ids, scores, fresh = of[order], ids[order], scores[order], fresh[order]
    new = np.ones(len(ids), bool)
    new[1:] = (of[1:] != of[:-1]) | (ids[1:] != ids[:-1])
    starts = np.flatnonzero(new)
    if len(starts):
        of, ids = of[starts], ids[starts]
        scores, fresh = np.maximum.reduceat(scores, starts), np.logical_and.reduceat(fresh, starts)
    order = np.lexsort((ids, -scores, of))
    of, ids, scores, fresh = of[order], ids[order], scores[order], fresh[order]
    first = np.searchsorted(of, np.arange(len(nodes)))
    kept = np.arange(len(of)) - first[of] < most
    ends = np.cumsum(np.bincount(of[kept], minlength=len(nodes)))
    # A node's vector comes with one of its lists.
    given = np.flatnonzero(lists.column(1).is_valid().to_numpy(zero_copy_only=False))
    carrier = np.full(len(nodes), -1)
    carrier[group[given[::-1]]] = given[::-1]
    packed = lists.column(1).take(pa.array(carrier, pa.int64(), mask=carrier < 0))
    return _flat_lists(nodes, packed, ends, ids[kept], scores[kept], fresh[kept])


def beam_of(n_nodes: int, k: int) -> int:
    """How much of a table a query looks into, in SCORED nodes. A fixed number would find ever less of a growing table."""
    return max(ceil(BEAM * max(1.0, n_nodes / BEAM_NODES) ** BEAM_GROWTH), 2 * k)


def search(nodes: DataFrame, members: DataFrame, asked: DataFrame, cells: Cells, k: int, beam: int | None = None) -> DataFrame:
    """(query_id, rank, vec_id, score) by walks from part to part, those of the best landmarks first.

    A query scores all nodes of the cells whose landmarks are best, beam times SCORED
    nodes or the whole table, but for cells too narrow to hold a better one than it has. It keeps twice
    as many as are ranked, which makes up for rounding; the result is ranked by the vectors as given.
    In a list of candidates `fresh` are those that the last round brought.
    Without `beam`, what a query looks into grows with the number of nodes.
    """
    beam, kept = beam or beam_of(nodes.count(), k), 2 * k
    of_query = asked.select(F.col("query").alias("node")).distinct().join(nodes, "node").select(F.col("node").alias("query"), F.col("packed").alias("asked"))
    ways = cut(_ways(of_query, cells, beam * SCORED, kept), "ways")
    begun = ways.select(F.col("query").alias("node"), F.col("asked").alias("packed"), "ids", "scores", "fresh")
    beams, visited, longest = begun, 0, ways.agg(F.max(F.size("parts")).alias("most")).first()["most"] or 0
    while visited < longest:
        at_once = min(GROWING * visited, EXPANDED) or FIRST
        worst = F.coalesce(F.get("scores", F.lit(kept - 1)), F.lit(float("-inf")))
        going = ways.select("query", "asked", "least", F.slice("parts", visited + 1, at_once).alias("next")).join(beams.select(F.col("node").alias("query"), worst.alias("worst")), "query")
        steps = going.select(F.explode("next").alias("part"), "query", "worst", "least", F.lit(kept).alias("most"), "asked")
        seen = beams.withColumn("fresh", F.transform("fresh", lambda x: F.lit(False)))
        moved = cut(_beams(seen.union(_scored(steps, cells)), kept), "beams")
        if beams is not begun:
            drop_cut(beams)
        beams, visited = moved, visited + at_once
    return _ranked(beams, members, asked, k)


def _ways(of_query: DataFrame, cells: Cells, n_scored: int, kept: int) -> DataFrame:
    """(query, asked, least, parts, ids, scores, fresh): which cells a query looks into, those of landmarks from `least` on,
    the parts that hold them, the best first, and its best landmarks, with which its list begins."""
    ids, n_cells = cells.ids, len(cells.ids)
    # One that is there only for parts at the end.
    bases = np.vstack([cells.landmarks[:, :-1], np.zeros((1, cells.landmarks.shape[1] - 1))]).astype(np.float64)
    numbers = np.arange(PARTS)
    begins, ends = np.searchsorted(cells.last, numbers), np.searchsorted(cells.first, numbers, "right")
    numbers = numbers[begins < ends]
    edges = np.column_stack([begins, ends])[numbers].ravel()
    by_id = np.argsort(ids)
    sorted_ids = ids[by_id]
    sizes = cells.sizes.astype(np.float32)
    few = min(kept, n_cells)
    kinds = (pa.int64(), pa.binary(), pa.float64(), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.float64()), pa.list_(pa.bool_()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                queries = some.column(0).to_numpy()
                scores = _matrix(some.column(1))[:, :-1].astype(np.float64) @ bases.T
                scores[:, -1] = -np.inf
                least = _least(scores[:, :-1], sizes, n_scored)
                best = np.maximum.reduceat(scores, edges, axis=1)[:, ::2]
                order = np.argsort(-best, axis=1, kind="stable")
                parts = [numbers[o[:n]].astype(np.int32) for o, n in zip(order, (best >= least[:, None]).sum(1), strict=True)]
                # A query isn't its own neighbour.
                own = np.minimum(np.searchsorted(sorted_ids, queries), n_cells - 1)
                of_own = np.flatnonzero(sorted_ids[own] == queries)
                scores[of_own, by_id[own[of_own]]] = -np.inf
                top = np.argpartition(scores, n_cells + 1 - few, axis=1)[:, n_cells + 1 - few :]
                top = np.take_along_axis(top, np.argsort(-np.take_along_axis(scores, top, 1), axis=1, kind="stable"), 1)
                there = [t[s > -np.inf] for t, s in zip(top, np.take_along_axis(scores, top, 1), strict=True)]
                columns = (queries, some.column(1), least, parts, [ids[t] for t in there], [s[t] for s, t in zip(scores, there, strict=True)], [np.ones(len(t), bool) for t in there])
                yield pa.record_batch([c if isinstance(c, pa.Array) else pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["query", "asked", "least", "parts", "ids", "scores", "fresh"])

    return of_query.mapInArrow(run, "query bigint, asked binary, least double, parts array<int>, ids array<bigint>, scores array<double>, fresh array<boolean>")


def _least(scores: np.ndarray, sizes: np.ndarray, n_scored: int) -> np.ndarray:
    """For each row the score from which on its cells hold `n_scored` nodes, or few more."""
    if n_scored >= sizes.sum():
        return np.full(len(scores), -np.inf)
    scores = scores.astype(np.float32)
    low, high = scores.min(1), scores.max(1)
    for _ in range(48):
        middle = (low + high) / 2
        held = (scores >= middle[:, None]) @ sizes
        low, high = np.where(held >= n_scored, middle, low), np.where(held >= n_scored, high, middle)
        if ((held >= n_scored) & (held <= 1.02 * n_scored) | (low >= high)).all():
            break
    # Below what was rounded to it.
    return np.nextafter(low, np.float32(-np.inf)).astype(np.float64)


def _scored(steps: DataFrame, cells: Cells) -> DataFrame:
    """What each step, a query's visit of a part, meets that is better than the worst its query keeps; the `most` best of it."""
    bases = cells.landmarks[:, :-1]
    # Of a part that many want each share of the steps has a copy of the blocks.
    wanted = {row["part"]: row["count"] for row in steps.groupBy("part").count().collect()}
    shares = F.array(*(F.lit(max(1, ceil(wanted.get(part, 0) * PARTS / (2 * sum(wanted.values()) or 1)))) for part in range(PARTS)))[F.col("part")]
    # Bytes instead of arrays, as Spark counts an Arrow batch's null arrays anew for every row.
    none = {c: F.lit(None).cast(t).alias(c) for c, t in (("query", "bigint"), ("worst", "double"), ("least", "double"), ("most", "int"))}
    empty = F.lit(b"")
    share_of = lambda share: (F.col("part") + PARTS * share).alias("share")
    copies = cells.blocks.select("*", F.explode(F.sequence(F.lit(0), shares - 1)).alias("copy"))
    of_parts = copies.select(share_of(F.col("copy")), none["query"], none["worst"], none["least"], none["most"], "packed", "ids", "cells")
    share = share_of(F.pmod(F.xxhash64("query"), shares).cast("int"))
    rows = of_parts.union(steps.select(share, "query", "worst", "least", "most", "asked", empty, empty))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Blocks have no query, so they come before the steps of their share.
        number, blocks, part = None, [], None
        for batch in batches:
            for some in _runs(batch):
                if some.column(0)[0].as_py() != number:
                    number, blocks, part = some.column(0)[0].as_py(), [], None
                begin = some.column(1).null_count
                if begin:
                    blocks.append(some.slice(0, begin))
                for at in range(begin, some.num_rows if blocks else 0, _QUERIES):
                    part = part or _Part.of(blocks, bases)
                    yield from part.better(some.slice(at, _QUERIES))

    return rows.repartition("share").sortWithinPartitions("share", "query").mapInArrow(run, _LISTS)


class _Part(NamedTuple):
    """The nodes of a part by cell: where the cells begin, their landmarks and radii, and what leads from these to the nodes."""

    ids: np.ndarray
    edges: np.ndarray
    bases: np.ndarray
    radii: np.ndarray
    rests: np.ndarray

    @classmethod
    def of(cls, blocks: list[pa.RecordBatch], bases: np.ndarray) -> "_Part":
        packed, ids, cells = (np.concatenate([_content(b.column(c)) for b in blocks]).view(t) for c, t in ((5, np.float32), (6, np.int64), (7, np.int32)))
        vectors = packed.reshape(len(ids), -1)
        order = np.argsort(cells, kind="stable")
        numbers, begins = np.unique(cells[order], return_index=True)
        rests = vectors[order, :-1] - bases[cells[order]]
        radii = np.sqrt(np.maximum.reduceat((rests * rests).sum(1), begins))
        return cls(ids[order], np.append(begins, len(ids)), bases[numbers].astype(np.float64), radii, rests)

    def better(self, steps: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        asked = np.ascontiguousarray(_matrix(steps.column(5))[:, :-1])
        worst, least, most = steps.column(2).to_numpy().copy(), steps.column(3).to_numpy(), steps.column(4)[0].as_py()
        towards = asked.astype(np.float64) @ self.bases.T
        reach = np.linalg.norm(asked, axis=1)[:, None] * (1.00001 * self.radii)
        looks = (towards >= least[:, None]) & (towards + reach > worst[:, None])
        met, n_met, bound = [], 0, _MET
        room, marks = np.empty(len(asked) * _PIECE, np.float32), np.zeros(len(asked) * _PIECE + 8, bool)
        for cell in np.flatnonzero(looks.any(0)):
            some = np.flatnonzero(looks[:, cell])
            lookers = asked if len(some) == len(asked) else np.take(asked, some, axis=0)
            needed = (worst[some] - towards[some, cell]).astype(np.float32)[:, None]
            for begin in range(self.edges[cell], self.edges[cell + 1], _PIECE):
                piece = self.rests[begin : min(begin + _PIECE, self.edges[cell + 1])]
                shape, size = (len(some), len(piece)), len(some) * len(piece)
                scores = np.matmul(lookers, piece.T, out=room[:size].reshape(shape))
                np.greater(scores, needed, out=marks[:size].reshape(shape))
                # Few are marked, so they are looked for by eight.
                marks[size : size + 8] = False
                by_eight = np.flatnonzero(marks[: -(-size // 8) * 8].view(np.uint64))
                if len(by_eight):
                    at = (8 * by_eight[:, None] + np.arange(8)).ravel()
                    at = at[marks[at]]
                    of = some[at // len(piece)]
                    met.append((of, self.ids[begin + at % len(piece)], towards[of, cell] + room[at]))
                    n_met += len(at)
            if n_met > bound:
                met = [_firsts(met, most)]
                of, _, scores = met[0]
                n_met, bound = len(of), max(_MET, 2 * len(of))
                full = np.flatnonzero(np.arange(len(of)) - np.searchsorted(of, of) == most - 1)
                worst[of[full]] = np.maximum(worst[of[full]], scores[full])
        if met:
            of, ids, scores = _firsts(met, most)
            which = np.flatnonzero(np.diff(of, prepend=-1))
            ends = np.append(which[1:], len(of))
            queries = steps.column(1).to_numpy()[of[which]]
            yield _flat_lists(queries, pa.nulls(len(which), pa.binary()), ends, ids, scores, np.ones(len(of), bool))


def _firsts(met: list[tuple[np.ndarray, ...]], most: int) -> tuple[np.ndarray, ...]:
    """Of what is met (of, ids, scores) the `most` best of each, the best first."""
    of, ids, scores = map(np.concatenate, zip(*met, strict=True))
    order = np.lexsort((ids, -scores, of))
    order = order[np.arange(len(of)) - np.searchsorted(of[order], of[order]) < most]
    return of[order], ids[order], scores[order]


def _beams(lists: DataFrame, beam: int) -> DataFrame:
    """One list of the best for each query, without itself. """

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _merged(batches, beam)

    return lists.repartition("node").sortWithinPartitions("node").mapInArrow(merge, _LISTS)


def _ranked(beams: DataFrame, members: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """Nodes found become rows, a query's own vector among them, with exact scores. All that may be among the k best go in."""
    enough = F.coalesce(F.get("scores", F.lit(k - 1)), F.lit(float("-inf"))) - _ROUNDED
    near = F.filter("ids", lambda x, i: F.get("scores", i) >= enough)
    found = beams.select(F.col("node").alias("query"), F.explode(F.concat(near, F.array("node"))).alias("node"))
    pairs = asked.join(found, "query").join(members, "node").filter("vec_id <> query_id").select("query_id", "vec_id", "asked", "vector")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                # Added up one after the other, in whatever batch a pair is.
                products = _given(batch.column(2)) * _given(batch.column(3))
                yield pa.record_batch([*batch.columns[:2], pa.array(np.cumsum(products, axis=1)[:, -1])], names=["query_id", "vec_id", "score"])

    scored = pairs.mapInArrow(score, "query_id bigint, vec_id bigint, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
