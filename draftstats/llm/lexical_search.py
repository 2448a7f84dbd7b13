"""Ranked lexical search over hashed max-sketches.

A document's impacts are folded into a sketch: each term is hashed to some
coordinates, and a coordinate keeps the largest impact that fell on it. A
document's impact grows with the term's occurrences alone, so occurrences are
what is kept, and the impact follows from the length of the document.

A query term's impact is at most the least of its coordinates, so lookups give
each document an upper bound for each query of a batch. Two passes over the
sketches follow: the first one finds documents of high bounds, whose exact
scores set each query's threshold; the second goes through each batch of
documents by descending bound, scores exactly, and stops at the threshold.
"""

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from heapq import heappush, heapreplace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import batches_of, cut

# Coordinates of a sketch for each distinct term, at least, and how many of them a term falls on.
WIDTH, ROWS = 8, 3
# Occurrences from which on a coordinate says only that there are many.
_MANY = 255
# Bytes of query terms that go through the sketches together, and documents whose bounds are ordered together.
BATCH_BYTES = 4_000_000
_DOCS_AT_ONCE = 512
_SLICE = 1 << 20
_SHIFTS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], np.uint32)

_INDEX = pa.schema(
    [("doc_id", pa.int64()), ("n_terms", pa.int64()), ("sketch", pa.binary()), ("terms", pa.binary()), ("counts", pa.binary())]
)
_INDEX_DDL = "doc_id bigint, n_terms bigint, sketch binary, terms binary, counts binary"
_FOUND = pa.schema([("item_id", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])
_FOUND_DDL = "item_id bigint, doc_id bigint, score bigint"


def _folded() -> bytes:
    """A-Z to a-z; what is neither ASCII letter, digit nor part of another character to a blank."""
    keep = set(b"0123456789abcdefghijklmnopqrstuvwxyz") | set(range(0x80, 0x100))
    return bytes(b if b in keep else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


_FOLDED = _folded()


def counted_terms(text: str | None) -> Counter:
    """A text's terms, as UTF-8, with their occurrences. Very long texts go through in slices."""
    data, at, found = (text or "").encode().translate(_FOLDED), 0, Counter()
    while at < len(data):
        end = data.find(b" ", at + _SLICE)
        end = len(data) if end < 0 else end
        found.update(data[at:end].split())
        at = end
    return found


def _hashes(terms) -> np.ndarray:
    """For each of a sketch's rows the terms' 32-bit hashes; their leading bits are the coordinates."""
    plain = np.fromiter(map(zlib.crc32, terms), np.uint32, len(terms))
    return (plain[None, :] ^ (plain[None, :] >> np.uint32(15))) * _SHIFTS[:ROWS, None]


def sketch(terms, counts: np.ndarray) -> np.ndarray:
    """Coordinatewise maxima, a power of two of them."""
    bits = max(3, (WIDTH * len(terms) - 1).bit_length())
    held = np.zeros(1 << bits, np.uint8)
    at = _hashes(terms) >> np.uint32(32 - bits)
    if len(terms):
        # Numpy keeps the last of equal places, so the largest goes last.
        order = np.argsort(counts, kind="stable")
        small = np.minimum(counts[order], _MANY).astype(np.uint8)
        held[at[0][order]] = small
        for row in at[1:]:
            np.maximum.at(held, row[order], small)
    return held


def index(docs: DataFrame) -> DataFrame:
    """(doc_id, n_terms, sketch, terms, counts) of every row: the sketch, and the exact occurrences for rescoring.

    It does not depend on queries, and is written once for any number of
    batches. Texts without terms have an empty row. Null ids and repeated rows
    are rows like any other; other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                for i in range(batch.num_rows):
                    found = counted_terms(batch.column(1)[i].as_py())
                    counts = np.fromiter(found.values(), np.int64, len(found))
                    held = sketch(found, counts).tobytes() if found else b""
                    yield batch.column(0)[i].as_py(), int(counts.sum()), held, b" ".join(found), counts.astype("<u4").tobytes()

        return batches_of(_INDEX, rows(), 500)

    texts = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return texts.mapInArrow(run, _INDEX_DDL)


@dataclass
class Batch:
    """Some queries' terms, and after `weigh` their weights and the corpus's size."""

    items: list
    terms: list[bytes]
    #: Places of each item's terms among `terms`, one item after the other, and where each item starts.
    places: np.ndarray
    starts: np.ndarray
    weights: np.ndarray | None = None
    n_docs: int = 0
    n_words: int = 0

    @classmethod
    def of(cls, terms_of: dict) -> "Batch":
        terms_of = {item: found for item, found in terms_of.items() if found}
        number = {term: i for i, term in enumerate(sorted(set().union(*terms_of.values())))}
        places = [np.array(sorted(map(number.get, found)), np.int64) for found in terms_of.values()]
        starts = np.cumsum([0, *map(len, places)])[:-1]
        return cls(list(terms_of), list(number), np.concatenate([np.zeros(0, np.int64), *places]), starts)

    def weigh(self, df: np.ndarray, n_docs: int, n_words: int) -> None:
        self.n_docs, self.n_words = n_docs, n_words
        self.weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(x) + 1))) for x in df], np.int64)

    def normal(self, n_terms: int) -> int:
        return 100 - 90 + (90 * n_terms * self.n_docs) // self.n_words

    def summed(self, impacts: np.ndarray) -> np.ndarray:
        """Each item's score from the impact of each term."""
        return np.add.reduceat((self.weights * impacts)[self.places], self.starts)


def impacts(counts: np.ndarray, normal: int) -> np.ndarray:
    return (1_000_000_000 * counts) // (1000 * counts + 8 * normal)


class _Bounds:
    """Upper bounds of a batch's scores. The coordinates of its terms are kept for each width."""

    def __init__(self, batch: Batch):
        self._batch, self._hashes, self._at = batch, _hashes(batch.terms), {}

    def __call__(self, held: bytes, n_terms: int) -> np.ndarray:
        sketched = np.frombuffer(held, np.uint8)
        bits = len(sketched).bit_length() - 1
        if bits not in self._at:
            self._at[bits] = (self._hashes >> np.uint32(32 - bits)).astype(np.intp)
        first, *rest = self._at[bits]
        most = sketched[first]
        there = np.flatnonzero(most)
        most = most[there]
        for row in rest:
            most = np.minimum(most, sketched[row[there]])
        seen = np.flatnonzero(most)
        there, most = there[seen], most[seen].astype(np.int64)
        most[most == _MANY] = 1 << 30
        whole = np.zeros(len(self._batch.terms), np.int64)
        whole[there] = impacts(most, self._batch.normal(n_terms))
        # Impacts stay below a million, which is what counts beyond any may have.
        return self._batch.summed(whole)


class _Exact:
    """Scores from a document's own terms."""

    def __init__(self, batch: Batch):
        self._batch, self._number = batch, {term: i for i, term in enumerate(batch.terms)}

    def __call__(self, terms: bytes, counts: bytes, n_terms: int) -> np.ndarray:
        found = [(self._number[t], c) for t, c in zip(terms.split(b" "), np.frombuffer(counts, "<u4").tolist(), strict=True) if t in self._number]
        whole = np.zeros(len(self._batch.terms), np.int64)
        if found:
            places, occurrences = np.array(found, np.int64).T
            whole[places] = impacts(occurrences, self._batch.normal(n_terms))
        return self._batch.summed(whole)


def search(index: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """(item_id, rank, doc_id, score): each item's `k` documents of the highest scores above 0, ties to smaller ids.

    Exact: the bounds leave out only documents that cannot be among them. Rows
    of `items` that share an id are one item with the terms of all of them.
    Items without terms and items that match nothing have no rows; no documents
    give none. A null document id comes last among equal scores. Other columns
    of either table are ignored.

    Items go through the documents in batches of a bounded number of bytes of
    terms, however many there are; only a batch reaches the driver.
    """
    spark = index.sparkSession
    index = cut(index, "index")
    n_docs, n_words = index.agg(F.count_if(F.col("n_terms") > 0), F.coalesce(F.sum("n_terms"), F.lit(0))).first()
    texts = items.select(F.col("item_id").cast("bigint").alias("item_id"), F.col("text").cast("string").alias("text")).filter("text is not null")
    size = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    n_batches = max(1, math.ceil(size / BATCH_BYTES))
    results = spark.createDataFrame([], f"{_FOUND_DDL}, rank int")
    for number in range(n_batches if n_docs else 0):
        terms_of: dict[int | None, set] = {}
        for row in texts.filter(F.pmod(F.xxhash64("item_id"), F.lit(n_batches)) == number).toLocalIterator():
            terms_of.setdefault(row.item_id, set()).update(counted_terms(row.text))
        batch = Batch.of(terms_of)
        if batch.items:
            batch.weigh(_document_frequencies(index, batch.terms), n_docs, n_words)
            found = _descended(index, batch, k, _thresholds(index, batch, k))
            results = results.union(_best(found, k))
    return results.select("item_id", "rank", "doc_id", "score")


def _document_frequencies(index: DataFrame, terms: list[bytes]) -> np.ndarray:
    """How many documents hold each term, over all documents."""
    number = {term: i for i, term in enumerate(terms)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for held in batch.column(0):
                seen.update(number.keys() & held.as_py().split(b" "))
        if seen:
            yield pa.record_batch([pa.array(map(number.get, seen), pa.int64()), pa.array(seen.values(), pa.int64())], ["place", "df"])

    counted = index.select("terms").mapInArrow(run, "place bigint, df bigint").groupBy("place").agg(F.sum("df").alias("df"))
    df = np.zeros(len(terms), np.int64)
    for row in counted.toLocalIterator():
        df[row.place] = row.df
    return df


def _thresholds(index: DataFrame, batch: Batch, k: int) -> dict:
    """For each item the least score its `k` best can have: the k-th exact score among documents of the highest bounds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bounds, exact = _Bounds(batch), _Exact(batch)
        # Each item's documents of the highest bounds in this task.
        held: list[list[tuple]] = [[] for _ in batch.items]
        place = 0
        for arrow in batches:
            doc_ids, n_terms, sketches, terms, counts = (column.to_pylist() for column in arrow.columns)
            for i, n in enumerate(n_terms):
                if not n:
                    continue
                of = bounds(sketches[i], n)
                place += 1
                for item in np.flatnonzero(of):
                    entry = (int(of[item]), place, doc_ids[i], (terms[i], counts[i], n))
                    if len(held[item]) < k:
                        heappush(held[item], entry)
                    elif entry[0] > held[item][0][0]:
                        heapreplace(held[item], entry)
        scores: dict[int, np.ndarray] = {}
        rows = []
        for item, entries in enumerate(held):
            for _, place, doc_id, own in entries:
                if place not in scores:
                    scores[place] = exact(*own)
                rows.append((batch.items[item], doc_id, int(scores[place][item])))
        yield from batches_of(_FOUND, (row for row in rows if row[2] > 0))

    best = _best(index.mapInArrow(run, _FOUND_DDL), k)
    return {row.item_id: row.score for row in best.filter(F.col("rank") == k).toLocalIterator()}


def _descended(index: DataFrame, batch: Batch, k: int, thresholds: dict) -> DataFrame:
    """(item_id, doc_id, score): at most `k` rows of an item from each task, and all that may be among the best."""
    least = np.array([thresholds.get(item, 1) for item in batch.items], np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bounds, exact = _Bounds(batch), _Exact(batch)
        # Each item's best of this task: (score, -id), the worst of them first; a null id is behind all others.
        held: list[list[tuple]] = [[] for _ in batch.items]
        bar = least.copy()
        for arrow in batches:
            for at in range(0, arrow.num_rows, _DOCS_AT_ONCE):
                doc_ids, n_terms, sketches, terms, counts = (column.to_pylist() for column in arrow.slice(at, _DOCS_AT_ONCE).columns)
                rows = [i for i, n in enumerate(n_terms) if n]
                if not rows:
                    continue
                of = np.stack([bounds(sketches[i], n_terms[i]) for i in rows])
                scores: dict[int, np.ndarray] = {}
                for item in np.flatnonzero((of >= bar).any(axis=0)):
                    own = of[:, item]
                    for j in np.argsort(-own, kind="stable"):
                        # All further documents have bounds below what is needed.
                        if own[j] < bar[item]:
                            break
                        i = rows[j]
                        if i not in scores:
                            scores[i] = exact(terms[i], counts[i], n_terms[i])
                        score = int(scores[i][item])
                        if score < bar[item]:
                            continue
                        entry = (score, -math.inf if doc_ids[i] is None else -doc_ids[i])
                        if len(held[item]) < k:
                            heappush(held[item], entry)
                        elif entry > held[item][0]:
                            heapreplace(held[item], entry)
                        if len(held[item]) == k:
                            bar[item] = max(bar[item], held[item][0][0])
        found = (
            (batch.items[item], None if place == -math.inf else -place, score)
            for item, entries in enumerate(held)
            for score, place in entries
        )
        yield from batches_of(_FOUND, found)

    return index.mapInArrow(run, _FOUND_DDL)


def _best(found: DataFrame, k: int) -> DataFrame:
    """The first `k` rows of each item with their ranks. Parts of an item are ranked first, so no task ranks all of its rows."""
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    parts = int(found.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = found.withColumn("part", F.pmod(F.xxhash64("doc_id", "score"), F.lit(parts)))
    some = dealt.withColumn("rank", F.row_number().over(Window.partitionBy("item_id", "part").orderBy(*order))).filter(F.col("rank") <= k)
    ranked = some.drop("part").withColumn("rank", F.row_number().over(Window.partitionBy("item_id").orderBy(*order)))
    return ranked.filter(F.col("rank") <= k)


def search_sql(k: int = 10) -> str:
    """The same rows in DuckDB: every document scored for every item whose terms it holds."""
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    terms = f"unnest(regexp_extract_all({lower}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term"
    return f"""
WITH numbered AS (SELECT row_number() OVER () AS row, doc_id, text FROM documents),
tf AS (SELECT row, doc_id, term, count(*)::hugeint AS tf FROM (SELECT row, doc_id, {terms} FROM numbered) GROUP BY ALL),
lengths AS (SELECT row, sum(tf) AS n FROM tf GROUP BY row),
totals AS (SELECT count(*)::hugeint AS n_docs, sum(n) AS n_words FROM lengths),
wanted AS (SELECT DISTINCT item_id, term FROM (SELECT item_id, {terms} FROM benchmark)),
weights AS (
  SELECT term, floor(1000 * ln((2 * n_docs + 2)::double / (2 * count(*) + 1)::double))::hugeint AS w
  FROM tf, totals GROUP BY term, n_docs),
scores AS (
  SELECT item_id, row, doc_id,
         sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * n_docs) // n_words)))) AS score
  FROM wanted JOIN tf USING (term) JOIN weights USING (term) JOIN lengths USING (row), totals GROUP BY ALL),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scores WHERE score > 0)
SELECT item_id, rank::int AS rank, doc_id, score::bigint AS score FROM ranked WHERE rank <= {k}"""
