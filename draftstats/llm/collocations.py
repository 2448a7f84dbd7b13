"""Phrase collocations by marginalising counts of the longest windows.

At every word stand four lead columns: the word and the three after it in its
piece, padded with nulls. Only these longest windows are counted; ROLLUP sums
them to all shorter phrases, since a phrase of k words occurs where the first k
columns hold it.

Most windows of a corpus occur once, so windows are cut to the prefix that may
be frequent before they are counted. Whether a prefix may be is read from bits
over hashes, which passes before add up: one for words and pairs, one for longer
prefixes of which all pairs may be frequent. Prefixes that share a hash only add
up, so no frequent one is missed, and what passes wrongly is dropped by its
exact count.
"""

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut
from .hash_counts import frequent_hashes, is_set

# Words in the longest window.
LONGEST = 4
# log2 of the number of hashes: the bits are 8 MB whatever the data.
_BITS = 26
# Words of a text's slice, words and languages that a task codes at a time.
_SLICE = 1 << 20
_WORDS_AT_ONCE = 1_000_000
_LANGS_AT_ONCE = 50_000
_BREAK = b"."
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)


def _folded() -> bytes:
    """A-Z to a-z, what ends a piece to the break mark, tabs to blanks."""
    table = bytearray(range(256))
    for upper in range(ord("A"), ord("Z") + 1):
        table[upper] = upper + 32
    for end in b".,;:!?\x0a\x0b\x0c\x0d":
        table[end] = _BREAK[0]
    table[ord("\t")] = ord(" ")
    return bytes(table)


_FOLDED = _folded()
_WORD_COLUMNS = [f"w{i}" for i in range(1, LONGEST + 1)]
_WINDOW = pa.schema([("lang", pa.string()), *[(w, pa.string()) for w in _WORD_COLUMNS], ("n", pa.int64())])
_WINDOW_DDL = "lang string, w1 string, w2 string, w3 string, w4 string, n bigint"


class _Codes(dict):
    """Words by number of first sight; 0 is the break between pieces."""

    def __init__(self):
        super().__init__({_BREAK: 0})

    def __missing__(self, word: bytes) -> int:
        self[word] = code = len(self)
        return code


class _Chunk:
    """Coded words of some documents: `codes`, with breaks between pieces and documents, and the language of each."""

    def __init__(self):
        self.words, self.langs = _Codes(), {}
        self._codes: list[np.ndarray] = []
        self._of: list[np.ndarray] = []
        self.size = 0

    def add(self, lang: str, text: str) -> None:
        number = self.langs.setdefault(lang, len(self.langs))
        for codes in _coded(text, self.words):
            self._codes.append(codes)
            self._of.append(np.full(len(codes), number, np.uint32))
            self.size += len(codes)

    def columns(self) -> tuple[np.ndarray, np.ndarray]:
        """The lead columns, 0 from the first break on, and each word's language."""
        codes, langs = np.concatenate(self._codes), np.concatenate(self._of)
        leads = np.zeros((LONGEST, len(codes)), np.uint32)
        leads[0] = codes
        for k in range(1, LONGEST):
            leads[k, :-k] = np.where(leads[k - 1, :-k] != 0, codes[k:], 0)
        kept = codes != 0
        return leads[:, kept], langs[kept]

    def hashes(self, leads: np.ndarray, langs: np.ndarray) -> Iterator[np.ndarray]:
        """For each length of a prefix its number below 2 ** _BITS, with the language's."""
        words = np.fromiter(map(zlib.crc32, self.words), np.uint64, len(self.words))
        named = np.fromiter((zlib.crc32(lang.encode()) for lang in self.langs), np.uint64, len(self.langs))
        mixed = named[langs]
        for k in range(LONGEST):
            mixed = (mixed ^ words[leads[k]]) * _FACTORS[k]
            mixed ^= mixed >> np.uint64(29)
            yield ((mixed * _FACTORS[0]) >> np.uint64(64 - _BITS)).astype(np.uint32)


def _coded(text: str, words: _Codes) -> Iterator[np.ndarray]:
    data, at = text.encode().translate(_FOLDED), 0
    while at < len(data):
        end = len(data) if len(data) - at <= _SLICE else max(data.find(b" ", at + _SLICE), -1)
        end = len(data) if end < 0 else end
        found = data[at:end].replace(_BREAK, b" . ").split()
        yield np.fromiter(map(words.__getitem__, found), np.uint32, len(found))
        at = end
    yield np.zeros(1, np.uint32)


def _chunks(batches: Iterable[pa.RecordBatch]) -> Iterator[_Chunk]:
    """Documents as chunks of some million words. A document is never split over two."""
    chunk = _Chunk()
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            chunk.add(lang, text)
            if chunk.size >= _WORDS_AT_ONCE or len(chunk.langs) >= _LANGS_AT_ONCE:
                yield chunk
                chunk = _Chunk()
    if chunk.size:
        yield chunk


def collocations(docs: DataFrame, least: int = 30, top: int = 2000) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) of each language's `top` phrases.

    Phrases of 2 to 4 words that occur `least` times or more, lower-cased A-Z,
    inside the pieces between marks and line ends. The score compares a phrase
    with its parts at the weakest cut; phrases that stand in a longer one four
    times out of five are left out.

    Null texts are empty; a null language is `und`. Repeated rows count as
    often as they occur. Other columns are ignored. No rows give none.
    """
    texts = docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )
    found = cut(phrases(texts, least), "phrases")
    by_lang = found.filter("size = 0").select("lang", F.col("f").alias("n"))
    known = found.filter("size > 0").select("lang", "phrase", "f")
    candidates = found.filter("size > 1")
    scored = _scored(candidates, known).join(_longer(candidates), ["lang", "phrase"], "left")
    # Products may pass 64 bits.
    part, whole = (F.lit(x).cast("decimal(3,0)") * F.col(c).cast("decimal(20,0)") for x, c in ((100, "longer"), (80, "a")))
    kept = scored.filter(F.col("longer").isNull() | (part < whole))
    ranked = _first(cut(kept.select("lang", "phrase", "a", "best"), "scored"), top)
    return ranked.join(by_lang, "lang").select(
        "lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "best.l", "best.r", "n", "best.score"
    )


def phrases(texts: DataFrame, least: int) -> DataFrame:
    """(lang, phrase, words, size, f) of all phrases of 1 to 4 words that occur `least` times; size 0 is all words of a language."""
    send = texts.sparkSession.sparkContext.broadcast
    short = frequent_hashes(texts, _short_hashes, least, _BITS)
    long = send(frequent_hashes(texts, _long_hashes(short), least, _BITS))
    short = send(short)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in _chunks(batches):
            yield from _windows(chunk, short.value, long.value)

    windows = texts.mapInArrow(run, _WINDOW_DDL)
    longest = cut(windows.groupBy("lang", *_WORD_COLUMNS).agg(F.sum("n").alias("n")), "windows")
    sums = longest.rollup("lang", *_WORD_COLUMNS).agg(F.sum("n").alias("f"), F.grouping_id().alias("rolled"))
    # k columns rolled up are k ones in the number; what a sum holds of the other columns is its phrase.
    words = F.array(*_WORD_COLUMNS)
    size = F.lit(LONGEST) - F.bit_count("rolled").cast("int")
    held = sums.filter(F.col("lang").isNotNull() & (F.bit_count("rolled") <= LONGEST)).select(
        "lang", "f", size.alias("size"), F.slice(words, F.lit(1), size).alias("words"), F.get(words, size - 1).alias("last")
    )
    # A sum over windows that end before its last column is no phrase.
    whole = (F.col("size") == 0) | (F.col("last").isNotNull() & (F.col("f") >= least))
    return held.filter(whole).select("lang", F.concat_ws(" ", "words").alias("phrase"), "words", "size", "f")


def _short_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    """Of all words and pairs."""
    for chunk in _chunks(batches):
        leads, langs = chunk.columns()
        words, pairs, *_ = chunk.hashes(leads, langs)
        yield np.concatenate([words, pairs[leads[1] != 0]])


def _long_hashes(short: np.ndarray):
    """Of the longer prefixes in which no word and no pair is rare."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        for chunk in _chunks(batches):
            leads, langs = chunk.columns()
            hashes = list(chunk.hashes(leads, langs))
            _, _, three, four = _not_rare(leads, hashes, short)
            yield np.concatenate([hashes[2][three], hashes[3][four]])

    return run


def _not_rare(leads: np.ndarray, hashes: list[np.ndarray], short: np.ndarray) -> list[np.ndarray]:
    """For each length where a prefix stands in which no word and no pair is rare."""
    word = is_set(short, hashes[0])
    pair = word & (leads[1] != 0) & is_set(short, hashes[1])
    found = [word, pair]
    for k in range(2, LONGEST):
        # The pair that ends a prefix begins k - 1 words on.
        last = np.append(pair[k - 1 :], np.zeros(min(k - 1, len(pair)), bool))
        found.append(found[-1] & (leads[k] != 0) & last)
    return found


def _windows(chunk: _Chunk, short: np.ndarray, long: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The chunk's distinct windows, cut to what may be frequent, with their counts."""
    leads, langs = chunk.columns()
    hashes = list(chunk.hashes(leads, langs))
    may = np.ones(len(langs), bool)
    for k, found in enumerate(_not_rare(leads, hashes, short)):
        may &= found if k < 2 else found & is_set(long, hashes[k])
        leads[k, ~may] = 0
    # Two numbers a window: codes fit 32 bits, and pairs of columns one word each.
    first = leads[0].astype(np.uint64) << np.uint64(32) | leads[1]
    second = leads[2].astype(np.uint64) << np.uint64(32) | leads[3]
    order = np.lexsort((second, first, langs))
    first, second, langs, leads = first[order], second[order], langs[order], leads[:, order]
    new = np.ones(len(order), bool)
    new[1:] = (first[1:] != first[:-1]) | (second[1:] != second[:-1]) | (langs[1:] != langs[:-1])
    starts = np.flatnonzero(new)
    n = np.diff(np.append(starts, len(order)))
    # The break's code gives null, which is the padding.
    words = pa.array([None, *[w.decode() for w in list(chunk.words)[1:]]], pa.large_string())
    names = pa.array(list(chunk.langs), pa.large_string())
    for at in range(0, len(starts), 50_000):
        some = starts[at : at + 50_000]
        columns = [names.take(pa.array(langs[some])), *[words.take(pa.array(leads[k][some])) for k in range(LONGEST)]]
        yield pa.record_batch([*[c.cast(pa.string()) for c in columns], pa.array(n[at : at + 50_000])], schema=_WINDOW)


def _score(a: Column, l: Column, r: Column) -> Column:
    # `div` of decimals is exact.
    a, l, r = (x.cast("decimal(20,0)") for x in (a, l, r))
    return F.call_function("div", F.lit(2_000_000).cast("decimal(8,0)") * a, l + r)


def _scored(candidates: DataFrame, known: DataFrame) -> DataFrame:
    """(lang, phrase, a, best): the cut of the lowest score, the first of equal ones."""
    cuts = candidates.select("lang", "phrase", F.col("f").alias("a"), "words", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    parts = cuts.select(
        "lang",
        "phrase",
        "a",
        "k",
        F.concat_ws(" ", F.slice("words", F.lit(1), F.col("k"))).alias("head"),
        F.concat_ws(" ", F.slice("words", F.col("k") + 1, F.size("words"))).alias("tail"),
    )
    heads = known.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l"))
    tails = known.select("lang", F.col("phrase").alias("tail"), F.col("f").alias("r"))
    both = parts.join(heads, ["lang", "head"]).join(tails, ["lang", "tail"])
    cut_at = F.struct(_score(F.col("a"), F.col("l"), F.col("r")).alias("score"), "k", "l", "r")
    return both.groupBy("lang", "phrase").agg(F.max("a").alias("a"), F.min(cut_at).alias("best"))


def _longer(candidates: DataFrame) -> DataFrame:
    """(lang, phrase, longer): the count of the most frequent longer candidate that holds a phrase."""
    spans = [(size, start, length) for size in range(3, LONGEST + 1) for length in range(2, size) for start in range(1, size - length + 2)]
    inside = F.array(
        *[F.when(F.col("size") == size, F.concat_ws(" ", F.slice("words", start, length))) for size, start, length in spans]
    )
    within = candidates.filter("size > 2").select("lang", "f", F.explode(F.array_compact(inside)).alias("phrase"))
    return within.groupBy("lang", "phrase").agg(F.max("f").alias("longer"))


def _first(scored: DataFrame, top: int) -> DataFrame:
    """Each language's first rows. Parts of a language are ranked first, so no task ranks all of it."""
    order = [F.desc("best.score"), F.desc("a"), F.asc("phrase")]
    parts = int(scored.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    part = F.pmod(F.xxhash64("phrase"), F.lit(parts))
    some = scored.withColumn("part", part).withColumn("place", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order)))
    best = some.filter(F.col("place") <= top).drop("part", "place")
    return best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= top)


def collocations_sql(least: int = 30, top: int = 2000) -> str:
    """The same rows from a separate count of each phrase length, in DuckDB."""
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({lower}, '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents WHERE text IS NOT NULL),
words AS (SELECT lang, regexp_extract_all(piece, '[^ \\t]+') AS w FROM pieces),
grams AS (
  SELECT lang, k, unnest([array_to_string(w[i:i + k - 1], ' ') FOR i IN range(1, len(w) - k + 2)]) AS phrase
  FROM words, (SELECT unnest([1, 2, 3, 4]) AS k)),
f AS (SELECT lang, k AS size, phrase, count(*)::hugeint AS f FROM grams GROUP BY ALL HAVING count(*) >= {least}),
n AS (SELECT lang, sum(len(w))::bigint AS n FROM words GROUP BY lang),
cuts AS (SELECT *, unnest(range(1, size)) AS k, string_split(phrase, ' ') AS w FROM f WHERE size > 1),
scored AS (
  SELECT c.lang, c.phrase, c.f AS a, l.f AS l, r.f AS r, c.k, (2000000 * c.f) // (l.f + r.f) AS score
  FROM cuts c JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(w[1:c.k], ' ')
  JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(w[c.k + 1:], ' ')),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
kept AS (
  SELECT * FROM best b WHERE NOT EXISTS (
    SELECT 1 FROM f g WHERE g.lang = b.lang AND g.size > len(string_split(b.phrase, ' ')) AND g.size > 2
      AND contains(' ' || g.phrase || ' ', ' ' || b.phrase || ' ') AND 100 * g.f >= 80 * b.a)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a::bigint AS a, l::bigint AS l, r::bigint AS r, n, score::bigint AS score
FROM ranked JOIN n USING (lang) WHERE rank <= {top}"""
