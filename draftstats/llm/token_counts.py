"""Token counts behind a digest cache.

A text's count depends on its normalised content and on the tokenizer's version
only. Both are digested; counts once made are kept in a table under these
digests, and only contents the table does not have are encoded, once each.
"""

import hashlib
import os
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tokenizers
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import read_if_there

_CACHE = "content_digest binary, n_tokens bigint, tokenizer string"
_ENCODED = pa.schema([("content_digest", pa.binary()), ("n_tokens", pa.int64())])
# Texts, and chunks of them, that a task gives the library at a time.
_TEXTS_AT_ONCE = 1_000
_CHUNKS_AT_ONCE = 2_000
# Chunks whose counts a task keeps at hand.
_KNOWN = 300_000
_MARK = "`"


def normalised(text: Column) -> Column:
    """Runs of white space as one blank, none at the ends. These tokenizers drop white space, so counts stay."""
    return F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"[ \t\n\r]+", " "))


def tokenizer_version(path: str) -> str:
    """Digest of a tokenizer's file and of the library that runs it."""
    with open(path, "rb") as file:
        return hashlib.sha256(file.read() + tokenizers.__version__.encode()).hexdigest()


def token_counts(
    docs: DataFrame, tokenizer_path: str, cache_path: str, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """(doc_id, n_bytes, n_tokens) of every row of `docs`, and the cache grown by what it lacked.

    For tokenizers that drop white space. `n_tokens` is the library's count of
    the whole text, without added special tokens; strings of special tokens
    inside a text count as the library takes them.

    Null texts are empty: 0 bytes, 0 tokens. A row with a null id or a repeated
    row is a row like any other. No rows give none. Other columns are ignored.
    Texts shuffle once, a copy per task at most; a frequent text is one row per
    task there, and the join back carries digests only.
    """
    version = tokenizer_version(tokenizer_path)
    text = F.col(text_column)
    digest = F.unhex(F.sha2(normalised(text), 256)).alias("content_digest")
    contents = docs.select(digest, normalised(text).alias("content")).groupBy("content_digest").agg(F.first("content"))
    cache = read_if_there(docs.sparkSession, cache_path, _CACHE).filter(F.col("tokenizer") == version)
    missing = contents.join(cache, "content_digest", "left_anti")
    encoded = missing.mapInArrow(_counter(tokenizer_path), "content_digest binary, n_tokens bigint")
    encoded.withColumn("tokenizer", F.lit(version)).write.mode("append").partitionBy("tokenizer").parquet(cache_path)

    cache = read_if_there(docs.sparkSession, cache_path, _CACHE).filter(F.col("tokenizer") == version)
    counts = cache.groupBy("content_digest").agg(F.max("n_tokens").alias("n_tokens"))
    n_bytes = F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint").alias("n_bytes")
    rows = docs.select(F.col(id_column).alias("doc_id"), n_bytes, digest)
    return rows.join(counts, "content_digest", "left").select("doc_id", "n_bytes", "n_tokens")


def _counter(tokenizer_path: str):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Cores are Spark's to share out; threads of the library would also keep memory each.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        tokenizer = tokenizers.Tokenizer.from_file(tokenizer_path)
        known: dict[bytes, int] = {}
        for batch in batches:
            for at in range(0, batch.num_rows, _TEXTS_AT_ONCE):
                part = batch.slice(at, _TEXTS_AT_ONCE)
                counts = counts_of(tokenizer, part.column(1).to_pylist(), known)
                yield pa.record_batch([part.column(0).cast(pa.binary()), pa.array(counts, pa.int64())], schema=_ENCODED)

    return count


def counts_of(tokenizer: tokenizers.Tokenizer, texts: list[str], known: dict[bytes, int]) -> list[int]:
    """Counts of texts as sums over their chunks between ASCII blanks.

    No token spans a blank in a tokenizer that drops white space, so a chunk's
    count holds wherever it stands, and the library is asked once for each.
    Many chunks go into one call, with a mark of one token between them; chunks
    that hold the mark themselves, or do once normalised
    (U+1FEF becomes a backtick), are encoded alone. `known` keeps counts from
    call to call, up to a bound.
    """
    chunked = [text.encode().split() for text in texts]
    mark = tokenizer.encode(_MARK, add_special_tokens=False).ids
    if len(known) > _KNOWN:
        known.clear()
    together, alone = [], []
    for chunk in set().union(*chunked) - known.keys():
        (alone if len(mark) != 1 or _holds_mark(chunk) else together).append(chunk)
    known.update((c, len(tokenizer.encode(c.decode(), add_special_tokens=False))) for c in alone)
    for at in range(0, len(together), _CHUNKS_AT_ONCE):
        some = together[at : at + _CHUNKS_AT_ONCE]
        joined = f" {_MARK} ".join(c.decode() for c in some)
        ids = np.array(tokenizer.encode_batch_fast([joined], add_special_tokens=False)[0].ids)
        ends = np.append(np.flatnonzero(ids == mark[0]), len(ids))
        known.update(zip(some, (np.diff(ends, prepend=-1) - 1).tolist(), strict=True))
    return [sum(map(known.__getitem__, text)) for text in chunked]


def _holds_mark(chunk: bytes) -> bool:
    """Whether the mark is in a chunk or in a normal form of it; those of NFC are among those of NFKC."""
    return _MARK.encode() in chunk or not chunk.isascii() and _MARK in unicodedata.normalize("NFKC", chunk.decode())
