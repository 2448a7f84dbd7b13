import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st

from draftstats.llm import packing, queries

PATH, RANKS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")
LIBRARY = tokenizers.Tokenizer.from_file(PATH)
ENCODER = packing.Encoder(PATH, RANKS)


def ids(text):
    return [*LIBRARY.encode(text or "", add_special_tokens=False).ids, 0]


def check(found, texts):
    """Every document whole and in order, every sequence without gaps and within its capacity."""
    sequences, documents = defaultdict(list), defaultdict(list)
    for r in found:
        sequences[r.sequence_id].append((r.offset, r.length))
        documents[r.doc_id].append(r)
    for held in sequences.values():
        held.sort()
        assert [o for o, _ in held] == [sum(n for _, n in held[:i]) for i in range(len(held))]
        assert sum(n for _, n in held) <= 2048
    assert documents.keys() == texts.keys()
    for doc_id, text in texts.items():
        whole, at = np.array(ids(text), "<u4"), 0
        for i, r in enumerate(sorted(documents[doc_id], key=lambda r: r.piece)):
            assert (r.piece, r.start) == (i, at)
            assert r.ids_crc32 == zlib.crc32(whole[at : at + r.length].tobytes())
            assert r.length == 2048 or i == 0
            at += r.length
        assert at == len(whole)
    return len(sequences)


@settings(deadline=None, max_examples=300)
@given(st.one_of(st.text(), st.text("aé 's\t\n\r\xa0ɏÀ×19.<|endoftext|>"), st.just("a <|endoftext|> b")))
def test_ids_are_the_librarys(text):
    assert [*ENCODER.ids(text), 0] == ids(text)


def test_plain_characters_are_classed_alike():
    plain = "".join(c for c in map(chr, range(0x250)) if packing._PLAIN.fullmatch(c))
    for text in [f"a{c}b 1{c}2{c}{c} .{c}. {c}a {c}1  {c}" for c in plain]:
        assert list(ENCODER.ids(text)) == LIBRARY.encode(text, add_special_tokens=False).ids


@settings(deadline=None, max_examples=100)
@given(st.lists(st.integers(1, 100), max_size=60))
def test_search_keeps_items_within_capacity(lengths):
    lengths = np.sort(np.array(lengths, np.int64))[::-1]
    bins, offsets = packing.packed(lengths, 100)
    held = np.bincount(bins, lengths) if len(lengths) else np.zeros(0)
    assert (held <= 100).all() and len(held) <= len(set(packing._best_fit(lengths.tolist(), 100).tolist()))
    assert all(offsets[i] == lengths[np.flatnonzero(bins == bins[i])][: list(np.flatnonzero(bins == bins[i])).index(i)].sum() for i in range(len(lengths)))


def test_search_empties_bins():
    """From one item per bin, moves and exchanges alone come close to the least number of bins."""
    lengths = np.sort(np.random.default_rng(3).integers(1, 90, 400))[::-1]
    bins = np.arange(len(lengths))
    packing._local_search(lengths, bins, 100)
    fill = np.bincount(bins, lengths)
    assert fill.max() <= 100
    assert np.count_nonzero(fill) <= 1.05 * -(-lengths.sum() // 100) + 1


def test_nulls_repeats_long_texts_and_clashing_columns(spark):
    texts = {1: None, 2: "", 3: "word " * 30_000, 4: "x" * 20_000, 5: "a b", 6: "é🙂 <|endoftext|>"}
    docs = spark.createDataFrame([(i, t, 0, "b") for i, t in texts.items()], "doc_id long, text string, length int, piece string")
    check(packing.pack(packing.pieces(docs, PATH, RANKS)).collect(), texts)
    repeated = spark.createDataFrame([(7, "same text")] * 50 + [(None, "no id")], "doc_id long, text string")
    found = packing.pack(packing.pieces(repeated, PATH), group=10).collect()
    assert len(found) == 51
    assert len({(r.sequence_id, r.offset) for r in found}) == 51


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert packing.pack(packing.pieces(docs, PATH, RANKS)).collect() == []


def test_query_packs_tightly(spark):
    folder = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    found = queries.op4_best_fit_packing(spark, folder).collect()
    n = check(found, texts)
    assert n <= -(-sum(r.length for r in found) // 2048) + 2
