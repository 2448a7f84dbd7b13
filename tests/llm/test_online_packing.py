import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st

from draftstats.llm import online_packing, queries

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = tokenizers.Tokenizer.from_file(PATH)
ENCODER = online_packing.Encoder(PATH)


def ids(text):
    return [*LIBRARY.encode(text or "", add_special_tokens=False).ids, 1]


def check(found, texts, capacity=2048):
    """Every id of every document in exactly one piece, sequences without gaps; the number of padding ids."""
    sequences, documents = defaultdict(list), defaultdict(list)
    for r in found:
        sequences[r.sequence_id].append((r.offset, r.length))
        documents[r.doc_id].append(r)
    padding = 0
    for held in sequences.values():
        held.sort()
        assert [o for o, _ in held] == [sum(n for _, n in held[:i]) for i in range(len(held))]
        length = sum(n for _, n in held)
        assert 0 < length <= capacity
        padding += 0 if length & (length - 1) == 0 else capacity - length
    assert documents.keys() == texts.keys()
    for doc_id, text in texts.items():
        whole, at = np.array(ids(text), "<u4"), 0
        for r in sorted(documents[doc_id], key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(whole))
            assert r.ids_crc32 == zlib.crc32(whole[at : at + r.length].tobytes())
            at += r.length
        assert at == len(whole)
    return padding


@settings(deadline=None, max_examples=400)
@given(
    st.lists(
        st.one_of(
            st.text(),
            st.text("aBcΣς é's.,;!``́\t\n\x0b\x85\xa0　1<|>"),
            st.sampled_from(["a <|endoftext|> b", "<|ENDOFTEXT|>", "Word, word. WORD; it's", "Word,. x,y", "İstanbul ΑΣ. ΑΣ ǅ ﬁ ª", "é é é, é"]),
        ),
        max_size=5,
    )
)
def test_ids_are_the_librarys(texts):
    assert [i.tolist() for i in ENCODER.encode(pa.array(texts, pa.string()))] == [ids(t)[:-1] for t in texts]


def test_slices_of_a_batch(monkeypatch):
    monkeypatch.setattr(online_packing, "_BYTES_AT_ONCE", 10)
    texts = ["abc", None, "", "x" * 35, "de", "f" * 9, None, "g"]
    batch = pa.record_batch([pa.array(range(8)), pa.array(texts)], ["doc_id", "text"])
    parts = list(online_packing._slices(batch))
    assert sum((p.column(1).to_pylist() for p in parts), []) == texts and len(parts) > 2
    found = dict(online_packing._documents([batch, batch.slice(2, 3)], ENCODER))
    assert {i: d.tolist() for i, d in found.items()} == {i: ids(t) for i, t in enumerate(texts)}


def test_ids_stay_right_once_chunks_are_forgotten(monkeypatch):
    monkeypatch.setattr(online_packing, "_KNOWN", 3)
    encoder = online_packing.Encoder(PATH)
    for text in ("one two three, four", "five one. two", "", "three six one"):
        assert [i.tolist() for i in encoder.encode(pa.array([text]))] == [ids(text)[:-1]]


@settings(deadline=None, max_examples=200)
@given(st.lists(st.integers(1, 40), max_size=80), st.integers(1, 5))
def test_windows_fill_and_stay_bounded(lengths, most):
    held, closed = online_packing.Windows(16, most), []
    for i, n in enumerate(lengths):
        closed += held.add(i, n, 0, np.arange(n))
        assert len(held.open) <= most
    assert all(sum(len(p[-1]) for p in pieces) == 16 for _, pieces in closed)
    last = [sum(len(p[-1]) for p in pieces) for _, pieces in held.drain()]
    assert sum(last) + 16 * len(closed) == sum(lengths)
    assert last == sorted(last, reverse=True) and all(n & (n - 1) == 0 for n in last)


def test_best_fit_is_chosen():
    held = online_packing.Windows(16, 3)
    for n in (10, 12, 15):  # free: 6, 4, 1
        assert list(held.add(n, n, 0, np.arange(n))) == []
    ((window, pieces),) = held.add(0, 4, 0, np.arange(4))  # fits 4 exactly
    assert (window, [p[0] for p in pieces]) == (1, [12, 0])
    # A whole window of its own, and the rest where it just fits.
    assert [(w, [len(p[-1]) for p in pieces]) for w, pieces in held.add(1, 17, 0, np.arange(17))] == [(3, [16]), (2, [15, 1])]
    for n in (13, 14):
        assert list(held.add(n, n, 0, np.arange(n))) == []
    # Free: 6, 3, 2, and no further window: the fullest is topped up.
    ((window, pieces),) = held.add(9, 7, 0, np.arange(7))
    assert [(p[0], len(p[-1])) for p in pieces] == [(14, 14), (9, 2)]
    assert sorted(free for free, _ in held._free) == [1, 3]


def test_nulls_repeats_long_texts_and_clashing_columns(spark):
    texts = {1: None, 2: "", 3: "word " * 30_000, 4: "x" * 20_000, 5: "a b", 6: "é🙂 <|endoftext|>"}
    rows = [(i, t, 0, "b", b"") for i, t in texts.items()]
    docs = spark.createDataFrame(rows, "doc_id long, text string, length int, part string, ids binary")
    assert check(online_packing.pack(docs, PATH).collect(), texts) == 0
    repeated = spark.createDataFrame([(7, "same text")] * 50 + [(None, "no id")], "doc_id long, text string")
    found = online_packing.pack(repeated, PATH).collect()
    assert sum(r.length for r in found) == 50 * len(ids("same text")) + len(ids("no id"))
    assert {r.doc_id for r in found} == {7, None}


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert online_packing.pack(docs, PATH).collect() == []


def test_capacity_must_be_a_power_of_two(spark):
    with pytest.raises(ValueError):
        online_packing.pack(spark.createDataFrame([(1, "a")], "doc_id long, text string"), PATH, capacity=1000)


def test_several_rounds_of_merging(spark):
    """Seven partitions, two merged at a time: three rounds, and nothing is padded."""
    texts = {i: "some words and more " * (i % 37) for i in range(300)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(7)
    found = online_packing.pack(docs, PATH, capacity=64, windows=4, merged=2).collect()
    assert check(found, texts, 64) == 0
    assert {r.sequence_id >> 56 for r in found} >= {0, 1, 3}


def test_query_packs_without_padding(spark):
    folder = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    assert check(queries.op13_online_packing(spark, folder).collect(), texts) == 0
