import math
from collections import Counter

import duckdb
import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

import regex
from draftstats.llm import lexical_search, queries

TERM = regex.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return Counter(TERM.findall((text or "").translate(LOWER)))


def brute_force(docs, items, k=10):
    counted = [(doc_id, terms(text)) for doc_id, text in docs]
    n_docs = sum(1 for _, c in counted if c)
    n_words = sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    wanted = {}
    for item_id, text in items:
        wanted.setdefault(item_id, set()).update(terms(text))
    rows = []
    for item_id, ts in wanted.items():
        scored = []
        for doc_id, c in counted:
            m = 10 + (90 * sum(c.values()) * n_docs) // n_words if c else 0
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in ts if t in c
            )
            if score > 0:
                scored.append((-score, doc_id is None, doc_id))
        rows += [(item_id, i, d, -s) for i, (s, _, d) in enumerate(sorted(scored, key=lambda x: (x[0], x[1], x[2] or 0))[:k], 1)]
    return rows


def order(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))


@settings(deadline=None, max_examples=300)
@given(st.one_of(st.text(), st.text("aBé-_.9\t\n İ　\x85")))
def test_terms(text):
    assert lexical_search.counted_terms(text) == Counter({t.encode(): n for t, n in terms(text).items()})


def test_terms_of_a_very_long_text(monkeypatch):
    monkeypatch.setattr(lexical_search, "_SLICE", 7)
    text = "one two-three FOUR five " * 50
    assert lexical_search.counted_terms(text) == Counter({t.encode(): n for t, n in terms(text).items()})


@settings(deadline=None, max_examples=200)
@given(st.dictionaries(st.binary(min_size=1, max_size=4), st.integers(1, 400), min_size=1, max_size=60))
def test_sketch_never_understates(counts):
    held = lexical_search.sketch(counts, np.array(list(counts.values()), np.int64))
    at = lexical_search._hashes(list(counts)) >> np.uint32(32 - (len(held).bit_length() - 1))
    low = held[at].min(axis=0)
    assert all(low[i] >= min(n, 255) for i, n in enumerate(counts.values()))


def test_bounds_are_above_scores_and_close(spark):
    folder = "/root/testdata/sf0.01"
    docs = [(r.doc_id, lexical_search.counted_terms(r.text)) for r in spark.read.parquet(f"{folder}/documents.parquet").limit(200).collect()]
    batch = lexical_search.Batch.of({i: set(list(c)[:40]) for i, c in docs[:30] if c})
    batch.weigh(np.full(len(batch.terms), 7), 200, sum(sum(c.values()) for _, c in docs))
    bounds, exact = lexical_search._Bounds(batch), lexical_search._Exact(batch)
    over = []
    for _, c in docs:
        if c:
            n = np.array(list(c.values()))
            bound = bounds(lexical_search.sketch(c, n).tobytes(), int(n.sum()))
            score = exact(b" ".join(c), n.astype("<u4").tobytes(), int(n.sum()))
            assert (bound >= score).all()
            over.append((bound - score).sum() / max(1, score.sum()))
    assert np.median(over) < 0.5


def test_brute_force_with_ties_repeats_nulls_and_clashing_columns(spark):
    same = "alpha beta gamma"
    docs = [(i, same, 1, "x") for i in range(40, 0, -1)] + [(7, same, 1, "x")] * 3
    docs += [(None, same, 2, "y"), (50, None, 2, "y"), (51, "", 2, "y"), (52, "--- ...", 2, "y"), (None, None, 0, "")]
    docs += [(60 + i, "alpha " * i + "delta zeta " * (i % 5), 0, "é") for i in range(30)]
    docs += [(99, "long alpha " * 50_000, 0, "")]
    items = [(1, "Alpha beta"), (2, None), (3, ""), (4, "nothing of it"), (5, "delta delta, ALPHA!"), (5, "beta"), (None, "zeta")]
    df = spark.createDataFrame(docs, "doc_id long, text string, score int, terms string").repartition(3)
    wanted = spark.createDataFrame([(i, t, 0, 0) for i, t in items], "item_id long, text string, rank int, doc_id int")
    for k in (1, 3, 10, 100):
        found = lexical_search.search(lexical_search.index(df), wanted, k)
        assert found.columns == ["item_id", "rank", "doc_id", "score"]
        assert order(map(tuple, found.collect())) == order(brute_force([d[:2] for d in docs], items, k))


def test_several_batches_of_items(spark, monkeypatch):
    monkeypatch.setattr(lexical_search, "BATCH_BYTES", 60)
    docs = [(i, f"alpha{i % 7} beta{i % 5} gamma{i % 3} common") for i in range(200)]
    items = [(i, f"alpha{i} common beta{i} gamma{i}") for i in range(12)]
    found = lexical_search.search(
        lexical_search.index(spark.createDataFrame(docs, "doc_id long, text string")), spark.createDataFrame(items, "item_id long, text string")
    )
    assert order(map(tuple, found.collect())) == order(brute_force(docs, items))


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    no_items = spark.createDataFrame([], "item_id long, text string")
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    for d, i in ((none, items), (docs, no_items), (none, no_items)):
        assert lexical_search.search(lexical_search.index(d), i).collect() == []


def test_query_against_sql(spark):
    folder = "/root/testdata/sf0.01"
    found = order(map(tuple, queries.op11_lexical_search(spark, folder).collect()))
    with duckdb.connect() as db:
        for name in ("documents", "benchmark"):
            db.execute(f"create view {name} as select * from '{folder}/{name}.parquet'")
        assert found == order(db.sql(lexical_search.search_sql()).fetchall())
