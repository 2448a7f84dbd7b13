import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from draftstats.llm import collocations, queries

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def pieces(text):
    return [re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER))]


def brute_force(docs, least, top):
    f, n = defaultdict(Counter), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        for words in pieces(text):
            n[lang] += len(words)
            for k in range(1, 5):
                f[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    rows = []
    for lang, counts in f.items():
        candidates = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        scored = []
        for p, a in candidates.items():
            longer = [b for q, b in candidates.items() if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))]
            if any(100 * b >= 80 * a for b in longer):
                continue
            score, _, l, r = min((2000000 * a // (counts[p[:k]] + counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p)))
            scored.append((-score, -a, " ".join(p).encode(), l, r))
        rows += [(lang, i, p.decode(), -a, l, r, n[lang], -s) for i, (s, a, p, l, r) in enumerate(sorted(scored)[:top], 1)]
    return sorted(rows)


def found(df, **options):
    return sorted(tuple(r) for r in collocations.collocations(df, **options).collect())


@settings(deadline=None, max_examples=200)
@given(st.one_of(st.text(), st.text("aB .,\t\n\x0b\x0c\x85\xa0é")))
def test_pieces_and_words(text):
    words = collocations._Codes()
    codes = np.concatenate(list(collocations._coded(text, words))).tolist()
    names = list(words)
    split, held = [[]], split_words(text)
    for code in codes:
        if code:
            split[-1].append(names[code].decode())
        else:
            split.append([])
    assert [s for s in split if s] == held


def split_words(text):
    return [words for words in pieces(text) if words]


def test_slices_of_a_long_text(monkeypatch):
    monkeypatch.setattr(collocations, "_SLICE", 5)
    text = "one two, three four five. " * 30
    words = collocations._Codes()
    sliced = np.concatenate(list(collocations._coded(text, words)))
    monkeypatch.undo()
    assert sliced.tolist() == np.concatenate(list(collocations._coded(text, words))).tolist()


@pytest.mark.parametrize("least", [1, 2, 5])
def test_brute_force(spark, least):
    rng = np.random.default_rng(least)
    words = ["the", "of", "New", "york", "city", "é", "a-b", "x"]
    docs = [("en" if i % 3 else "fr", " ".join(rng.choice(words, 12)) + rng.choice([".", "\n", ""]) + " new york city hall") for i in range(60)]
    docs += [(None, "no language of its own. no language"), ("en", None), ("en", ""), ("en", " \t.,\n"), (None, None)]
    docs += [("de", "sehr lang " * 3_000)] + [("en", "copied text is copied")] * 7
    df = spark.createDataFrame([(i, t, lang, 0, "x") for i, (lang, t) in enumerate(docs)], "doc_id long, text string, lang string, n int, phrase string")
    assert found(df.repartition(3), least=least, top=2000) == brute_force(docs, least, 2000)
    assert found(df, least=least, top=3) == brute_force(docs, least, 3)


def test_documents_are_never_joined(spark):
    docs = [("en", "one two")] * 5 + [("en", "three four")] * 5
    df = spark.createDataFrame(docs, "lang string, text string").coalesce(1)
    assert {r[2] for r in found(df, least=1, top=10)} == {"one two", "three four"}


def test_small_chunks_and_few_bits_change_nothing(spark, monkeypatch):
    """Prefixes that share a hash pass the bits together; the exact counts tell them apart."""
    rng = np.random.default_rng(1)
    docs = [("en", " ".join(f"w{x}" for x in rng.zipf(1.5, 60) % 50)) for _ in range(40)]
    df = spark.createDataFrame(docs, "lang string, text string")
    monkeypatch.setattr(collocations, "_WORDS_AT_ONCE", 300)
    monkeypatch.setattr(collocations, "_BITS", 16)
    assert found(df, least=4, top=100) == brute_force(docs, 4, 100)


def test_empty_table(spark):
    assert found(spark.createDataFrame([], "doc_id long, text string, lang string"), least=1, top=5) == []
    assert found(spark.createDataFrame([("en", None)], "lang string, text string"), least=1, top=5) == []


def test_scores_beyond_64_bits(spark):
    rows = [("en", "a b", ["a", "b"], 2, 6 * 10**18), ("en", "a", ["a"], 1, 6 * 10**18), ("en", "b", ["b"], 1, 9 * 10**18)]
    df = spark.createDataFrame(rows, "lang string, phrase string, words array<string>, size int, f long")
    (row,) = collocations._scored(df.filter("size > 1"), df.select("lang", "phrase", "f")).collect()
    assert row.best.score == 2_000_000 * 6 * 10**18 // (15 * 10**18)


def test_query_against_sql(spark):
    folder = "/root/testdata/sf0.01"
    rows = sorted(tuple(r) for r in queries.op12_collocations(spark, folder).collect())
    with duckdb.connect() as db:
        db.execute(f"create view documents as select * from '{folder}/documents.parquet'")
        assert rows == sorted(db.sql(collocations.collocations_sql()).fetchall())
    assert rows


def test_nothing_but_frequent_phrases_is_counted(spark):
    """Of texts that share a phrase only its windows are left to count; other words are only added up."""
    docs = [("en", f"a{i} b{i} c{i} shared phrase of words d{i} e{i}") for i in range(50)]
    df = spark.createDataFrame(docs, "lang string, text string")
    found = collocations.phrases(df, 30)
    assert {r.phrase for r in found.collect()} == {
        "", "shared", "phrase", "of", "words", "shared phrase", "phrase of", "of words", "shared phrase of", "phrase of words", "shared phrase of words"
    }
    assert found.filter("size = 0").first().f == 450
