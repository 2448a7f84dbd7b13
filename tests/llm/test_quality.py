"""Quality classifier and quality rules."""

import re
import zlib
from collections import Counter

import numpy as np
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from draftstats.llm import quality_classifier, quality_rules, queries

GOOD, BAD = "A plain sentence about the weather in the north.", "CLICK!! HERE!! NOW!! $$$ &&& ###"
DOCS = "doc_id long, text string, score string, label string, label_id string"


def brute_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    symbols = sum(c in "#*$%&|<>" for c in text)
    dup_lines = sum(line in lines[:i] for i, line in enumerate(lines))
    return len(words), sum(map(len, words)), symbols, dup_lines, len(covered)


@given(st.lists(st.sampled_from(["a", "b", "é🙂", " ", "\n", "\t", "\x0b", "\xa0", "#", "|", "\r", "\x1c", "\x85"])).map("".join))
def test_base_counts(text):
    assert quality_rules.base_counts(text.encode()) == brute_counts(text)


def test_rules_tell_junk_from_prose(spark):
    rows = [(i, f"{GOOD} {i} " * 12, None, None, None) for i in range(40)]
    rows += [(100 + i, f"{BAD} {i} " * 12, None, None, None) for i in range(20)]
    rows += [(None, None, "x", "y", "z"), (7, "", None, None, None), (300, "word " * 30_000, None, None, None)]
    docs = spark.createDataFrame(rows, DOCS)
    trusted = spark.createDataFrame([(i,) for i in [*range(20), None, 3, 3]], "doc_id long")
    found = quality_rules.apply_rules(docs, quality_rules.log_ratios(docs, trusted), max_repeat_percent=100).collect()
    assert len(found) == len(rows)
    assert all(r.kept == (r.doc_id < 100) for r in found if r.doc_id is not None and 60 < r.n_words < 1000)
    assert [r.kept for r in found if r.doc_id is None] == [False]


def test_rules_without_trusted_texts_or_rows(spark):
    docs = spark.createDataFrame([(1, GOOD * 20)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long")
    ratios = quality_rules.log_ratios(docs, none)
    assert [r.log_ratio for r in quality_rules.apply_rules(docs, ratios).collect()] == [0.0]
    empty = docs.filter("doc_id < 0")
    assert quality_rules.apply_rules(empty, quality_rules.log_ratios(empty, none)).collect() == []


def test_every_trusted_text_is_counted(spark):
    texts = [f"{i * 7919 % 100_003:05d} prose" for i in range(9_000)] + ["z" * 70_000, "raw only", None]
    trusted_ids = [*range(9_001), None, 3, 99_999]
    docs = spark.createDataFrame([*enumerate(texts), (None, "no id")], "doc_id long, text string")
    trusted = spark.createDataFrame([(i,) for i in trusted_ids], "doc_id long")
    raw, good = np.ones(1 << 16), np.ones(1 << 16)
    for i, text in [*enumerate(texts), (None, "no id")]:
        grams = quality_rules.buckets(np.frombuffer((text or "").encode(), np.uint8))
        np.add.at(raw, grams, 1)
        np.add.at(good, grams, int(i is not None and i in trusted_ids))
    expected = np.log(good / good.sum()) - np.log(raw / raw.sum())
    assert np.array_equal(quality_rules.log_ratios(docs, trusted), expected)


def test_rules_query(spark):
    folder = "/root/testdata/sf0.01"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    found = queries.op5_quality_rules(spark, folder).collect()
    assert len(found) == len(docs)
    for r in found:
        counts = brute_counts(docs[r.doc_id])
        assert tuple(r)[1:6] == counts
        assert r.base_failed == (counts[0] < 50 or 100 * counts[4] > 50 * counts[0])
        assert not (r.kept and r.base_failed)
    passed = [(labels[r.doc_id], r.kept) for r in found if r.doc_id in labels and not r.base_failed]
    assert sum(bool(a) == b for a, b in passed) / len(passed) > 0.98


def test_classifier_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    found = queries.op7_quality_classifier(spark, folder).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in found)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in found)
    judged = [(labels[r.doc_id], r.predicted) for r in found if r.held_out and r.doc_id in labels]
    assert sum(a == b for a, b in judged) / len(judged) > 0.99


def test_classifier_edge_cases(spark):
    rows = [(i, GOOD if i % 2 else BAD, "s", "l", "i") for i in range(60)]
    rows += [(None, None, "s", "l", "i"), (200, "", "s", "l", "i"), (201, "y" * 200_000, "s", "l", "i"), (1, GOOD, "s", "l", "i")]
    docs = spark.createDataFrame(rows, DOCS)
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] + [(None, 1), (5, None), (5, 1), (999, 0)], "doc_id long, quality int")
    model = quality_classifier.fit(docs, labels)
    scores = [(r.doc_id, r.score) for r in quality_classifier.score(docs, model).collect()]
    assert len(scores) == len(rows)
    assert all((s > 0.5) == bool(i % 2) for i, s in scores if i is not None and i < 60)
    assert quality_classifier.keep_good(docs, model).columns == docs.columns
    empty = docs.filter("doc_id < 0")
    assert quality_classifier.score(empty, model).collect() == []


def test_classifier_of_one_class_gives_the_share(spark):
    docs = spark.createDataFrame([(1, GOOD), (2, BAD)], "doc_id long, text string")
    one = spark.createDataFrame([(1, 1), (2, 1)], "doc_id long, quality int")
    assert {round(r.score, 6) for r in quality_classifier.score(docs, quality_classifier.fit(docs, one)).collect()} == {0.75}
    none = quality_classifier.fit(docs, one.filter("false"))
    assert {r.score for r in quality_classifier.score(docs, none).collect()} == {0.5}


def test_the_fit_does_not_depend_on_the_order_of_rows_that_repeat_ids(spark):
    rows = [(i % 2, f"text {i} {'good words' if i % 2 else 'bad #### $$$$'} " * (1 + i % 5)) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(0, 0), (1, 1)], "doc_id long, quality int")
    models = [quality_classifier.fit(d, labels, max_rows=2) for d in (docs, docs.repartition(5), docs.orderBy(F.desc("text")))]
    scores = [[r.score for r in quality_classifier.score(docs.orderBy("doc_id", "text"), m).collect()] for m in models]
    assert scores[0] == scores[1] == scores[2]
