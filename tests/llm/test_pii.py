import hashlib
import re

import pytest
from pyspark.sql import functions as F

from draftstats.llm import pii, queries

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
SCHEMA = "doc_id long, text string, base string, terms string, kind string"


def luhn(digits):
    doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def valid(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(part) <= 255 for part in value.split("."))
    if kind == "card":
        return 14 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 10 <= len(digits) <= 15


def brute(text):
    kinds = zip(pii.KINDS[:4], (EMAIL, IP, CARD, PHONE), strict=True)
    found = [
        (m.start(), n, m.end(), kind)
        for n, (kind, pattern) in enumerate(kinds)
        for m in pattern.finditer(text or "")
        if valid(kind, m[0])
    ]
    return ",".join(f"{kind}:{start}:{end}" for start, _, end, kind in sorted(found))


TEXTS = [
    None,
    "",
    "a@b.c_d@e.f x.y@z.w.v. @no.no a@b c@d..e é🙂 q@r.s%t@u.v",
    "1.2.3.4.5.6.7.8 256.1.1.1 0255.001.1.1 1.2.3 999.9.9.9.9.9.9.9 00000000000000000000000001.2.3.4",
    "4111 1111 1111 1111 4111-1111-1111-1111 4111111111111112 1 2 3 4 5 6 7 8 9 0 1 2 3 4  49927398716 4111  1111 1111 1111",
    "0000000000000000000000000000 00000000000000 000000000000000000000",
    "+1 (743) 555-3824 +49 30 1234567890123456 +1.(2).3-4 5 6 7 8 9 0) ++12345678901+12345678901 +1 ((((",
    "both 1.2.3.4111111111111111 and me+15551234567@x.org 4111111111111111@y.org",
    "a" * 60_000 + "@" + "b." * 30_000 + "c",
    "1" * 50_000 + " " + "2 " * 30_000 + "1." * 20_000,
    "+1" + "(" * 50_000 + " " + "+1" * 20_000,
]


def test_base_spans_against_brute_force(spark):
    docs = spark.createDataFrame([(i, t, "x", "y", "z") for i, t in enumerate(TEXTS)], SCHEMA)
    found = {r.doc_id: r.spans for r in pii.all_spans(docs).select("doc_id", pii.listed(F.col("base")).alias("spans")).collect()}
    for i, text in enumerate(TEXTS):
        assert found[i] == brute(text), i


def test_a_term_seen_only_near_an_entity_discloses_it(spark):
    filler = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu".split()
    words = lambda i, n: " ".join(filler[(i * 7 + k * 5) % 12] + "abcdefghijkl"[(i + k) % 12] for k in range(n))
    rows = [(i, f"{words(i, 4)} kingpin {words(i + 3, 3)} boss@crime.org {words(i + 5, 6)}") for i in range(8)]
    rows += [(100 + i, words(i, 60)) for i in range(200)]
    # "Some email" is less information than "the boss's email" only if there are other emails.
    others = [(400 + i, f"{words(i, 5)} user{i}@mail.org {words(i + 2, 5)}") for i in range(40)]
    docs = spark.createDataFrame(rows + others, "doc_id long, text string")
    found = {r.doc_id: r.spans for r in pii.all_spans(docs).select("doc_id", pii.listed(F.col("spans")).alias("spans")).collect()}
    for doc_id, text in rows[:8]:
        at = text.index("kingpin")
        assert f"term:{at}:{at + 7}" in found[doc_id].split(",")
        assert brute(text) in found[doc_id]
    assert all(found[doc_id] == "" for doc_id, _ in rows[8:])
    clean = {r.doc_id: r.text for r in pii.sanitised(docs).collect()}
    assert all("kingpin" not in clean[i] and "[EMAIL]" in clean[i] and "boss@" not in clean[i] for i in range(8))
    assert all(clean[i] == text for i, text in rows[8:])


def test_copies_disclose_nothing(spark):
    text = "the unusual wording of this singular passage mentions boss@crime.org and nothing besides that at all"
    docs = spark.createDataFrame([(i, text + " x" * i) for i in range(30)], "doc_id long, text string")
    assert {r.spans for r in pii.all_spans(docs).select(pii.listed(F.col("spans")).alias("spans")).collect()} == {brute(text)}


@pytest.mark.parametrize(
    "at_start, beside, at_end",
    [
        ("", "email boss@crime.org or", ""),
        ("", "phone +15551234567", ""),
        ("", "Vito Kingpin <boss@crime.org>", ""),
        ("from Vito Kingpin boss@crime.org", "", ""),
        ("", "", "best regards Vito Kingpin boss@crime.org"),
    ],
)
def test_words_that_always_stand_beside_an_entity_are_no_copies(spark, at_start, beside, at_end):
    filler = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu".split()
    words = lambda i, n: " ".join(filler[(i * 7 + k * 5) % 12] + "abcdefghijkl"[(i + k) % 12] for k in range(n))
    rows = [(i, " ".join(filter(None, [at_start, words(i, 9), "Secretum", beside, words(i + 5, 9), at_end]))) for i in range(8)]
    rows += [(100 + i, words(i, 60)) for i in range(200)]
    rows += [(400 + i, f"{words(i, 5)} user{i}@mail.org {words(i + 2, 5)} +1444{i + 1000000}") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r.spans for r in pii.all_spans(docs).select("doc_id", pii.listed(F.col("spans")).alias("spans")).collect()}
    telling = ["Vito", "Kingpin"] if "Vito" in at_start + beside + at_end else ["Secretum"]
    for doc_id, text in rows[:8]:
        spans = found[doc_id].split(",")
        assert all(f"term:{text.index(t)}:{text.index(t) + len(t)}" in spans for t in telling), spans


def test_a_passage_copied_into_other_texts_discloses_nothing(spark):
    filler = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu".split()
    passage = "the unusual wording of this very singular and old passage that mentions boss@crime.org and nothing besides that"
    docs = spark.createDataFrame([(i, f"{passage} {filler[i]} {filler[i - 5]} {filler[i - 7]}") for i in range(12)], "doc_id long, text string")
    assert {r.spans for r in pii.all_spans(docs).select(pii.listed(F.col("spans")).alias("spans")).collect()} == {brute(passage)}


def test_repeats_null_ids_clashing_columns_and_empty_table(spark):
    rows = [(1, "me@x.org", "b", "t", "k")] * 3 + [(None, "1.1.1.1", "b", "t", "k"), (None, None, None, None, None)]
    docs = spark.createDataFrame(rows, SCHEMA)
    assert pii.all_spans(docs).count() == 5
    clean = pii.sanitised(docs)
    assert clean.columns == docs.columns
    assert sorted(str(r.text) for r in clean.collect()) == ["None", "[EMAIL]", "[EMAIL]", "[EMAIL]", "[IP]"]
    empty = docs.filter("false")
    assert pii.all_spans(empty).collect() == pii.sanitised(empty).collect() == []


@pytest.mark.parametrize("sf", ["sf0.01"])
def test_query(spark, sf):
    folder = f"/root/testdata/{sf}"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    df = queries.op10_pii(spark, folder)
    assert not re.search("Python|Pandas|Arrow|Cartesian", df._jdf.queryExecution().toString())
    found = df.collect()
    assert len(found) == len(texts)
    for r in found:
        base = brute(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(base.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [base.count(f"{k}:") for k in pii.KINDS[:4]]
        assert set(filter(None, base.split(","))) <= set(r.spans.split(","))
