import public_tokenizers
import pytest
import tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st

from draftstats.llm import queries
from draftstats.llm.token_counts import counts_of, token_counts

PATH = public_tokenizers.path("word_bpe_49k.json")
TOKENIZER = tokenizers.Tokenizer.from_file(PATH)
SCHEMA = "doc_id long, text string, n_tokens string, content_digest string"
ALPHABET = "aB \n\t`'s|<>é́ß中\xa0\x1c\x85 1🙂Σ\x0b\x0c​ﬁİ"


def library(text):
    return len(TOKENIZER.encode(text or "", add_special_tokens=False))


@settings(deadline=None, max_examples=200)
@given(st.lists(st.one_of(st.text(ALPHABET), st.text(), st.just("x <|endoftext|>y <|ENDOFTEXT|>")), max_size=4))
def test_counts_are_the_librarys(texts):
    known = {}
    for _ in range(2):
        assert counts_of(TOKENIZER, texts, known) == [library(t) for t in texts]


@pytest.mark.parametrize("texts", [["abc", "\u1fef", "def"], ["a\u1fefb `c \u1fef\u0301 d", "e \u1fef"], ["\u1fef` x", "`\u1fef"]])
def test_a_character_that_normalises_to_the_mark(texts):
    known = {}
    assert counts_of(TOKENIZER, texts, known) == [library(t) for t in texts]
    assert all(n == library(chunk.decode()) for chunk, n in known.items())


def test_nulls_empty_long_repeated_and_clashing_columns(spark, tmp_path):
    texts = [None, "", "  \n", "a b", "a  b ", "a\tb", "word " * 50_000, "x" * 30_000, "a b"]
    docs = spark.createDataFrame([(i // 2 or None, t, "x", "y") for i, t in enumerate(texts)], SCHEMA)
    found = token_counts(docs, PATH, str(tmp_path / "cache")).collect()
    expected = [(i // 2 or None, len((t or "").encode()), library(t)) for i, t in enumerate(texts)]
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, expected))


def test_second_call_encodes_nothing_known(spark, tmp_path):
    cache = str(tmp_path / "cache")
    docs = spark.createDataFrame([(1, "a b"), (2, "a  b")], "doc_id long, text string")
    assert {r.n_tokens for r in token_counts(docs, PATH, cache).collect()} == {2}
    assert spark.read.parquet(cache).count() == 1
    more = docs.union(spark.createDataFrame([(3, "c")], docs.schema))
    assert token_counts(more, PATH, cache).count() == 3
    assert spark.read.parquet(cache).count() == 2


def test_empty_table(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert token_counts(docs, PATH, str(tmp_path / "cache")).collect() == []


@pytest.mark.parametrize("sf", ["sf0.001"])
def test_query_against_the_library(spark, sf):
    folder = f"/root/testdata/{sf}"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    found = queries.op1_token_counts(spark, folder).collect()
    assert {(r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in found} == {
        (i, len(t.encode()), library(t), library(t) > 2048) for i, t in texts.items()
    }
