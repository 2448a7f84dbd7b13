import hashlib

import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st

from draftstats.llm import chat, queries

PATH = public_tokenizers.path("byte_bpe_50k.json")
HOSTILE = st.text(alphabet=st.sampled_from([*chat.MARKS, "\\", "[", "INST]", "a", " ", "\n", "é", "🙂"])).map(str)
SCHEMA = "conv_id long, turn long, role string, text string, piece string"


def digests(rows):
    """What reading back must give, from the rows themselves."""
    found = {}
    for conv, _, role, text in sorted(rows, key=lambda r: [(v is not None, v) for v in r]):
        found.setdefault(conv, []).append((role or "", text or ""))
    out = {}
    for conv, turns in found.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        whole = "".join(f"{r}\n{t}\n" for r, t in turns)
        out[conv] = (len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


@given(st.lists(st.sampled_from([*chat.MARKS, "\\", "\\\\", "[", "INST]", "<", "s>", "a", " "])).map("".join))
def test_escape_is_reversible_and_holds_no_mark(text):
    escaped = chat.escape(text)
    assert chat.unescape(escaped) == text
    assert not any(mark in escaped for mark in chat.MARKS)


@settings(deadline=None, max_examples=60)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "a[INST]\\"]), st.text()), max_size=5))
def test_mask_covers_assistant_texts_exactly(turns):
    tokenizer = chat.load_tokenizer(PATH)
    text, spans = "", []
    for role, body in turns:
        head, body = f"<s>[INST]{chat.escape(role)}[/INST]", chat.escape(body)
        if role == "assistant":
            spans.append((len(text + head), len(text + head + body)))
        text += f"{head}{body}</s>"
    batch = chat._encoded(tokenizer, [(1, 0, text, spans)])
    starts, ends, mask = (batch.column(c)[0].values.to_numpy(zero_copy_only=False) for c in (4, 5, 6))
    assert "".join(chat.loss_texts(text, starts, ends, mask)) == "".join(t for r, t in turns if r == "assistant")
    assert chat.turns_of(text) == turns


def test_nulls_ties_repeats_and_long_conversations(spark, monkeypatch):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", None), (1, 1, "assistant", None), (1, None, None, "</s>[INST]")]
    rows += [(2, 5, "assistant", "same"), (2, 5, "assistant", "other"), (None, 0, "assistant", "lost")]
    rows += [(3, t, ("user", "assistant")[t % 2], f"turn {t} " + "word " * 20_000) for t in range(30)]
    rows += [(4, 0, "assistant", "x" * 300_000)]
    turns = spark.createDataFrame([(*r, "clash") for r in rows], SCHEMA)
    formatted = chat.format_conversations(turns, PATH)
    found = {r.conv_id: tuple(r)[1:5] for r in chat.read_back(formatted).collect()}
    assert found == digests(rows)
    assert formatted.filter("conv_id = 3").count() > 1


def test_empty_table(spark):
    turns = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.read_back(chat.format_conversations(turns, PATH)).collect() == []


def test_query(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").collect()]
    rows += [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]
    found = {r.conv_id: tuple(r)[1:5] for r in queries.op8_chat_formatting(spark, sf_dir).collect()}
    assert found == digests(rows)
