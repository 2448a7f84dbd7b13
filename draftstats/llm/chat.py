"""Conversations in a chat template, with a loss mask aligned by offsets.

A turn is `<s>[INST]role[/INST]text</s>`. The five marks are special tokens of
the tokenizer, so token borders fall on them. Inside roles and texts a backslash is doubled,
and a mark gets one after its first character, so nothing a user writes is a mark
and every text can be read back.
"""

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tokenizers
from pyspark.sql import DataFrame

from .common import batches_of

MARKS = ("<s>", "</s>", "[INST]", "[/INST]", "<|endoftext|>")
ROLE_WITH_LOSS = "assistant"

_TO_ESCAPE = re.compile("|".join(map(re.escape, ("\\", *MARKS))))
_ESCAPED = re.compile(r"\\(.)", re.S)
_TURN = re.compile(r"<s>\[INST\](.*?)\[/INST\](.*?)</s>", re.S)
# A conversation longer than this is encoded in pieces that end with a turn.
# A mark separates turns for the tokenizer as well, so the ids are the same.
_PIECE_CHARS = 1_000_000
_PIECES_AT_ONCE = 64

_FORMATTED = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("piece", pa.int32()),
        ("formatted", pa.string()),
        ("token_ids", pa.list_(pa.int32())),
        ("token_starts", pa.list_(pa.int32())),
        ("token_ends", pa.list_(pa.int32())),
        ("loss_mask", pa.list_(pa.bool_())),
    ]
)
_FORMATTED_DDL = (
    "conv_id bigint, piece int, formatted string, token_ids array<int>, token_starts array<int>, "
    "token_ends array<int>, loss_mask array<boolean>"
)
_READ_BACK = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("n_turns", pa.int64()),
        ("turns_sha256", pa.string()),
        ("loss_chars", pa.int64()),
        ("loss_sha256", pa.string()),
        ("formatted_chars", pa.int64()),
    ]
)
_READ_BACK_DDL = (
    "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, "
    "formatted_chars bigint"
)


def escape(text: str) -> str:
    return _TO_ESCAPE.sub(lambda m: "\\\\" if m[0] == "\\" else m[0][0] + "\\" + m[0][1:], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def load_tokenizer(path: str) -> tokenizers.Tokenizer:
    tokenizer = tokenizers.Tokenizer.from_file(path)
    tokenizer.add_special_tokens([tokenizers.AddedToken(m, normalized=False, special=True) for m in MARKS])
    # Offsets that leave out a word's blank would lose it when text is read back.
    tokenizer.post_processor = tokenizers.processors.ByteLevel(trim_offsets=False)
    return tokenizer


def format_conversations(turns: DataFrame, tokenizer_path: str) -> DataFrame:
    """Rendered conversations with token ids, character offsets and loss mask, of rows (conv_id, turn, role, text).

    One row per conversation; a conversation of over a million characters has
    several, which `piece` numbers. They lie one after the other in their
    partition. The mask covers the tokens of assistant texts.

    Turns are taken in order of (turn, role, text), nulls first, so ties and
    repeated rows have a fixed order. Null roles and texts are empty. Rows
    without a conversation id are one conversation. No rows give none; other
    columns are ignored. A task streams sorted rows and holds one piece at a
    time, so a conversation of any length needs bounded memory; it is read in
    order by one task, as its digest and its offsets are.
    """
    rows = turns.select("conv_id", "turn", "role", "text")
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.drop("turn").mapInArrow(_formatter(tokenizer_path), _FORMATTED_DDL)


def read_back(formatted: DataFrame) -> DataFrame:
    """Turns and text under the mask of each conversation, read from formatted text, offsets and mask alone.

    (conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars),
    to be applied to the rows of `format_conversations` as they lie.
    """
    columns = ["conv_id", "formatted", "token_starts", "token_ends", "loss_mask"]
    return formatted.select(*columns).mapInArrow(_read_back, _READ_BACK_DDL)


def turns_of(formatted: str) -> list[tuple[str, str]]:
    return [(unescape(role), unescape(text)) for role, text in _TURN.findall(formatted)]


def loss_texts(formatted: str, starts: np.ndarray, ends: np.ndarray, mask: np.ndarray) -> list[str]:
    """The text of each unbroken run of tokens under the mask."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], mask.astype(np.int8), [0]))))
    return [
        unescape(formatted[starts[first] : ends[last - 1]])
        for first, last in zip(edges[::2], edges[1::2], strict=True)
    ]


def token_mask(starts: np.ndarray, ends: np.ndarray, spans: list[tuple[int, int]]) -> np.ndarray:
    """True for tokens that overlap a span. Tokens and spans are sorted: two binary searches per span."""
    mask = np.zeros(len(starts), bool)
    if spans:
        begin, end = np.array(spans).T
        for first, last in zip(np.searchsorted(ends, begin, "right"), np.searchsorted(starts, end, "left"), strict=True):
            mask[first:last] = True
    return mask


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(conv_id, piece, formatted, spans of assistant texts)."""
    held, length, spans, current, piece = [], 0, [], None, 0
    begun = False
    for batch in batches:
        for conv, role, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if begun and (conv != current or length >= _PIECE_CHARS):
                yield current, piece, "".join(held), spans
                piece = piece + 1 if conv == current else 0
                held, length, spans = [], 0, []
            begun, current = True, conv
            head, body = f"<s>[INST]{escape(role or '')}[/INST]", escape(text or "")
            if role == ROLE_WITH_LOSS:
                spans.append((length + len(head), length + len(head) + len(body)))
            held += [head, body, "</s>"]
            length += len(head) + len(body) + len("</s>")
    if begun:
        yield current, piece, "".join(held), spans


def _formatter(tokenizer_path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = load_tokenizer(tokenizer_path)
        held, chars = [], 0
        for piece in _pieces(batches):
            held.append(piece)
            chars += len(piece[2])
            if len(held) == _PIECES_AT_ONCE or chars >= _PIECE_CHARS:
                yield _encoded(tokenizer, held)
                held, chars = [], 0
        if held:
            yield _encoded(tokenizer, held)

    return run


def _encoded(tokenizer: tokenizers.Tokenizer, pieces: list[tuple]) -> pa.RecordBatch:
    columns: list[list] = [[] for _ in _FORMATTED]
    encodings = tokenizer.encode_batch([p[2] for p in pieces], add_special_tokens=False)
    for (conv, piece, formatted, spans), encoding in zip(pieces, encodings, strict=True):
        offsets = np.array(encoding.offsets, np.int32).reshape(-1, 2)
        starts, ends = np.ascontiguousarray(offsets[:, 0]), np.ascontiguousarray(offsets[:, 1])
        values = (conv, piece, formatted, encoding.ids, starts, ends, token_mask(starts, ends, spans))
        for column, value in zip(columns, values, strict=True):
            column.append(value)
    return pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, _FORMATTED, strict=True)], schema=_FORMATTED)


class _Digests:
    def __init__(self, conv: int | None):
        self.conv, self.turns, self.loss_chars, self.chars = conv, 0, 0, 0
        self.turn_hash, self.loss_hash = hashlib.sha256(), hashlib.sha256()

    def add(self, formatted: str, starts: np.ndarray, ends: np.ndarray, mask: np.ndarray) -> None:
        self.chars += len(formatted)
        for role, text in turns_of(formatted):
            self.turns += 1
            self.turn_hash.update(f"{role}\n{text}\n".encode())
        for text in loss_texts(formatted, starts, ends, mask):
            self.loss_chars += len(text)
            self.loss_hash.update(text.encode())

    def row(self) -> tuple:
        return self.conv, self.turns, self.turn_hash.hexdigest(), self.loss_chars, self.loss_hash.hexdigest(), self.chars


def _read_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[tuple]:
        current = None
        for batch in batches:
            convs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for i, (conv, formatted) in enumerate(zip(convs, texts, strict=True)):
                if current is None or conv != current.conv:
                    if current is not None:
                        yield current.row()
                    current = _Digests(conv)
                lists = [batch.column(c)[i].values.to_numpy(zero_copy_only=False) for c in (2, 3, 4)]
                current.add(formatted, *lists)
        if current is not None:
            yield current.row()

    return batches_of(_READ_BACK, rows())
