"""Chat formatting into prefix trees.

A turn becomes: turn mark, role, text mark, text, end mark.  Control strings inside roles and
texts (this template's and other common ones) are escaped by a backslash after their first
character, and ones that already have backslashes there get one more, so taking one away
restores every text.  Marks are token ids of their own; roles and texts are encoded by a
byte-level vocabulary file.

Conversations are sorted by the hashes of their turns, one after the other, which is depth-first
order of their prefix tree, and dealt to tasks in ranges of that order.  A task merges a
conversation with the one before it as far as their turns are equal and writes only the new
turns.  A pack ends when it holds ``PACK`` tokens; the next one starts with a whole
conversation.  So a first turn that a third of all conversations share, or a conversation that
stands there a million times, is spread over ranges, and memory holds one pack.

A pack is one sequence: tokens; position ids (tokens of the ancestors before); ``until``, the
end of the stretch of the sequence below the token's turn, so that a token may attend to an
earlier one exactly if that one's ``until`` lies beyond it; the loss mask (assistant texts); and
for every conversation where its last token stands.

Defined results: a null text or role is an empty one; turns go by turn number, role, text, nulls
first, and repeated rows are repeated turns; a row without a conversation id is a
conversation of its own; an empty table gives no packs; extra columns play no part.  One
conversation is one unit and must fit into a task.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotwise.llm.base import query, table

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: how the vocabulary's texts were split into words.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
MARKS = {TURN: 60001, TEXT: 60002, END: 60003}
LEARNED = "assistant"
PACK = 1 << 15
PIECE = 1 << 16  # characters encoded at a time

_CONTROL = r"(\|[A-Za-z0-9_]*\|>|/?s>|/?INST\]|</?SYS>>)"
_PLAIN = re.compile(r"([<\[])(\\*)" + _CONTROL)
_ESCAPED = re.compile(r"([<\[])\\(\\*)" + _CONTROL)


def escape(text: str) -> str:
    return _PLAIN.sub(lambda m: m[1] + m[2] + "\\" + m[3], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: m[1] + m[2] + m[3], text)


@cache
def encoding(path: str):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("vocabulary", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def encode(text: str, path: str) -> list[int]:
    out: list[int] = []
    for i in range(0, len(text), PIECE):
        out += encoding(path).encode_ordinary(text[i:i + PIECE])
    return out


def decode(tokens: list[int], path: str) -> str:
    """The formatted text of tokens, marks included."""
    names, out, plain = {v: k for k, v in MARKS.items()}, [], []
    for t in tokens:
        if t in names:
            out += [encoding(path).decode_bytes(plain), names[t].encode()]
            plain = []
        else:
            plain.append(t)
    return b"".join([*out, encoding(path).decode_bytes(plain)]).decode()


def turn_tokens(role: str, text: str, path: str) -> tuple[list[int], list[int]]:
    """Tokens of a turn and its loss mask."""
    head = [MARKS[TURN], *encode(escape(role), path), MARKS[TEXT]]
    body = encode(escape(text), path)
    return [*head, *body, MARKS[END]], [0] * len(head) + [int(role == LEARNED)] * len(body) + [0]


class Pack:
    """The prefix tree of some conversations in depth-first order, as one sequence."""

    def __init__(self, path: str):
        self.path = path
        self.tokens: list[int] = []
        self.positions: list[int] = []
        self.loss: list[int] = []
        self.until: list[int] = []
        self.ends: list[tuple[int | None, int]] = []
        self.open: list[tuple[tuple[str, str], int, int]] = []  # turn, first token, position after it

    def _close(self, depth: int):
        while len(self.open) > depth:
            _, start, _ = self.open.pop()
            self.until[start:] = [u or len(self.tokens) for u in self.until[start:]]

    def add(self, conv_id: int | None, turns: list[tuple[str, str]]):
        same = 0
        while same < min(len(self.open), len(turns)) and self.open[same][0] == turns[same]:
            same += 1
        self._close(same)
        for role, text in turns[same:]:
            tokens, loss = turn_tokens(role, text, self.path)
            position = self.open[-1][2] if self.open else 0
            self.open.append(((role, text), len(self.tokens), position + len(tokens)))
            self.tokens += tokens
            self.positions += range(position, position + len(tokens))
            self.loss += loss
            self.until += [0] * len(tokens)
        start = self.open[-1][1]
        self.ends.append((conv_id, start + self.open[-1][2] - (self.open[-2][2] if len(self.open) > 1 else 0) - 1))

    def row(self) -> tuple:
        self._close(0)
        return self.tokens, self.positions, self.until, self.loss, [{"conv_id": c, "last": e} for c, e in self.ends]


INTS = pa.list_(pa.int32())
ENDS = pa.list_(pa.struct([("conv_id", pa.int64()), ("last", pa.int32())]))
PACK_TYPES = ("tokens array<int>, positions array<int>, until array<int>, loss array<int>, conversations array<struct<conv_id: bigint, last: int>>")


def _packs(path: str, most: int):
    def batch(pack: Pack) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(pack.row(), [INTS] * 4 + [ENDS])],
                                          names=["tokens", "positions", "until", "loss", "conversations"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = Pack(path)
        for b in batches:
            for conv_id, turns in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if len(pack.tokens) >= most:
                    yield batch(pack)
                    pack = Pack(path)
                pack.add(conv_id, [(t["role"], t["text"]) for t in turns])
        if pack.ends:
            yield batch(pack)
    return run


def conversations(rows: DataFrame) -> DataFrame:
    """rows (conv_id, turn, role, text) -> conv_id, turns (role, text; in order), path (a hash per turn)."""
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    named = rows.where("conv_id IS NOT NULL").groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("t"))
    lone = rows.where("conv_id IS NULL").select("conv_id", F.array(turn).alias("t"))
    return named.unionByName(lone).select(F.col("conv_id").cast("long").alias("conv_id"), F.expr("transform(t, x -> struct(x.role, x.text))").alias("turns"),
                                          F.expr("transform(t, x -> xxhash64(x.role, x.text))").alias("path"))


def packs(rows: DataFrame, vocabulary: str = VOCABULARY, most: int = PACK) -> DataFrame:
    """rows (conv_id, turn, role, text) -> one row per pack (see above)."""
    dealt = (conversations(rows).repartitionByRange("path", "conv_id").sortWithinPartitions("path", "conv_id").select("conv_id", "turns"))
    return dealt.mapInArrow(_packs(vocabulary, most), PACK_TYPES)


def parse(formatted: str) -> list[tuple[str, str]]:
    """Turns of a formatted conversation."""
    out = []
    for part in formatted.split(TURN)[1:]:
        role, _, rest = part.partition(TEXT)
        if not rest.endswith(END) or END in rest[:-len(END)]:
            raise ValueError("not a formatted conversation")
        out.append((unescape(role), unescape(rest[:-len(END)])))
    return out


def _read(path: str):
    names = ["conv_id", "formatted", "turns", "learned"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                tokens, positions, until, loss = (np.array(row[c], dtype=np.int64) for c in ("tokens", "positions", "until", "loss"))
                out = []
                for c in row["conversations"]:
                    seen = np.flatnonzero(until[:c["last"] + 1] > c["last"])  # all that its last token may attend to
                    if not np.array_equal(positions[seen], np.arange(len(seen))):
                        raise ValueError("positions of a conversation have gaps")
                    formatted = decode(tokens[seen].tolist(), path)
                    mask = np.concatenate([[0], loss[seen], [0]])
                    edge = np.flatnonzero(np.diff(mask))
                    learned = "".join(unescape(decode(tokens[seen][a:z].tolist(), path)) for a, z in zip(edge[::2], edge[1::2]))
                    out.append((c["conv_id"], formatted, [{"role": r, "text": t} for r, t in parse(formatted)], learned))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, t) for x, t in zip(zip(*out), [pa.int64(), pa.string(), pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())])), pa.string()])],
                    names=names)
    return run


def read_back(packed: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """Packs -> conv_id, formatted, turns (role, text), learned (all text under the loss mask), from the sequences alone."""
    return packed.mapInArrow(_read(vocabulary), "conv_id long, formatted string, turns array<struct<role: string, text: string>>, learned string")


@query("op7_chat")
def op7_chat(spark, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text"))
    back = read_back(packs(rows.unionByName(probe)))
    return back.select("conv_id", F.size("turns").cast("long").alias("n_turns"),
                       F.sha2(F.expr("concat_ws('', transform(turns, t -> concat(t.role, '\\n', t.text, '\\n')))"), 256).alias("turns_sha256"),
                       F.length("learned").cast("long").alias("loss_chars"), F.sha2("learned", 256).alias("loss_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars"))
