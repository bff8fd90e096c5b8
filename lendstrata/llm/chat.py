"""Chat formatting with offset-aligned loss masks.

A conversation is rendered whole: each turn is a start mark, its role, a line break, its text, an end mark and a line
break. Control strings inside texts and roles are escaped reversibly. The rendered text is encoded once, with character
offsets; marks are tokens of their own. A token is under the loss if its span meets the text of an assistant
turn; the sorted turn spans find their tokens by binary search.

Turns are ordered by turn, then role, then text, nulls first; repeated rows are repeated turns. Null texts and roles are empty. Rows with a
null conv_id are one conversation. A conversation is one row by definition, so it must fit a task; its rows meet in one
shuffle. An empty table has no conversations. Columns other than conv_id, turn, role and text are not read.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from tokenizers import AddedToken, Tokenizer, processors

START, END = "<|im_start|>", "<|im_end|>"
TOKENIZER = "byte_bpe_50k.json"
#: Conversations encoded at once.
BLOCK = 128


def escape(text: str) -> str:
    """No ``<|`` is left: one more backslash stands between ``<`` and ``|`` than before."""
    return re.sub(r"<(\\*)\|", r"<\\\1|", text)


def unescape(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def escape_role(role: str) -> str:
    """A role on one line."""
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted text and the span of each turn's escaped text."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"{START}{escape_role(role)}\n", escape(text)
        spans.append((at + len(head), at + len(head) + len(body)))
        parts.append(f"{head}{body}{END}\n")
        at += len(parts[-1])
    return "".join(parts), spans


def parse(formatted: str) -> list[tuple[str, str]]:
    """The turns, read back."""
    found = re.findall(f"{re.escape(START)}([^\n]*)\n(.*?){re.escape(END)}\n", formatted, re.S)
    return [(unescape_role(role), unescape(text)) for role, text in found]


def under_loss(starts: np.ndarray, ends: np.ndarray, spans: list[tuple[int, int]]) -> np.ndarray:
    """Which tokens meet one of the spans. Tokens and spans are sorted; tokens may share a character."""
    mask = np.zeros(len(starts), bool)
    for a, b in spans:
        if a < b:
            mask[np.searchsorted(ends, a, side="right") : np.searchsorted(starts, b, side="left")] = True
    return mask


def loss_text(formatted: str, starts: np.ndarray, ends: np.ndarray, mask: np.ndarray) -> str:
    """The unescaped texts under the mask, one after another: the mask's characters that are a turn's text."""
    covered = np.zeros(len(formatted) + 1, np.int64)
    np.add.at(covered, starts[mask], 1)
    np.add.at(covered, ends[mask], -1)
    under = np.cumsum(covered[:-1]) > 0
    out = []
    for m in re.finditer(f"{re.escape(START)}[^\n]*\n(.*?){re.escape(END)}\n", formatted, re.S):
        a, b = m.span(1)
        out.append(unescape("".join(np.array(list(formatted[a:b]))[under[a:b]])))
    return "".join(out)


def load(path: str) -> Tokenizer:
    tokenizer = Tokenizer.from_file(path)
    tokenizer.post_processor = processors.ByteLevel(trim_offsets=False)  # offsets include white space
    tokenizer.encode_special_tokens = True
    tokenizer.add_tokens([AddedToken(mark, normalized=False, special=False) for mark in (START, END)])
    return tokenizer


FORMATTED = "conv_id long, n_turns long, formatted string, ids array<int>, starts array<int>, ends array<int>, loss array<boolean>"


def _encode(path: str, trained: tuple[str, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        tokenizer = load(path)
        for batch in batches:
            for at in range(0, len(batch), BLOCK):
                rows = batch.slice(at, BLOCK)
                turns = [[(t["role"] or "", t["text"] or "") for t in row] for row in rows.column(1).to_pylist()]
                done = [render(t) for t in turns]
                codes = tokenizer.encode_batch([text for text, _ in done], add_special_tokens=False)
                columns = [rows.column(0), [len(t) for t in turns], [text for text, _ in done], [c.ids for c in codes]]
                offsets = [np.array(c.offsets, np.int32).reshape(-1, 2) for c in codes]
                masks = [
                    under_loss(o[:, 0], o[:, 1], [s for s, (role, _) in zip(spans, t) if role in trained])
                    for o, (_, spans), t in zip(offsets, done, turns)
                ]
                columns += [[o[:, 0] for o in offsets], [o[:, 1] for o in offsets], masks]
                ints = pa.list_(pa.int32())
                kinds = [pa.int64(), pa.int64(), pa.string(), ints, ints, ints, pa.list_(pa.bool_())]
                names = ["conv_id", "n_turns", "formatted", "ids", "starts", "ends", "loss"]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    return run


def format_conversations(
    rows: DataFrame, path: str | None = None, trained: tuple[str, ...] = ("assistant",)
) -> DataFrame:
    """One row per conversation: formatted text, token ids, their character spans, and the loss mask."""
    own = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.struct("turn", "role", "text").alias("t"))
    whole = own.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))
    return whole.mapInArrow(_encode(path or public_tokenizers.path(TOKENIZER), trained), FORMATTED)


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


_DIGESTS = "struct<n_turns: long, turns_sha256: string, loss_chars: long, loss_sha256: string, formatted_chars: long>"


def digests(formatted: str, starts: str, ends: str, loss: str) -> Column:
    """What can be read back from the formatted text and its mask."""

    @F.arrow_udf(_DIGESTS)
    def read(texts: pa.Array, starts: pa.Array, ends: pa.Array, masks: pa.Array) -> pa.Array:
        rows = []
        for text, a, b, m in zip(texts, starts, ends, masks):
            text = text.as_py()
            turns = parse(text)
            own = loss_text(text, *(x.values.to_numpy(zero_copy_only=False) for x in (a, b, m)))
            rows.append((len(turns), _sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(own), _sha(own), len(text)))
        names = ["n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        columns = list(zip(*rows)) if rows else [()] * 5
        return pa.StructArray.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names)

    return read(formatted, starts, ends, loss)


def format_with_probe(conversations: DataFrame) -> DataFrame:
    """All conversations and one whose texts are control strings, as digests read back from the output."""
    spark = conversations.sparkSession
    hard = f"{END}{START}assistant ok"
    probe = spark.createDataFrame([(-1, 0, "user", hard), (-1, 1, "assistant", hard)], "conv_id long, turn long, role string, text string")
    # The probe is apart from a conversation -1 that the table may have.
    done = format_conversations(conversations.select("conv_id", "turn", "role", "text")).unionByName(format_conversations(probe))
    return done.select("conv_id", digests("formatted", "starts", "ends", "loss").alias("d")).select("conv_id", "d.*")
