"""Conversations as training text: turns located by rendering ever longer prefixes of a black-box template.

A template is any function from turns to one text. Rendering the first k turns and the first k + 1, and
comparing the two, shows which characters the last turn added; where an earlier text is not the beginning of
the later one, the template rewrites history, and its spans are not to be trusted. Inside a turn's span a
second rendering, with a mark in place of the text, shows where the text itself stands: that is the loss mask.
"""

from __future__ import annotations

import hashlib
import re
import sys
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airgauge.llm.common import release, stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

Turn = tuple[str, str]  # role, text
Render = Callable[[Sequence[Turn]], str]

MARK = "\ue000\ue001"  # stands for a text in a second rendering
NEAR = 64  # turns of a window
MOST_CHARS = 4_000_000  # of output texts in one batch


# --- the template that the query uses -------------------------------------------------------------

# The strings that mark turns in the output.
CONTROL = ("<s>", "</s>", "[INST]", "[/INST]", "[ROLE]", "[/ROLE]")
_HELD = re.compile(r"(</?|\[/?)(\\*)(s>|INST\]|ROLE\])")
_LOOSE = re.compile(r"(</?|\[/?)\\(\\*)(s>|INST\]|ROLE\])")


def escape(text: str) -> str:
    """The text without control strings: each gets a backslash after its bracket, or one more if it has some."""
    return _HELD.sub(r"\1\\\2\3", text)


def unescape(text: str) -> str:
    return _LOOSE.sub(r"\1\2\3", text)


def instruct(turns: Sequence[Turn]) -> str:
    """`<s>`, then `[INST] user [/INST]`, ` assistant</s>`, and any other role as `[ROLE]name[/ROLE] text</s>`."""
    out = ["<s>"]
    for role, text in turns:
        text = escape(text)
        if role == "user":
            out.append(f"[INST] {text} [/INST]")
        elif role == "assistant":
            out.append(f" {text}</s>")
        else:
            out.append(f"[ROLE]{escape(role)}[/ROLE] {text}</s>")
    return "".join(out)


def read_instruct(text: str) -> list[Turn]:
    """The turns of an `instruct` text."""
    turns, at = [], len("<s>")
    while at < len(text):
        role, close = "assistant", "</s>"
        if text.startswith("[INST] ", at):
            role, close, at = "user", " [/INST]", at + len("[INST] ")
        elif text.startswith("[ROLE]", at):
            stop = text.index("[/ROLE] ", at)
            role, at = unescape(text[at + len("[ROLE]") : stop]), stop + len("[/ROLE] ")
        else:
            at += 1
        stop = text.index(close, at)
        turns.append((role, unescape(text[at:stop])))
        at = stop + len(close)
    return turns


# --- spans of a black box ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Located:
    """A rendered conversation: per turn start and end, and where its text stands (-1: not found)."""

    text: str
    spans: list[tuple[int, int, int, int]]
    rewrites: int  # the first turn that changes what stood before it; -1: none


def _added(render: Render, turns: Sequence[Turn], before: str) -> tuple[str, int, int] | None:
    """What the last of `turns` adds to `before`, and where its text stands therein; None if it changes `before`."""
    after = render(turns)
    if not after.startswith(before):
        return None
    own = after[len(before) :]
    role, _ = turns[-1]
    marked = render([*turns[:-1], (role, MARK)])[len(before) :]
    head, found, tail = marked.partition(MARK)
    if not found or MARK in tail or len(head) + len(tail) > len(own) or not (own.startswith(head) and own.endswith(tail)):
        return own, -1, -1
    return own, len(head), len(own) - len(tail)


def locate(render: Render, turns: Sequence[Turn], near: int = NEAR) -> Located:
    """Spans of all turns in render(turns), as rendering every prefix gives them, however long the conversation is.

    Prefixes of a long conversation cost the square of its length, so each turn is first rendered behind the
    `near` to 2 * `near` - 1 turns before it (all of them, if there are no more). Where what the turns add does not
    make up the rendering of the whole, or one changes what stood before it, the template looks farther back than
    that, and every prefix is rendered after all.
    """
    whole = render(turns)
    found = _spans(render, turns, lambda k: max(0, (k // near - 1) * near))
    if isinstance(found, int) or whole != found[0]:
        found = _spans(render, turns, lambda k: 0)
    return Located(whole, [], found) if isinstance(found, int) else Located(whole, found[1], -1)


def _spans(render: Render, turns: Sequence[Turn], start: Callable[[int], int]) -> tuple[str, list[tuple[int, int, int, int]]] | int:
    """What the turns add, each behind those from its `start` on, and their spans; or the first that changes what stood before it."""
    first = render([])
    parts, spans, size = [first], [], len(first)
    since, before = 0, first
    for k in range(len(turns)):
        if start(k) != since:
            since = start(k)
            before = render(turns[since:k])
        added = _added(render, turns[since : k + 1], before)
        if added is None:
            return k
        spans.append(_placed(size, added))
        parts.append(added[0])
        size += len(added[0])
        before += added[0]
    return "".join(parts), spans


def _placed(at: int, added: tuple[str, int, int]) -> tuple[int, int, int, int]:
    own, first, stop = added
    return at, at + len(own), at + first if first >= 0 else -1, at + stop if first >= 0 else -1


# --- whole tables -----------------------------------------------------------------------------------


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, list[Turn]]]:
    """Turns of each conversation from rows in order; one conversation is held at a time."""
    key, turns = None, []
    for batch in batches:
        ids, roles, texts = (batch.column(c).to_pylist() for c in ("conv_id", "role", "text"))
        for id, role, text in zip(ids, roles, texts):
            if id != key and turns:
                yield key, turns
                turns = []
            key = id
            turns.append((role or "", text or ""))
    if turns:
        yield key, turns


FORMATTED = "conv_id bigint, formatted string, roles array<string>, spans array<struct<start:int,stop:int,text_start:int,text_stop:int>>, rewrites int"


def format_conversations(turns: DataFrame, render: Render = instruct, near: int = NEAR) -> DataFrame:
    """One row for each conversation: its text, and per turn its role, its span and that of its text.

    turns: conv_id, turn, role, text. Rows follow `turn` (NULL first), equal ones role and text; NULL role or
    text is empty; rows without conv_id belong to no conversation. Where the template rewrites history,
    `rewrites` is the first turn that does so and there are no spans: such a text has no loss mask.
    A text's span is that of what the template makes of it; -1 where what surrounds it depends on the text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, chars = [], 0
        for key, own in _conversations(batches):
            found = locate(render, own, near)
            names = ("start", "stop", "text_start", "text_stop")
            rows.append((key, found.text, [r for r, _ in own], [dict(zip(names, s)) for s in found.spans], found.rewrites))
            chars += len(found.text)
            if chars > MOST_CHARS or len(rows) > 10_000:
                yield _formatted(rows)
                rows, chars = [], 0
        yield _formatted(rows)
        release()

    named = turns.where("conv_id is not null").select(F.col("conv_id").cast("bigint").alias("conv_id"), "turn", "role", "text")
    placed = named.repartition("conv_id").sortWithinPartitions("conv_id", F.asc_nulls_first("turn"), "role", "text")
    return placed.mapInArrow(run, FORMATTED)


_SPANS = pa.list_(pa.struct([(n, pa.int32()) for n in ("start", "stop", "text_start", "text_stop")]))


def _formatted(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.string(), pa.list_(pa.string()), _SPANS, pa.int32())
    columns = list(zip(*rows)) or [()] * 5
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["conv_id", "formatted", "roles", "spans", "rewrites"])


def with_loss(formatted: DataFrame, roles: Sequence[str] = ("assistant",)) -> DataFrame:
    """Formatted conversations with `loss`: the (start, stop) of the texts of these roles, in order."""
    wanted = ", ".join(f"'{r}'" for r in roles)
    pairs = f"filter(arrays_zip(roles, spans), x -> x.roles in ({wanted}) and x.spans.text_start >= 0)"
    return formatted.withColumn("loss", F.expr(f"transform({pairs}, x -> struct(x.spans.text_start as start, x.spans.text_stop as stop))"))


DIGESTS = "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint, rewrites int"


def digests(formatted: DataFrame, read: Callable[[str], list[Turn]] = read_instruct, plain: Callable[[str], str] = unescape) -> DataFrame:
    """Per conversation what its output says: turns read back from the text, and the text under the loss mask."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                text = row["formatted"]
                turns = read(text)
                all_turns, loss = hashlib.sha256(), hashlib.sha256()
                for role, own in turns:
                    all_turns.update(f"{role}\n{own}\n".encode())
                n = 0
                for span in row["loss"]:
                    own = plain(text[span["start"] : span["stop"]])
                    n += len(own)
                    loss.update(own.encode())
                rows.append((row["conv_id"], len(turns), all_turns.hexdigest(), n, loss.hexdigest(), len(text), row["rewrites"]))
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int32())
            columns = list(zip(*rows)) or [()] * 7
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=[x.split()[0] for x in DIGESTS.split(", ")])

    return formatted.select("conv_id", "formatted", "loss", "rewrites").mapInArrow(run, DIGESTS)


def round_trip(turns: DataFrame, render: Render = instruct) -> DataFrame:
    """`digests` of the formatted conversations, written to the shared folder and read back."""
    return digests(stored(with_loss(format_conversations(turns, render)), "chat-format"))
