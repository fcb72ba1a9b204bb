"""Chat formatting by rendering successive prefixes of a conversation with a black-box template.

The template is any function from a list of messages to text. Which part of the output belongs
to which turn is found by comparing what it renders for one turn more.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsemart.llm.common import text_of

Message = dict[str, str]
Template = Callable[[list[Message]], str]

OPEN, CLOSE = "### ", "</turn>\n"
ESCAPES = {"\\": "\\\\", "#": "\\h", "<": "\\l"}
NAME_ESCAPES = ESCAPES | {":": "\\c", "\n": "\\n"}


def escaped(text: str, table: dict[str, str] = ESCAPES) -> str:
    """No marker of a turn can occur in the result, and `unescaped` gives the text back."""
    return re.sub("[" + re.escape("".join(table)) + "]", lambda m: table[m[0]], text)


def unescaped(text: str, table: dict[str, str] = NAME_ESCAPES) -> str:
    back = {v: k for k, v in table.items()}
    return re.sub(r"(?s)\\.", lambda m: back[m[0]], text)


class Turns(dict):
    """Marked turns by role and text. Short ones, up to `most` of them, are remembered, as each is
    rendered once for every prefix that holds it."""

    def __init__(self, most: int = 8192, longest: int = 2000) -> None:
        super().__init__()
        self.most, self.longest = most, longest

    def __reduce__(self) -> tuple:
        return Turns, (self.most, self.longest)

    def __missing__(self, key: tuple[str, str]) -> str:
        role, text = key
        made = f"{OPEN}{escaped(role, NAME_ESCAPES)}: {escaped(text)}{CLOSE}"
        if len(made) <= self.longest:
            if len(self) >= self.most:
                self.clear()
            self[key] = made
        return made


TURNS = Turns()


def marked_turns(messages: list[Message]) -> str:
    """The default template: `### Role: text</turn>` per turn, control strings escaped."""
    return "".join([TURNS[m["role"], m["text"]] for m in messages])


def parse(formatted: str) -> list[Message]:
    """The turns back from the default template's output."""
    turns = []
    for turn in formatted.split(CLOSE)[:-1]:
        role, text = turn.removeprefix(OPEN).split(": ", 1)
        turns.append({"role": unescaped(role), "text": unescaped(text)})
    return turns


@dataclass
class Rendered:
    """Output for a conversation and, by turn, where it stands and where its text stands.

    A span is None where the template changed what it had rendered before, or where the text
    could not be told from its frame.
    """

    text: str
    turns: list[tuple[int, int] | None] = field(default_factory=list)
    contents: list[tuple[int, int] | None] = field(default_factory=list)
    rewrites: bool = False


def common_start(a: str, b: str) -> int:
    """Length of the common prefix, by halving: the comparisons themselves are fast."""
    low, high = 0, min(len(a), len(b))
    if a[:high] == b[:high]:
        return high
    while low < high:
        mid = (low + high + 1) // 2
        low, high = (mid, high) if a[low:mid] == b[low:mid] else (low, mid - 1)
    return low


def render(messages: list[Message], template: Template) -> Rendered:
    """Render every prefix of the conversation and compare consecutive outputs.

    Where each output starts with the one before, the new part is the turn's span. The frame
    around its text is what two one-letter texts in its place share. A template that rewrites
    history is reported; the spans it changed are None. Costs the length of the conversation
    times its turns; two outputs are held at a time.
    """
    out = Rendered(template([]))
    for k, message in enumerate(messages):
        before, after = out.text, template(messages[: k + 1])
        out.text = after
        same = common_start(before, after)
        if same < len(before):
            out.rewrites = True
            # Spans that reach into the changed part no longer hold.
            for spans in (out.turns, out.contents):
                spans[:] = [s if s and s[1] <= same else None for s in spans]
            out.turns.append(None)
            out.contents.append(None)
            continue
        start, end = len(before), len(after)
        out.turns.append((start, end))
        one, two = (template([*messages[:k], message | {"text": t}])[start:] for t in ("o", "x"))
        head = common_start(one, two)
        tail = common_start(one[::-1], two[::-1])
        part = after[start:end]
        framed = len(part) >= head + tail and part[:head] == one[:head]
        framed &= tail == 0 or part[len(part) - tail :] == one[len(one) - tail :]
        out.contents.append((start + head, end - tail) if framed else None)
    return out


def conversations(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[int | None, list[Message]]]:
    """One conversation after the other from rows sorted by conversation and turn."""

    def rows() -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True)

    for conv_id, turns in groupby(rows(), key=lambda r: r[0]):
        yield conv_id, [{"role": role, "text": text} for _, role, text in turns]


SPANS = "array<struct<start:int,end:int>>"
RESULT = (
    f"conv_id long, formatted string, roles array<string>, turn_spans {SPANS}, text_spans {SPANS}, "
    "rewrites boolean"
)


def format_conversations(rows: DataFrame, template: Template = marked_turns) -> DataFrame:
    """One row per conversation: formatted text, roles, spans by turn, whether history changed.

    `rows` has conv_id, turn, role, text. Null text or role is empty; null conv_id is a
    conversation of its own; turns are ordered by turn (null first), then role and text, so
    repeated rows are kept as turns. Other columns are ignored. An empty table gives no rows.
    Conversations are read one at a time from sorted rows; one must fit in a task.
    """
    ordered = (
        rows.select(
            F.col("conv_id").cast("long").alias("conv_id"),
            "turn",
            text_of("role").alias("role"),
            text_of("text").alias("text"),
        )
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "turn", "role", "text")
        .select("conv_id", "role", "text")
    )

    def formatted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [
                ("conv_id", pa.int64()),
                ("formatted", pa.string()),
                ("roles", pa.list_(pa.string())),
                *(
                    (n, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))
                    for n in ("turn_spans", "text_spans")
                ),
                ("rewrites", pa.bool_()),
            ]
        )

        def spans(found: list) -> list:
            return [s and {"start": s[0], "end": s[1]} for s in found]

        block, size = [], 0
        for conv_id, messages in conversations(batches):
            r = render(messages, template)
            block.append(
                {
                    "conv_id": conv_id,
                    "formatted": r.text,
                    "roles": [m["role"] for m in messages],
                    "turn_spans": spans(r.turns),
                    "text_spans": spans(r.contents),
                    "rewrites": r.rewrites,
                }
            )
            size += len(r.text)
            if size > 4_000_000:
                yield pa.RecordBatch.from_pylist(block, schema)
                block, size = [], 0
        if block:
            yield pa.RecordBatch.from_pylist(block, schema)

    return ordered.mapInArrow(formatted, RESULT)
