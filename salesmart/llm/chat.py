"""Chat formatting by incremental black-box rendering.

A template is any function from a list of (role, text) turns to a string; it
is never taken apart. Successive prefixes of a conversation are rendered and
consecutive outputs compared: where the longer output continues the shorter
one, the difference is the new turn's segment; where it does not, the template
rewrites history and the conversation is flagged from that turn on. Inside a
segment the text's span is found by rendering the same prefix with a one-
character probe in the text's place. Spans of assistant texts are the loss
mask.

Conversations go through a task in turn order. Every prefix is rendered whole,
so numbered turns and rewriting however far back are seen as they are; this
holds one conversation in memory and takes time with the square of its turns. A
template whose author declares that it writes each turn on its own (attribute
``independent``, as ``marked_turns`` has) streams with a bounded context
instead: from ``CONTEXT`` turns on, the first turn and the latest ones, which
give the same segments. A conversation with a third of all rows is then never
held in memory (its digest is sequential by nature). Segments, one row
per turn, are the output; joined in order they are the formatted conversation.

Defined cases: null text or role is empty; turns are ordered by turn (null
first), equal ones by role, then text; rows repeated whole are turns of their
own; null conv_id is one conversation; an empty table gives an empty result;
other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Turns = list[tuple[str, str]]
Template = Callable[[Turns], str]

CONTEXT = 64
PROBE = ""
FLUSH_CHARS = 1 << 20


# The default template: every turn is ``### role:\n text </turn>\n``; the
# characters that could begin a control string are escaped inside texts, so
# the format can be read back exactly.
def _escape(text: str, also: str = "") -> str:
    return re.sub(rf"[\\#<{also}]", lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S)


def marked_turns(turns: Turns) -> str:
    return "".join(f"### {_escape(role, ':')}:\n{_escape(text)}</turn>\n" for role, text in turns)


marked_turns.independent = True  # no turn's output depends on other turns


_TURN = re.compile(r"### ([^\\:#<]*(?:\\.[^\\:#<]*)*):\n([^\\#<]*(?:\\.[^\\#<]*)*)</turn>\n", re.S)


def read_marked_turns(formatted: str) -> Turns:
    """The turns of a string written by ``marked_turns``."""
    out, at = [], 0
    while at < len(formatted):
        found = _TURN.match(formatted, at)
        if not found:
            raise ValueError("not a formatted conversation")
        out.append((unescape(found[1]), unescape(found[2])))
        at = found.end()
    return out


class Renderer:
    """Locates the turns of one conversation in the template's output."""

    def __init__(self, template: Template):
        self.template = template
        self.context: Turns = []
        self.segments: list[str] = []  # of the turns in the context
        self.before = template([])
        self.lead = self.before        # what the template writes before any turn
        self.rewrites = False

    def add(self, role: str, text: str) -> tuple[str, tuple[int, int] | None]:
        """The turn's segment and its text's span there (None: not located)."""
        after = self.template([*self.context, (role, text)])
        if not after.startswith(self.before):
            self.rewrites = True
        segment, span = after[len(self.before):], None
        if not self.rewrites:
            probe = PROBE if PROBE not in text else next(c for c in map(chr, range(0xE001, 0xF8FF)) if c not in text)
            tried = self.template([*self.context, (role, probe)])[len(self.before):]
            head, found, tail = tried.partition(probe)
            if found and segment.startswith(head) and segment.endswith(tail) and len(segment) >= len(head) + len(tail):
                span = len(head), len(segment) - len(tail)
        self.context.append((role, text))
        self.segments.append(segment)
        self.before = after
        lead, self.lead = self.lead, ""
        if len(self.context) >= CONTEXT and getattr(self.template, "independent", False):
            self._shorten()
        return lead + segment, (span[0] + len(lead), span[1] + len(lead)) if span else None

    def _shorten(self) -> None:
        keep = CONTEXT // 2
        self.context = self.context[:1] + self.context[-keep:]
        self.segments = self.segments[:1] + self.segments[-keep:]
        self.before = self.template(self.context)
        if not self.before.endswith("".join(self.segments[1:])):
            self.rewrites = True


SEGMENTS = ("conv_id long, part long, role string, segment string, text_start long, text_end long, "
            "in_loss boolean, rewrites_history boolean")
_NAMES = [c.split()[0] for c in SEGMENTS.split(", ")]


def _batches(rows: Iterator[tuple], names: list[str], schema: pa.Schema, chars: Callable[[tuple], int]) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += chars(row) + 100
        if size >= FLUSH_CHARS:
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*held), schema)], names)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*held), schema)], names)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for i in range(0, len(batch), 256):
            yield from zip(*(c.to_pylist() for c in batch.slice(i, 256).columns))


def format_conversations(conversations: DataFrame, template: Template = marked_turns,
                         loss_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """One row per turn, ``part`` counting them: its segment of the formatted
    conversation, the span of its text, whether that span is under the loss
    mask, and whether the template has rewritten history so far."""
    schema = pa.schema([("conv_id", pa.int64()), ("part", pa.int64()), ("role", pa.string()), ("segment", pa.string()),
                        ("text_start", pa.int64()), ("text_end", pa.int64()), ("in_loss", pa.bool_()),
                        ("rewrites_history", pa.bool_())])

    def render(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        current, renderer, part = object(), None, 0
        for conv, role, text in _rows(batches):
            if conv != current:
                current, renderer, part = conv, Renderer(template), 0
            segment, span = renderer.add(role or "", text or "")
            known = span is not None and not renderer.rewrites
            yield (conv, part, role or "", segment, span[0] if known else None, span[1] if known else None,
                   known and role in loss_roles, renderer.rewrites)
            part += 1

    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", "role", "text")
    in_order = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "role", "text")
    return in_order.mapInArrow(lambda b: _batches(render(b), _NAMES, schema, lambda r: len(r[3])), SEGMENTS)


DIGESTS = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
           "formatted_chars long, rewrites_history boolean")


def read_back(segments: DataFrame) -> DataFrame:
    """One row per formatted conversation, from its segments alone: digests of
    its turns and of the text under the loss mask, and its length."""
    names = [c.split()[0] for c in DIGESTS.split(", ")]
    schema = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
                        ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()),
                        ("rewrites_history", pa.bool_())])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        current, state = object(), None
        for conv, segment, start, end, in_loss, rewrites in _rows(batches):
            if conv != current:
                if state:
                    yield finished(current, state)
                current, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0, False]
            for role, text in read_marked_turns(segment):
                state[0] += 1
                state[1].update(f"{role}\n{text}\n".encode())
            if in_loss:
                learned = unescape(segment[start:end])
                state[2] += len(learned)
                state[3].update(learned.encode())
            state[4] += len(segment)
            state[5] |= rewrites
        if state:
            yield finished(current, state)

    def finished(conv, state) -> tuple:
        return conv, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4], state[5]

    in_order = (segments.repartition("conv_id").sortWithinPartitions("conv_id", "part")
                .select("conv_id", "segment", "text_start", "text_end", "in_loss", "rewrites_history"))
    return in_order.mapInArrow(lambda b: _batches(digest(b), names, schema, lambda r: 0), DIGESTS)
