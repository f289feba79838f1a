"""Chat formatting from event logs: partition by conversation, sort by sequence, fold, render, read back.

An event is (conv_id, message, seq, kind, role, text). ``open`` starts a message with its role, ``delta`` appends streamed
text, ``edit`` replaces the whole text, ``regenerate`` discards what was streamed so far, ``close`` ends a message. Events of
a conversation are folded in the order (message, seq): a later edit of an earlier message carries that message's number.
The turns of a conversation are numbered over a range layout and its messages are folded wherever they fall, one in memory at a time; only
its digests are read in one task, since they are sequential by definition.

Template: ``<|im_start|>role\\ntext<|im_end|>\\n`` for each message. Control strings inside roles and texts get a backslash
after their first character, backslashes are doubled, a line break in a role gets a backslash before it. A rendered
conversation is a sequence of segments, one per message, each with the span of its loss mask (assistant texts).

Defined results: NULL texts and roles are empty; a NULL conv_id is a conversation of its own; rows that tie on turn go by role,
then text; repeated rows are turns of their own; a conversation without assistant turns has the digest of an empty text.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from weirworks.llm.common import pieces
from weirworks.operators.ordered import Ordered, running_count
from weirworks.session import stored

START, END = "<|im_start|>", "<|im_end|>"
#: Strings that some chat template gives a meaning.
CONTROL = [START, END, "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"]
ANY_CONTROL = re.compile("|".join(map(re.escape, CONTROL)))
SEGMENT = re.compile(r"<\|im_start\|>((?:\\.|[^\\\n])*)\n(.*)<\|im_end\|>\n", re.S)
ESCAPED = re.compile(r"\\(.)", re.S)
CHUNK = 256

EVENTS = "conv_id bigint, message bigint, seq bigint, kind string, role string, text string"
FOLDED = "conv_id bigint, message bigint, segment string, mask_start bigint, mask_end bigint"


def escape(text: str) -> str:
    doubled = text.replace("\\", "\\\\")
    return ANY_CONTROL.sub(lambda m: m[0][0] + "\\" + m[0][1:], doubled)


def unescape(text: str) -> str:
    return ESCAPED.sub(r"\1", text) if "\\" in text else text


def render(role: str, text: str) -> tuple[str, int | None, int | None]:
    """The segment of a message and the span of its loss mask."""
    head = f"{START}{escape(role).replace(chr(10), chr(92) + chr(10))}\n"
    body = escape(text)
    span = (len(head), len(head) + len(body)) if role == "assistant" else (None, None)
    return f"{head}{body}{END}\n", *span


def parse(segment: str) -> tuple[str, str]:
    """Role and text of a segment."""
    m = SEGMENT.fullmatch(segment)
    if m is None:
        raise ValueError("not a rendered message")
    return unescape(m[1]), unescape(m[2])


class Message:
    """The state of the fold: one message."""

    def __init__(self, key: tuple):
        self.key, self.role, self.parts = key, "", []

    def apply(self, kind: str, role: str | None, text: str | None) -> None:
        if kind == "open":
            self.role = role or ""
        elif kind == "delta":
            self.parts.append(text or "")
        elif kind == "edit":
            self.parts = [text or ""]
        elif kind == "regenerate":
            self.parts = []
        elif kind != "close":
            raise ValueError(f"unknown event {kind}")


def fold(events: DataFrame) -> DataFrame:
    """Rendered segments (FOLDED) of an event log (EVENTS). Messages without an ``open`` event have an empty role."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: dict[str, list] = {}

        def reset() -> None:
            out.update({c: [] for c in ("conv_id", "message", "segment", "mask_start", "mask_end")})

        def flush() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(v, pa.string() if c == "segment" else pa.int64()) for c, v in out.items()], list(out))
            reset()
            return made

        def emit(m: Message) -> None:
            for c, v in zip(out, (*m.key, *render(m.role, "".join(m.parts)))):
                out[c].append(v)

        reset()
        now: Message | None = None
        for batch in pieces(batches, 1000):
            for conv, number, kind, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "message", "kind", "role", "text"))):
                if now is None or now.key != (conv, number):
                    if now:
                        emit(now)
                    now = Message((conv, number))
                now.apply(kind, role, text)
            if out["segment"]:
                yield flush()
        if now:
            emit(now)
            yield flush()

    log = events.repartition("conv_id", "message").sortWithinPartitions("conv_id", "message", "seq", "kind", "text")
    return log.select("conv_id", "message", "kind", "role", "text").mapInArrow(run, FOLDED)


def summaries(segments: DataFrame) -> DataFrame:
    """Per conversation: turns, digests, loss text and size, read back from rendered segments."""
    schema = "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
    names = [f.split()[0] for f in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key: list = []
        turns = loss = None
        n = loss_chars = chars = 0
        done: list[tuple] = []

        def flush() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(c, pa.string() if "sha" in x else pa.int64()) for x, c in zip(names, zip(*done))], names)
            done.clear()
            return made

        for batch in pieces(batches, 1000):
            for conv, segment, a, b in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "segment", "mask_start", "mask_end"))):
                if key != [conv]:
                    if key:
                        done.append((*key, n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars))
                    key, turns, loss, n, loss_chars, chars = [conv], hashlib.sha256(), hashlib.sha256(), 0, 0, 0
                role, text = parse(segment)
                turns.update(f"{role}\n{text}\n".encode())
                n += 1
                chars += len(segment)
                if a is not None:
                    under = unescape(segment[a:b])
                    loss.update(under.encode())
                    loss_chars += len(under)
            if done:
                yield flush()
        if key:
            done.append((*key, n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars))
            yield flush()

    ordered = segments.repartition("conv_id").sortWithinPartitions("conv_id", "message")
    return ordered.select("conv_id", "segment", "mask_start", "mask_end").mapInArrow(run, schema)


def as_events(conversations: DataFrame) -> DataFrame:
    """A log whose fold gives the stored turns: user turns are streamed and, every second one, corrected by an edit;
    assistant turns are streamed after a draft that is regenerated."""
    turns = conversations.select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
        F.coalesce(F.col("role"), F.lit("")).alias("role"), F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )
    turns = Ordered(turns, ["conv_id"], ["turn", "role", "text"]).scan(message=running_count()).result()
    event = lambda kind, text: F.struct(F.lit(kind).alias("kind"), text.alias("text"))
    none, text = F.lit(None).cast("string"), F.col("text")
    deltas = F.transform(F.regexp_extract_all(text, F.lit(f"(?s).{{1,{CHUNK}}}"), F.lit(0)), lambda part: event("delta", part))  # one pass over the text
    draft = F.array(event("delta", F.reverse(F.substring(text, 1, 40))), event("regenerate", none))
    typed = F.array(event("delta", F.substring(text, 1, 40)), event("edit", text))
    streamed = (
        F.when(F.col("role") == "assistant", F.concat(draft, deltas))
        .when(F.col("message") % 2 == 0, typed).otherwise(deltas)
    )
    log = F.concat(F.array(event("open", none)), streamed, F.array(event("close", none)))
    return turns.select("conv_id", "message", "role", F.posexplode(log).alias("seq", "e")).select(
        "conv_id", "message", F.col("seq").cast("bigint").alias("seq"), "e.kind", "role", "e.text")


def format_conversations(conversations: DataFrame) -> DataFrame:
    """Rendered segments of stored conversations, by way of their event log; written to the shared folder."""
    return stored(fold(as_events(conversations)), "chat-segments")


EXTRA = "</s>[INST] ok [/INST]"

SQL = r"""
with c as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
           union all select -7, 0, 'user', '</s>[INST] ok [/INST]' union all select -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
e as (select *, length(text) + length(text) - length(replace(text, '\', ''))
             + len(regexp_extract_all(text, '<\|im_start\|>|<\|im_end\|>|</?s>|\[/?INST\]|<</?SYS>>')) + length(role) + 24 as size from c)
select conv_id, count(*)::bigint as n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
       coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
       sha256(coalesce(string_agg(text, '' order by turn nulls first, role, text) filter (role = 'assistant'), '')) as loss_sha256,
       sum(size)::bigint as formatted_chars
from e group by conv_id
"""
