"""Chat formatting with a loss mask, by rendering a template that nobody looks into.

A template is a function from turns to text. Successive prefixes of a conversation are rendered;
what the text gains from one prefix to the next is the span of the turn. For an assistant
turn two more renderings, with the generation prompt and with an empty answer, tell where in the
span the answer itself begins and ends. If a longer prefix does not begin with the text of
the shorter one, the template rewrites history: ``rewritten_at`` tells at which turn, and from there
on the rows have no text and no spans, because there is no text that all prefixes share.

A conversation is dealt out as segments of ``SEGMENT`` turn numbers, so one with a third of all
rows is spread over tasks, and rendered in windows of at most ``WINDOW`` turns, so rendering stays
linear: a window begins with the last ``OVERLAP`` turns of the one before, and what both render
must be equal, else the template looks further back, which counts as rewriting. Up to ``WINDOW``
turns a conversation is rendered by its whole prefixes. A segment begins with the last turns of the
one before, too, which another task renders.

Defined cases: a null text is empty, a null role is empty, null turns come first; rows with one
turn number are ordered by role and text; a null conv_id is one conversation; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from paperloom.session import stage_table

Turn = tuple[str, str]
# (turns, whether the prompt for an answer follows) -> text
Template = Callable[[list[Turn], bool], str]

ANSWERS = "assistant"
SEGMENT = 512
WINDOW = 64
OVERLAP = 8
# Turns in one row of the output.
TURNS_PER_ROW = 512

SPAN = "struct<start:long,end:long,loss_start:long,loss_end:long>"
FORMATTED = f"conv_id long, segment long, part int, text string, spans array<{SPAN}>, rewritten_at int"
DIGESTED = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string,"
    " formatted_chars long, rewritten boolean"
)

# --- the template of the queries ------------------------------------------------------

START, END = "<|im_start|>", "<|im_end|>"


def escape(text: str) -> str:
    """No control string is left: a run of backslashes between ``<`` and ``|`` grows by one."""
    return re.sub(r"<(\\*)\|", r"<\\\1|", text) if "|" in text else text


def unescape(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text) if "|" in text else text


def escape_role(role: str) -> str:
    """A role in one line."""
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def marked_turns(turns: list[Turn], prompt: bool = False) -> str:
    said = [f"{START}{escape_role(role)}\n{escape(text)}{END}\n" for role, text in turns]
    return "".join(said) + (f"{START}{ANSWERS}\n" if prompt else "")


_TURN = re.compile(re.escape(START) + r"([^\n]*)\n(.*?)" + re.escape(END) + "\n", re.DOTALL)


def read_turns(formatted: str) -> Iterator[Turn]:
    """The turns of a text that ``marked_turns`` wrote."""
    for found in _TURN.finditer(formatted):
        yield unescape_role(found[1]), unescape(found[2])


# --- rendering ------------------------------------------------------------------------


@dataclass
class Rendering:
    """The prefixes of one segment of a conversation, turn by turn."""

    template: Template
    turns: list[Turn] = field(default_factory=list)
    texts: list[str] = field(default_factory=list)  # of each prefix
    added: int = 0
    rewritten_at: int | None = None

    def add(self, turn: Turn) -> tuple[str, tuple[int, int] | None]:
        """What the turn adds to the text, and where in that its answer is."""
        if len(self.turns) >= WINDOW:
            self._move()
        before = self.texts[-1] if self.texts else ""
        whole = self.template([*self.turns, turn], False)
        self._expect(whole.startswith(before))
        answer = self._answer(turn, before, whole) if turn[0] == ANSWERS else None
        self.turns.append(turn)
        self.texts.append(whole)
        self.added += 1
        return whole[len(before) :], answer

    def _expect(self, append_only: bool) -> None:
        if not append_only and self.rewritten_at is None:
            self.rewritten_at = self.added

    def _answer(self, turn: Turn, before: str, whole: str) -> tuple[int, int]:
        prompt = self.template(self.turns, True)
        empty = self.template([*self.turns, (turn[0], "")], False)
        behind = empty[len(prompt) :]
        self._expect(prompt.startswith(before) and empty.startswith(prompt))
        self._expect(whole.startswith(prompt) and whole.endswith(behind))
        return len(prompt) - len(before), len(whole) - len(behind) - len(before)

    def _move(self) -> None:
        """Go on from the last turns alone; the first of them may look like a beginning."""
        moved = self.turns[-OVERLAP:]
        texts = [self.template(moved[: i + 1], False) for i in range(OVERLAP)]
        for i in range(1, OVERLAP):
            far = self.texts[i - OVERLAP][len(self.texts[i - OVERLAP - 1]) :]
            self._expect(texts[i] == texts[i - 1] + far)
        self.turns, self.texts = moved, texts


@dataclass
class _Part:
    """One row of the output as it grows."""

    pieces: list[str] = field(default_factory=list)
    spans: list[dict] = field(default_factory=list)
    at: int = 0

    def add(self, piece: str, answer: tuple[int, int] | None) -> None:
        loss = (self.at + answer[0], self.at + answer[1]) if answer else (None, None)
        self.spans.append({"start": self.at, "end": self.at + len(piece), "loss_start": loss[0], "loss_end": loss[1]})
        self.pieces.append(piece)
        self.at += len(piece)


def _format_rows(rows: Iterator[tuple], template: Template) -> Iterator[tuple]:
    """Formatted rows from (conv_id, segment, context, role, text) rows in order."""
    key, number, part, rendering = None, 0, _Part(), Rendering(template)

    def done() -> tuple:
        if rendering.rewritten_at is not None:
            return *key, number, None, [], rendering.rewritten_at
        return *key, number, "".join(part.pieces), part.spans, None

    for conv_id, segment, context, role, text in rows:
        if (conv_id, segment) != key or len(part.pieces) >= TURNS_PER_ROW:
            if part.pieces:
                yield done()
                number += 1
            if (conv_id, segment) != key:
                key, number, rendering = (conv_id, segment), 0, Rendering(template)
            part = _Part()
        piece, answer = rendering.add((role, text))
        if not context:
            part.add(piece, answer)
    if part.pieces:
        yield done()


_SPANS = pa.list_(pa.struct([(name, pa.int64()) for name in ("start", "end", "loss_start", "loss_end")]))
_FORMATTED = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("segment", pa.int64()),
        ("part", pa.int32()),
        ("text", pa.string()),
        ("spans", _SPANS),
        ("rewritten_at", pa.int32()),
    ]
)


def _rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*[column.to_pylist() for column in batch.columns])


def _batches_of(rows: Iterator[tuple], schema: pa.Schema, size: int) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield _batch(held, schema)
            held = []
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c, t.type) for c, t in zip(zip(*rows), schema)], schema=schema)


def plain_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, segment, role and text of every turn, nulls replaced."""
    return conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        F.coalesce(F.floor(F.col("turn") / SEGMENT).cast("long"), F.lit(-(2**62))).alias("segment"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )


def format_turns(turns: DataFrame, template: Template = marked_turns) -> DataFrame:
    """The formatted text of each segment of each conversation, in rows of up to ``TURNS_PER_ROW``
    turns, with the span of each turn and of its answer in that text. ``turns`` come from
    ``plain_turns`` and move once; a conversation's text is its rows by segment and part."""
    near = F.pmod("turn", F.lit(SEGMENT)) >= SEGMENT - OVERLAP
    own = F.struct("segment", F.lit(False).alias("context"))
    shown = F.struct((F.col("segment") + 1).alias("segment"), F.lit(True).alias("context"))
    dealt = turns.withColumn("place", F.explode(F.when(near, F.array(own, shown)).otherwise(F.array(own))))
    rows = dealt.select("conv_id", "place.segment", "place.context", "turn", "role", "text")
    placed = rows.repartition("conv_id", "segment").sortWithinPartitions("conv_id", "segment", "turn", "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches_of(_format_rows(_rows_of(batches), template), _FORMATTED, 64)

    return placed.select("conv_id", "segment", "context", "role", "text").mapInArrow(run, FORMATTED)


# --- digests of the output ------------------------------------------------------------


class _Digest:
    def __init__(self):
        self.turns, self.answers = hashlib.sha256(), hashlib.sha256()
        self.n, self.loss, self.chars, self.rewritten = 0, 0, 0, False

    def add(self, text: str, spans: list[dict], rewritten_at: int | None) -> None:
        for role, said in read_turns(text):
            self.n += 1
            self.turns.update(f"{role}\n{said}\n".encode())
        for span in spans:
            if span["loss_start"] is not None:
                answer = unescape(text[span["loss_start"] : span["loss_end"]])
                self.loss += len(answer)
                self.answers.update(answer.encode())
        self.chars += len(text)
        self.rewritten |= rewritten_at is not None

    def row(self) -> tuple:
        return self.n, self.turns.hexdigest(), self.loss, self.answers.hexdigest(), self.chars, self.rewritten


def _digest_rows(rows: Iterator[tuple]) -> Iterator[tuple]:
    """One row per conversation from formatted rows in order; holds one row and two digests."""
    key, found = None, None
    for conv_id, _, _, text, spans, rewritten_at in rows:
        if found is None or conv_id != key:
            if found:
                yield key, *found.row()
            key, found = conv_id, _Digest()
        found.add(text or "", spans, rewritten_at)
    if found:
        yield key, *found.row()


_DIGESTED = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("n_turns", pa.int64()),
        ("turns_sha256", pa.string()),
        ("loss_chars", pa.int64()),
        ("loss_sha256", pa.string()),
        ("formatted_chars", pa.int64()),
        ("rewritten", pa.bool_()),
    ]
)


def _digested(formatted: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches_of(_digest_rows(_rows_of(batches)), _DIGESTED, 1000)

    return formatted.mapInArrow(run, DIGESTED)


def digests(conversations: DataFrame) -> DataFrame:
    """What can be read back from the formatted text, per conversation.

    A conversation of one segment is read where it is formatted. The rows of a longer one are formatted
    in many tasks and then pass one after the other through the two digests, which can only be
    taken in order: that one step is a stream that holds a row at a time.
    """
    turns = plain_turns(conversations)
    spread = turns.groupBy("conv_id").agg(F.min("segment").alias("low"), F.max("segment").alias("high"))
    long = stage_table(spread.filter("low < high").select(F.col("conv_id").alias("long_id")), "long-conversations")
    same = F.col("conv_id").eqNullSafe(F.col("long_id"))
    short = _digested(format_turns(turns.join(long, same, "left_anti")))
    parts = format_turns(turns.join(long, same, "left_semi")).repartition("conv_id")
    return short.unionByName(_digested(parts.sortWithinPartitions("conv_id", "segment", "part")))
