"""Operator 7: chat formatting with a grammar round trip.

A turn is rendered as `<|im_start|>ROLE\\nTEXT<|im_end|>\\n`. The grammar is regular and every turn
ends in the parser's start state, so a conversation parses back if each of its turns does. Each
rendered turn is parsed again by the deterministic parser and compared with its source; where they
differ, the conflicting content is escaped and the turn is rendered anew until they are identical.
One step of escaping puts a backslash into every `<|` (and into those that already have some), and
percent signs for line breaks in roles; both are undone by the parser.

Turns are rendered where they lie, without a shuffle. Reading back sorts the pieces by conversation
and turn on the JVM side and digests them as a stream: a task holds one turn at a time, however
long a conversation is.

Defined results: null texts and roles are empty; a null conversation is a conversation; turns with
equal numbers go by role and text, a null turn first; repeated rows are repeated turns; other
columns are not carried; empty tables give no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskengine.llm.common import kept_as, whole_text

START, END = "<|im_start|>", "<|im_end|>"
LOSS_ROLE = "assistant"
_OPEN = re.compile(r"<(\\*)\|")
_ESCAPED = re.compile(r"<\\(\\*)\|")
_ROLE_ESCAPES = {"%": "%25", "\n": "%0A", "<": "%3C"}
_TURN = re.compile(r"<\|im_start\|>([^\n<]*)\n([^<]*(?:<(?!\|)[^<]*)*)<\|im_end\|>\n")


def escaped(content: str) -> str:
    """No `<|` is left; texts that differ stay different."""
    return _OPEN.sub(r"<\\\1|", content)


def plain(content: str) -> str:
    return _ESCAPED.sub(r"<\1|", content)


def _role_out(role: str) -> str:
    return "".join(_ROLE_ESCAPES.get(c, c) for c in role)


def _role_in(role: str) -> str:
    return re.sub("%(25|0A|3C)", lambda m: chr(int(m[1], 16)), role)


def parse(formatted: str) -> list[tuple[str, str, int, int]] | None:
    """(role, text, start, end) of each turn, where start to end is the text in `formatted`.

    None if the string is not a sequence of whole turns.
    """
    turns, at = [], 0
    while at < len(formatted):
        m = _TURN.match(formatted, at)
        if not m:
            return None
        turns.append((_role_in(m[1]), plain(m[2]), m.start(2), m.end(2)))
        at = m.end()
    return turns


def render(role: str, text: str) -> str:
    """One turn, escaped just as far as its round trip needs."""
    role_out, text_out = role, text
    while True:
        formatted = f"{START}{role_out}\n{text_out}{END}\n"
        back = parse(formatted)
        if back is not None and [b[:2] for b in back] == [(role, text)]:
            return formatted
        # Whatever conflicts is escaped from its source; a second step is never needed.
        role_out, text_out = _role_out(role), escaped(text)


def format_turns(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, piece, loss_start and loss_end for turns (conv_id, turn, role, text).

    `piece` is the rendered turn; the formatted conversation is its pieces in order. The loss mask
    of a piece is the code points from loss_start to loss_end (empty unless the role is assistant).
    """
    named = kept_as(turns, conv_id="conv_id", turn="turn", role="role", text="text")
    read = named.select("conv_id", "turn", whole_text("role").alias("role"), whole_text("text").alias("text"))
    head = ["conv_id", "turn", "role"]
    types = ", ".join(f"{c} {read.schema[c].dataType.simpleString()}" for c in head)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pieces, starts, ends = [], [], []
            for role, text in zip(batch.column("role").to_pylist(), batch.column("text").to_pylist()):
                piece = render(role, text)
                _, _, start, end = parse(piece)[0]
                pieces.append(piece)
                starts.append(start if role == LOSS_ROLE else 0)
                ends.append(end if role == LOSS_ROLE else 0)
            columns = [batch.column(c) for c in head]
            columns += [pa.array(pieces, pa.string()), pa.array(starts, pa.int64()), pa.array(ends, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, [*head, "piece", "loss_start", "loss_end"])

    return read.mapInArrow(work, f"{types}, piece string, loss_start long, loss_end long")


class _Digest:
    """What is read back from a conversation, piece by piece."""

    def __init__(self, conv) -> None:
        self.conv, self.turns, self.chars, self.loss = conv, 0, 0, 0
        self.all, self.masked = hashlib.sha256(), hashlib.sha256()

    def add(self, piece: str, start: int, end: int) -> None:
        for role, text, _, _ in parse(piece):
            self.all.update(f"{role}\n{text}\n".encode())
            self.turns += 1
        masked = plain(piece[start:end])
        self.masked.update(masked.encode())
        self.loss += len(masked)
        self.chars += len(piece)

    def row(self) -> tuple:
        return self.conv, self.turns, self.all.hexdigest(), self.loss, self.masked.hexdigest(), self.chars


def read_back(pieces: DataFrame) -> DataFrame:
    """Digests per conversation, recovered from the formatted pieces alone."""
    # Turns with equal numbers go by their text, as it was before it was escaped.
    content = F.regexp_extract("piece", r"(?s)^[^\n]*\n(.*)<\|im_end\|>\n$", 1)
    text = F.regexp_replace(content, r"<\\(\\*)\|", r"<$1|")
    ordered = pieces.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", text)
    kind = pieces.schema["conv_id"].dataType.simpleString()
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    schema = f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = None
        conv_type = None
        for batch in batches:
            conv_type = batch.schema.field("conv_id").type
            done = []
            columns = (batch.column(c).to_pylist() for c in ("conv_id", "piece", "loss_start", "loss_end"))
            for conv, piece, start, end in zip(*columns):
                if now is None or now.conv != conv:
                    if now is not None:
                        done.append(now.row())
                    now = _Digest(conv)
                now.add(piece, start, end)
            yield _batch(done, names, conv_type)
        if now is not None:
            yield _batch([now.row()], names, conv_type)

    return ordered.select("conv_id", "piece", "loss_start", "loss_end").mapInArrow(work, schema)


def _batch(rows: list[tuple], names: list[str], conv_type: pa.DataType) -> pa.RecordBatch:
    types = [conv_type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names)
