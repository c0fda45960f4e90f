"""Conversations as one marked text, proven by reading it back.

A turn is rendered as ``<|im_start|>role\\ntext<|im_end|>\\n``. The parser takes
the marks as they stand and undoes one level of escaping: in texts one
backslash of ``<\\...|im_start|>`` or ``<\\...|im_end|>``, in roles ``\\n`` and ``\\\\``.
Each turn is first rendered as it is and parsed; whatever the parser does not
give back identically is escaped, and the turn is tried again until it is. So
only conflicting content is ever changed, and all of it is recovered.

A segment begins and ends with a mark and holds no other, so the text of a
conversation is its segments in order, and it is parsed one segment at a time.
Turns are ordered by turn number (null first), then role, then text; equal rows
are all kept. Null roles and texts are empty. Rows of one conversation go
through one task as a sorted stream: no conversation is held in memory.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
LOSS_ROLE = "assistant"
_MARK = re.compile(r"<(\\*)\|im_(start|end)\|>")
_MAX_TRIES = 8


class NotParsed(ValueError):
    """The text is not of the grammar."""


def _escape_text(text: str) -> str:
    return _MARK.sub(lambda m: rf"<\{m[1]}|im_{m[2]}|>", text)


def _unescape_text(text: str) -> str:
    return _MARK.sub(lambda m: f"<{m[1][1:]}|im_{m[2]}|>", text)


def _escape_role(role: str) -> str:
    return _escape_text(role.replace("\\", "\\\\").replace("\n", "\\n"))


def _unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], _unescape_text(role))


def render_turn(role: str, text: str) -> tuple[str, int, int]:
    """(segment, start, end of the text within it) that parses back to the turn."""
    shown_role, shown_text = role, text
    for _ in range(_MAX_TRIES):
        segment = f"{START}{shown_role}\n{shown_text}{END}\n"
        try:
            got_role, got_text, first, stop = parse_turn(segment)
        except NotParsed:
            got_role, got_text = None, None
        if (got_role, got_text) == (role, text):
            return segment, first, stop
        if got_role != role:
            shown_role = _escape_role(role)
        if got_text != text:
            shown_text = _escape_text(text)
    raise NotParsed(f"no escaping recovers the turn {role!r}")


def parse_turn(segment: str) -> tuple[str, str, int, int]:
    """(role, text, start, end of the text as it stands) of a segment that is exactly one turn."""
    bare = [m for m in _MARK.finditer(segment) if not m[1]]
    if [m[2] for m in bare] != ["start", "end"] or bare[0].start() or bare[1].end() + 1 != len(segment) or segment[-1] != "\n":
        raise NotParsed("a turn has one start mark, one end mark and a new line")
    head = segment.find("\n", bare[0].end(), bare[1].start())
    if head < 0:
        raise NotParsed("no new line after the role")
    first, stop = head + 1, bare[1].start()
    return _unescape_role(segment[bare[0].end() : head]), _unescape_text(segment[first:stop]), first, stop


def format_chats(conversations: DataFrame, *, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, position, segment, loss_first, loss_stop): rendered turns, each conversation's in order and together.

    The loss range marks an assistant's text within its segment (code points); it is null for other roles.
    """
    rows = conversations.select(
        F.col(id_col).cast("long").alias("conv_id"),
        F.col(turn_col).cast("long").alias("turn"),
        F.coalesce(F.col(role_col), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", F.asc_nulls_first("turn"), "role", "text")

    def render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, position = object(), 0
        for part in batches:
            ids = part.column("conv_id").to_pylist()
            places, segments, firsts, stops = [], [], [], []
            for conv, role, text in zip(ids, part.column("role").to_pylist(), part.column("text").to_pylist(), strict=True):
                position = position + 1 if conv == last else 0
                last = conv
                segment, first, stop = render_turn(role, text)
                places.append(position)
                segments.append(segment)
                firsts.append(first if role == LOSS_ROLE else None)
                stops.append(stop if role == LOSS_ROLE else None)
            arrays = [part.column("conv_id"), pa.array(places, pa.int64()), pa.array(segments, pa.string()), pa.array(firsts, pa.int64()), pa.array(stops, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, ["conv_id", "position", "segment", "loss_first", "loss_stop"])

    return rows.mapInArrow(render, "conv_id long, position long, segment string, loss_first long, loss_stop long")


class _Reader:
    """Digests of one conversation, from its segments in order."""

    def __init__(self, conv) -> None:
        self.conv, self.turns, self.loss_chars, self.chars = conv, 0, 0, 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, segment: str, first: int | None, stop: int | None) -> None:
        role, text, _, _ = parse_turn(segment)
        self.turns += 1
        self.chars += len(segment)
        self.all.update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
        if first is not None:
            learned = _unescape_text(segment[first:stop])
            self.loss_chars += len(learned)
            self.loss.update(learned.encode("utf-8", "surrogatepass"))

    def row(self) -> tuple:
        return self.conv, self.turns, self.all.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


DIGEST = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def read_back(formatted: DataFrame, *, arranged: bool = False) -> DataFrame:
    """Turns and loss text of each conversation, parsed from the rendered segments.

    ``arranged``: the rows come straight from :func:`format_chats`, where each
    conversation's segments already stand together in order.
    """
    if not arranged:
        formatted = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "position")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, done = None, []
        for part in batches:
            for conv, segment, first, stop in zip(*(part.column(c).to_pylist() for c in ("conv_id", "segment", "loss_first", "loss_stop")), strict=True):
                if reader is None or reader.conv != conv:
                    done += [reader.row()] if reader else []
                    reader = _Reader(conv)
                reader.add(segment, first, stop)
            yield _digests(done)
            done = []
        yield _digests([reader.row()] if reader else [])

    return formatted.select("conv_id", "segment", "loss_first", "loss_stop").mapInArrow(read, DIGEST)


def _digests(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
    columns = list(zip(*rows, strict=True)) or [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], [c.split()[0] for c in DIGEST.split(", ")])
