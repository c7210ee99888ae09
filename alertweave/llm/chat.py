"""Chat formatting.

A finite-state machine over roles says whether each turn may follow the one before it, and a
declarative template turns it into segments: opening, text and closing, each with a flag that
says whether training counts its loss. Control strings inside texts are escaped so that the
formatted text can be read back exactly.

The state of the machine is the last role. A conversation is cut into chunks of turn numbers;
the state at the start of a chunk is the last role of the chunk before, so chunks of one long
conversation are formatted in separate tasks.

Defined results: turns are ordered by number (null first), then role, then text, so that ties
and repeated rows have one order; a null text is empty; a null role is the empty role, and
like any role that the template does not know it is formatted, never trained on and not
valid; a null conv_id is a conversation; texts of any length are formatted whole; an empty table
gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# turn numbers of a chunk
CHUNK_TURNS = 512


@dataclass(frozen=True)
class Template:
    """How turns are written, which roles may follow which, and whose texts are trained on."""

    open: str = "<s>[INST:{role}]"
    close: str = "[/INST]</s>"
    escape: str = "\\"
    special: str = "<["
    trained: frozenset[str] = frozenset({"assistant"})
    # from the role before ("" at the start) to the roles that may follow
    follow: dict[str, frozenset[str]] = field(
        default_factory=lambda: {
            "": frozenset({"system", "user"}),
            "system": frozenset({"user"}),
            "user": frozenset({"assistant"}),
            "assistant": frozenset({"user"}),
        }
    )

    def escaped(self, text: str) -> str:
        """A text in which no control string can occur: all begin with a special letter."""
        return re.sub(f"[{re.escape(self.escape + self.special)}\\]]", lambda m: self.escape + m[0], text)

    def unescaped(self, text: str) -> str:
        return re.sub(f"{re.escape(self.escape)}(.)", r"\1", text, flags=re.DOTALL)

    def valid(self, before: str, role: str) -> bool:
        return role in self.follow.get(before, ())

    def segments(self, role: str, text: str) -> list[tuple[str, bool]]:
        """Opening, text and closing with their loss flags."""
        return [
            (self.open.format(role=self.escaped(role)), False),
            (self.escaped(text), role in self.trained),
            (self.close, False),
        ]

    def turns(self, formatted: str) -> Iterator[tuple[str, str]]:
        """Roles and texts of a formatted text."""
        plain = f"(?:[^{re.escape(self.escape + self.special)}\\]]++|{re.escape(self.escape)}.)*+"
        before, after = map(re.escape, self.open.split("{role}"))
        turn = re.compile(f"{before}({plain}){after}({plain}){re.escape(self.close)}", re.DOTALL)
        at = 0
        while at < len(formatted):
            found = turn.match(formatted, at)
            if not found:
                raise ValueError(f"not a turn at {at}")
            yield self.unescaped(found[1]), self.unescaped(found[2])
            at = found.end()


TEMPLATE = Template()


def chunk_of(turn: Column) -> Column:
    return F.coalesce(F.floor(turn / CHUNK_TURNS), F.lit(-(1 << 62)))


def format_chats(rows: DataFrame, template: Template = TEMPLATE) -> DataFrame:
    """One row for each conversation and chunk of turns.

    ``formatted``; ``segments``: start, end (code points) and loss flag of each; ``n_turns``;
    ``valid``: whether the machine allows every turn of the chunk.
    """
    turns = rows.select(
        "conv_id",
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
        chunk_of(F.col("turn")).alias("chunk"),
    )
    last = F.max_by("role", F.struct("turn", "role", "text")).alias("last_role")
    ends = turns.groupBy("conv_id", "chunk").agg(last)
    before = F.lag("last_role").over(Window.partitionBy("conv_id").orderBy("chunk"))
    starts = ends.select(
        F.col("conv_id").alias("c"),
        F.col("chunk").alias("k"),
        F.coalesce(before, F.lit("")).alias("before"),
    )
    joined = turns.join(starts, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("chunk") == F.col("k")))
    placed = joined.select("conv_id", "chunk", "turn", "role", "text", "before")
    placed = placed.repartition("conv_id", "chunk").sortWithinPartitions(
        "conv_id", "chunk", "turn", "role", "text"
    )
    names = "conv_id", "chunk", "formatted", "segments", "n_turns", "valid"
    segment = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("loss", pa.bool_())]))
    types = pa.int64(), pa.int64(), pa.string(), segment, pa.int64(), pa.bool_()

    def run(batches):
        key, parts, spans, n, at, state, valid = None, [], [], 0, 0, "", True
        for batch in batches:
            made: list[tuple] = []
            columns = [batch.column(c).to_pylist() for c in ("conv_id", "chunk", "role", "text", "before")]
            for conv, chunk, role, text, start in zip(*columns, strict=True):
                if key != (conv, chunk):
                    if key is not None:
                        made.append((*key, "".join(parts), spans, n, valid))
                    key, parts, spans, n, at, state, valid = (conv, chunk), [], [], 0, 0, start, True
                valid = valid and template.valid(state, role)
                state = role
                n += 1
                for piece, loss in template.segments(role, text):
                    spans.append({"start": at, "end": at + len(piece), "loss": loss})
                    parts.append(piece)
                    at += len(piece)
            if made:
                yield table_of(made)
        if key is not None:
            yield table_of([(*key, "".join(parts), spans, n, valid)])

    def table_of(made):
        arrays = [pa.array(c, t) for c, t in zip(zip(*made, strict=True), types, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, list(names))

    schema = (
        "conv_id long, chunk long, formatted string, "
        "segments array<struct<start: int, end: int, loss: boolean>>, n_turns long, valid boolean"
    )
    return placed.mapInArrow(run, schema)


def digest_chats(chunks: DataFrame, template: Template = TEMPLATE) -> DataFrame:
    """Turns and loss texts read back from the formatted chunks, one row per conversation.

    A digest runs over a conversation from start to end, so its chunks, a small number of
    rows, pass one task in order; the task holds one chunk at a time.
    """
    names = "conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "valid"
    types = pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_()
    ordered = chunks.repartition("conv_id").sortWithinPartitions("conv_id", "chunk")

    def run(batches):
        key, state = None, None
        for batch in batches:
            made = []
            columns = [batch.column(c).to_pylist() for c in ("conv_id", "formatted", "segments", "valid")]
            for conv, formatted, segments, valid in zip(*columns, strict=True):
                if key != (conv,):
                    if key:
                        made.append((*key, *state.row()))
                    key, state = (conv,), Digest(template)
                state.add(formatted, segments, valid)
            if made:
                yield table_of(made)
        if key:
            yield table_of([(*key, *state.row())])

    def table_of(made):
        arrays = [pa.array(c, t) for c, t in zip(zip(*made, strict=True), types, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, list(names))

    schema = (
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
        "formatted_chars long, valid boolean"
    )
    return ordered.mapInArrow(run, schema)


class Digest:
    """Running digests of one conversation."""

    def __init__(self, template: Template) -> None:
        self.template = template
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n = self.loss_chars = self.chars = 0
        self.valid = True

    def add(self, formatted: str, segments: list[dict], valid: bool) -> None:
        for role, text in self.template.turns(formatted):
            self.turns.update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
            self.n += 1
        for segment in segments:
            if segment["loss"]:
                text = self.template.unescaped(formatted[segment["start"] : segment["end"]])
                self.loss.update(text.encode("utf-8", "surrogatepass"))
                self.loss_chars += len(text)
        self.chars += len(formatted)
        self.valid = self.valid and valid

    def row(self) -> tuple:
        return (self.n, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars, self.valid)
