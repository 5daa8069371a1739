"""Chat formatting by prefix-target expansion: every assistant turn becomes an example of its own,
with all preceding turns as context and only that reply trainable.

The examples of a conversation are prefixes of each other. So the formatted text is kept once, as
segments with their place, and an example is a row that names how far its context reaches and which
characters are trainable. A conversation of any length thus costs its own length, not its square;
``example_texts`` writes out the text of examples where a trainer wants them whole.

Template: ``<|im_start|>role\\ntext<|im_end|>\\n`` per turn. Inside texts and roles, ``<``, any number of
backslashes, ``|`` gets one backslash more, so the marks never occur there and reading takes it off
again. A line break or backslash in a role is written as a backslash with ``n`` or a second backslash.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
#: The role whose texts are trainable.
TARGET = "assistant"

DIGEST = pa.schema(
    [("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
     ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()), ("n_examples", pa.int64()), ("context_chars", pa.int64())]
)


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def escape_role(role: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(escape(role), r"\\", r"\\\\"), "\n", r"\\n")


def unescape(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def unescape_role(role: str) -> str:
    return unescape(re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], role))


def segments(turns: DataFrame, target: str = TARGET) -> DataFrame:
    """One row per turn: conv_id, turn, position, segment (its formatted text), segment_start, and for a target
    turn loss_start and loss_end; places count code points of the formatted conversation.

    Turns are in order of ``turn``, equal ones by role and text; a null turn comes first. A null text or role is
    empty, rows without conv_id form one conversation, and repeated rows are turns of their own.
    Other columns of ``turns`` are left out.
    """
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    head = F.concat(F.lit(OPEN), escape_role(role), F.lit("\n"))
    rows = turns.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), role.alias("role"), text.alias("text"), head.alias("head"), escape(text).alias("body"))
    rows = rows.withColumn("segment", F.concat("head", "body", F.lit(CLOSE)))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("segment_start", F.sum(F.length("segment")).over(so_far) - F.length("segment")).withColumn("position", F.row_number().over(order) - 1)
    start = F.when(F.col("role") == target, F.col("segment_start") + F.length("head"))
    return rows.select("conv_id", "turn", "position", "segment", "segment_start", start.alias("loss_start"), (start + F.length("body")).alias("loss_end"))


def exploded(parts: DataFrame) -> DataFrame:
    """``segments`` with every target turn exploded into a second row, its example: kind 0 is a segment, kind 1 an example.

    An example's segment is null, its segment_start the end of its context, and loss_start and loss_end are its alone.
    """
    none = F.lit(None).cast("long")
    segment = F.struct(F.lit(0).alias("kind"), F.col("segment"), F.col("segment_start"), none.alias("loss_start"), none.alias("loss_end"))
    own = F.struct(F.lit(1).alias("kind"), F.lit(None).cast("string").alias("segment"), F.col("segment_start"), F.col("loss_start"), F.col("loss_end"))
    both = F.when(F.col("loss_start").isNotNull(), F.array(segment, own)).otherwise(F.array(segment))
    return parts.select("conv_id", "position", F.explode(both).alias("__r")).select("conv_id", "position", "__r.*")


def examples(parts: DataFrame) -> DataFrame:
    """One row per target turn of ``segments``: its context is the conversation's text before
    ``context_end``; characters from ``loss_start`` to ``loss_end`` are trainable."""
    own = exploded(parts).filter("kind = 1")
    return own.select("conv_id", F.col("position").alias("target"), F.col("segment_start").alias("context_end"), "loss_start", "loss_end")


def example_texts(parts: DataFrame) -> DataFrame:
    """Whole texts of all examples, for conversations short enough that repeating their prefixes is wanted:
    conv_id, target, formatted (context and reply), loss_start, loss_end."""
    own = examples(parts)
    before = parts.select("conv_id", "position", "segment")
    joined = own.join(before, "conv_id").filter(F.col("position") <= F.col("target"))
    whole = joined.groupBy("conv_id", "target", "loss_start", "loss_end").agg(F.sort_array(F.collect_list(F.struct("position", "segment"))).alias("p"))
    return whole.select("conv_id", "target", F.array_join("p.segment", "").alias("formatted"), "loss_start", "loss_end")


class _Reader:
    """Reads one conversation back, segment by segment, without holding more than one."""

    def __init__(self, conv_id: int | None) -> None:
        self.conv_id = conv_id
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.n_examples = self.loss_chars = self.chars = self.context = 0
        self.segment, self.start = "", -1

    def add(self, segment: str, start: int) -> None:
        if start != self.chars or not (segment.startswith(OPEN) and segment.endswith(CLOSE)):
            raise ValueError(f"conversation {self.conv_id}: a segment is out of place")
        role, _, body = segment[len(OPEN) : -len(CLOSE)].partition("\n")
        self.turns.update(f"{unescape_role(role)}\n{unescape(body)}\n".encode())
        self.n_turns += 1
        self.segment, self.start = segment, start
        self.chars += len(segment)

    def example(self, context_end: int, a: int, b: int) -> None:
        """The example of the segment just read."""
        if context_end != self.start:
            raise ValueError(f"conversation {self.conv_id}: an example is out of place")
        reply = unescape(self.segment[a - context_end : b - context_end])
        self.loss.update(reply.encode())
        self.loss_chars += len(reply)
        self.n_examples += 1
        self.context += context_end

    def row(self) -> tuple:
        return (self.conv_id, self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars, self.n_examples, self.context)


def _read_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    reader: _Reader | None = None
    for batch in batches:
        done = []
        for conv, kind, segment, start, a, b in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if reader is None or reader.conv_id != conv:
                if reader is not None:
                    done.append(reader.row())
                reader = _Reader(conv)
            if kind:
                reader.example(start, a, b)
            else:
                reader.add(segment, start)
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), DIGEST)] if done else [pa.array([], f.type) for f in DIGEST], schema=DIGEST)
    if reader is not None:
        yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(reader.row(), DIGEST)], schema=DIGEST)


def read_back(rows: DataFrame) -> DataFrame:
    """Digests of every conversation as read from its exploded rows: what is counted and hashed as loss is what the examples
    among them make trainable.

    Rows are streamed in order, one conversation after the other: a digest of one text is sequential,
    but memory holds a single segment. Columns: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256,
    formatted_chars, n_examples, context_chars (characters before the examples' own turns, in total).
    """
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "position", "kind").select("conv_id", "kind", "segment", "segment_start", "loss_start", "loss_end")
    types = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_examples long, context_chars long"
    return rows.mapInArrow(_read_batches, types)
