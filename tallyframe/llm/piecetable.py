"""Fill-in-the-middle by piece tables.

A document is a list of descriptors, each a range of an immutable buffer: the texts of a run of documents, or the
sentinels. Cutting splits a document's one descriptor in three, an arrangement permutes these and three descriptors of
sentinels, and the inverse permutation puts them back; no byte of a text moves until the result is written. Hashes
read the descriptors one after the other.

A unit is a word with the white space before it, or white space at the end of a text. A text of ``n`` units is cut
after the smaller and the larger of two places from 0 to ``n``, which a keyed hash of the document's id gives. The same
hash decides on the form: ``plain`` is the text as it is, ``psm`` is ``<P>`` prefix ``<S>`` suffix ``<M>`` middle, and ``spm`` is
``<S>`` suffix ``<P>`` prefix ``<M>`` middle. A text that holds a sentinel, and an empty or null one, stays plain, so
the sentinels of an output are the first of their kind in it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.base import _SPACE, owners, text_runs, words_of

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
SENTINELS = np.frombuffer(PREFIX + SUFFIX + MIDDLE, np.uint8)

FORMS = np.array(["plain", "psm", "spm"])
PLAIN, PSM, SPM = range(3)
#: Of the six descriptors prefix, middle, suffix, <P>, <S>, <M>: the order of each form. Plain keeps the text's own and leaves out the sentinels.
ORDER = {PLAIN: (0, 1, 2), PSM: (3, 0, 4, 2, 5, 1), SPM: (4, 2, 3, 0, 5, 1)}
#: Where prefix, middle and suffix are in each form.
INVERSE = {form: tuple(order.index(piece) for piece in range(3)) for form, order in ORDER.items()}

#: Of a hundred texts that can be cut, so many stay plain, and of a hundred cut ones so many have the suffix first.
PLAIN_PERCENT, SPM_PERCENT = 50, 80

FILLED = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string, output_sha256 string"


class Pieces:
    """Descriptors of a run of documents over two immutable buffers: ``start`` and ``end`` with one row per document
    and one column per piece. Columns 0 to 2 are ranges of the texts, columns 3 to 5 of the sentinels."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray) -> None:
        n = len(offsets) - 1
        self.buffers = [memoryview(np.ascontiguousarray(data))] * 3 + [memoryview(SENTINELS)] * 3
        self.start, self.end = np.zeros((n, 6), np.int64), np.zeros((n, 6), np.int64)
        self.start[:, 0], self.end[:, 0] = offsets[:-1], offsets[1:]
        self.start[:, 1:3] = self.end[:, 1:3] = offsets[1:, None]
        self.start[:, 3:] = np.arange(3) * 3
        self.end[:, 3:] = self.start[:, 3:] + 3
        self.form = np.zeros(n, np.int64)

    def cut(self, rows: np.ndarray, first: np.ndarray, second: np.ndarray) -> None:
        """Split the one descriptor of each of ``rows`` at two places of the buffer, ``first`` not behind ``second``."""
        self.end[rows, 0] = self.start[rows, 1] = first
        self.end[rows, 1] = self.start[rows, 2] = second

    def arrange(self, rows: np.ndarray, form: np.ndarray) -> None:
        self.form[rows] = form

    def of(self, row: int, columns: tuple[int, ...]) -> list[memoryview]:
        return [self.buffers[c][self.start[row, c] : self.end[row, c]] for c in columns]

    def arranged(self, row: int) -> list[memoryview]:
        return self.of(row, ORDER[int(self.form[row])])

    def chars(self, data: np.ndarray, column: int) -> np.ndarray:
        """Code points of a piece of every document: bytes that do not continue a character."""
        before = np.zeros(len(data) + 1, np.int64)
        np.cumsum((data & 0xC0) != 0x80, out=before[1:])
        return before[self.end[:, column]] - before[self.start[:, column]]


def digest(pieces: list[memoryview]) -> str:
    """The hash of a document, read descriptor by descriptor."""
    h = hashlib.sha256()
    for p in pieces:
        h.update(p)
    return h.hexdigest()


def units_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ends of all units of a run, the number of each document's units, and the place of its first one among the ends."""
    _, end, words = words_of(data, offsets)
    filled = np.flatnonzero(offsets[1:] > offsets[:-1])
    tail = np.zeros(len(words), np.int64)
    tail[filled] = _SPACE[data[offsets[filled + 1] - 1]]
    count = words + tail
    first = np.cumsum(count) - count
    ends = np.zeros(int(count.sum()), np.int64)
    row = owners(words)
    ends[np.arange(len(end)) + (first - (np.cumsum(words) - words))[row]] = end
    with_tail = np.flatnonzero(tail)
    ends[first[with_tail] + count[with_tail] - 1] = offsets[with_tail + 1]
    return ends, count, first


def holds_sentinel(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Which documents of a run hold the text of a sentinel."""
    out = np.zeros(len(offsets) - 1, bool)
    at = np.flatnonzero(data[:-2] == ord("<")) if len(data) > 2 else np.zeros(0, np.int64)
    at = at[np.isin(data[at + 1], SENTINELS[1::3]) & (data[at + 2] == ord(">"))]
    row = np.searchsorted(offsets, at, side="right") - 1
    out[row[at + 3 <= offsets[row + 1]]] = True
    return out


def _draws(ids: list, seed: int) -> np.ndarray:
    """Four numbers below 2^32 for each id: the first groups of eight digits of its keyed hash. A null id is written as nothing."""
    raw = b"".join(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).digest()[:16] for i in ids)
    return np.frombuffer(raw, ">u4").reshape(-1, 4).astype(np.int64)


def pieces_of(data: np.ndarray, offsets: np.ndarray, ids: list, seed: int) -> tuple[Pieces, np.ndarray]:
    """The arranged piece table of a run of documents, and the number of each one's units."""
    table = Pieces(data, offsets)
    ends, n, first = units_of(data, offsets)
    draws = _draws(ids, seed)
    cut = np.flatnonzero((offsets[1:] > offsets[:-1]) & ~holds_sentinel(data, offsets) & (draws[:, 2] % 100 < PLAIN_PERCENT))
    places = np.sort(draws[cut, :2] % (n[cut, None] + 1), axis=1)
    # A place of 0 is the start of the text; any other is the end of the unit before it.
    at = np.where(places > 0, ends[np.maximum(first[cut, None] + places - 1, 0)], offsets[cut, None])
    table.cut(cut, at[:, 0], at[:, 1])
    table.arrange(cut, np.where(draws[cut, 3] % 100 < SPM_PERCENT, SPM, PSM))
    return table, n


def _fill_batches(batches: Iterator[pa.RecordBatch], seed: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column(0)
        for a, b, data, offsets in text_runs(batch.column(1)):
            own = ids.slice(a, b - a)
            table, n = pieces_of(data, offsets, own.to_pylist(), seed)
            arranged = [table.arranged(i) for i in range(b - a)]
            plain = table.form == PLAIN
            yield pa.RecordBatch.from_arrays(
                [
                    own, pa.array(n), pa.array(FORMS[table.form]),
                    pa.array(table.chars(data, 0), mask=plain), pa.array(table.chars(data, 1), mask=plain),
                    pa.array([b"".join(p) for p in arranged], pa.binary()).view(pa.string()), pa.array([digest(p) for p in arranged], pa.string()),
                ],
                ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output", "output_sha256"],
            )


def filled(docs: DataFrame, seed: int = 42) -> DataFrame:
    """Every row of ``docs`` (doc_id, text) in the form its id draws.

    Columns: doc_id, n (units), form, prefix_chars and middle_chars (code points; null for a plain one), output, output_sha256.
    A null text is an empty one; rows of one id are cut alike if their texts have as many units, and repeated rows stay; a null
    id draws like one that is written as nothing. Other columns are left out. An empty table gives no rows.
    """
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(lambda batches: _fill_batches(batches, seed), FILLED)


def split_output(output: bytes, form: int) -> list[memoryview]:
    """Prefix, middle and suffix of an output: its descriptors between the sentinels, in the order that undoes the form's."""
    whole = memoryview(output)
    if form == PLAIN:
        return [whole]
    pieces, at = [], 0
    marks = [PREFIX, SUFFIX, MIDDLE] if form == PSM else [SUFFIX, PREFIX, MIDDLE]
    for mark, after in zip(marks, [*marks[1:], None], strict=True):
        if output[at : at + 3] != mark:
            raise ValueError(f"an output of form {FORMS[form]} lacks {mark.decode()}")
        end = len(output) if after is None else output.find(after, at + 3)
        if end < 0:
            raise ValueError(f"an output of form {FORMS[form]} lacks {after.decode()}")
        pieces += [whole[at : at + 3], whole[at + 3 : end]]
        at = end
    return [pieces[i] for i in INVERSE[form]]


def _restore_batches(batches: Iterator[pa.RecordBatch], output: int, form: int, keep: list[int], names: list[str]) -> Iterator[pa.RecordBatch]:
    known = {str(f): k for k, f in enumerate(FORMS)}
    for batch in batches:
        forms = batch.column(form).to_pylist()
        for a, b, data, offsets in text_runs(batch.column(output)):
            raw, at = data.tobytes(), offsets.tolist()
            pieces = [split_output(raw[at[i] : at[i + 1]], known[f or "plain"]) for i, f in enumerate(forms[a:b])]
            texts = pa.array([b"".join(p) for p in pieces], pa.binary()).view(pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(k).slice(a, b - a) for k in keep] + [texts, pa.array([digest(p) for p in pieces], pa.string())], names)


def restored(rows: DataFrame) -> DataFrame:
    """The texts that outputs were made of, from ``output`` and ``form`` alone: every other column stays, and restored and
    restored_sha256 take the place of ``output``. A null output is an empty one, a null form plain; an output that lacks a sentinel
    of its form is an error."""
    types = [f for f in rows.schema.fields if f.name not in ("output", "restored", "restored_sha256")]
    at = {f.name: k for k, f in enumerate(rows.schema.fields)}
    keep, names = [at[f.name] for f in types], [*[f.name for f in types], "restored", "restored_sha256"]
    schema = rows.select(*[F.col(f"`{f.name}`") for f in types]).schema.add("restored", "string").add("restored_sha256", "string")
    return rows.mapInArrow(lambda batches: _restore_batches(batches, at["output"], at["form"], keep, names), schema)
