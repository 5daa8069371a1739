"""What the operators share: reading tables, tables written on the way, and numpy work on the
UTF-8 bytes of many texts at once.

A word everywhere is a run of bytes other than space and ``\\t\\n\\v\\f\\r``, which is the regular
expression ``[^\\x20\\x09-\\x0D]+``. No byte of a longer UTF-8 character is one of those, so words
can be found in the bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tallyframe.session import new_table_path

#: Texts are worked on in runs of about so many bytes, whose arrays fit a processor's cache; a longer text is a run of its own.
RUN_BYTES = 1 << 17

U64 = np.uint64
BASE = 0x9E3779B97F4A7C15 | 1
BASE_INVERSE = pow(BASE, -1, 1 << 64)


#: Rows of a scan's and of Python's batches. Rows of long texts make batches of Spark's usual sizes tens of megabytes, several of
#: which each task holds.
TEXT_SETTINGS = {"spark.sql.parquet.columnarReaderBatchSize": "512", "spark.sql.execution.arrow.maxRecordsPerBatch": "2000"}


def for_long_texts(spark: SparkSession) -> None:
    """Set the session's batch sizes for tables of long texts. Results do not depend on them."""
    for key, value in TEXT_SETTINGS.items():
        spark.conf.set(key, value)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def settle(df: DataFrame, name: str, narrow: bool = False) -> DataFrame:
    """Write to the shared folder and read again: later steps start from files, not from a lineage.

    ``narrow`` tables, of few numbers a row after a shuffle, go to a quarter as many files as a shuffle has parts: a file
    costs time and, with a file system that starts processes for each, memory.
    """
    path = new_table_path(df.sparkSession, f"llm/{name}")
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (df.coalesce(max(1, parts // 4)) if narrow else df).write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits (the splitmix64 finaliser). Works on a copy."""
    x = x ^ (x >> U64(30))
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


class Powers:
    """Powers of the hash base and of its inverse modulo 2^64, grown as needed."""

    def __init__(self) -> None:
        self.up = np.ones(1, U64)
        self.down = np.ones(1, U64)

    def to(self, n: int) -> None:
        while len(self.up) < n:
            k = len(self.up)
            step_up, step_down = U64(pow(BASE, k, 1 << 64)), U64(pow(BASE_INVERSE, k, 1 << 64))
            self.up = np.concatenate([self.up, self.up * step_up])
            self.down = np.concatenate([self.down, self.down * step_down])


POWERS = Powers()


class Rolling:
    """Hashes of any byte ranges of one buffer from a single cumulative sum."""

    def __init__(self, data: np.ndarray) -> None:
        POWERS.to(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, U64)
        np.cumsum((data.astype(U64) + U64(1)) * POWERS.up[: len(data)], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Unmixed hash of each range ``[start, end)``; equal bytes give equal values anywhere."""
        return (self.sums[end] - self.sums[start]) * POWERS.down[start]

    def every(self, width: int) -> np.ndarray:
        """Hash of the ``width`` bytes at every position that has so many."""
        n = len(self.sums) - width
        return (self.sums[width:] - self.sums[:-width]) * POWERS.down[:n] if n > 0 else np.zeros(0, U64)


def text_runs(column: pa.Array, most: int = RUN_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Split a column of texts into runs of rows: (first row, last row + 1, bytes, offsets).

    ``offsets`` has one entry more than the run has rows and starts at 0. A null is an empty text.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    n = len(column)
    if not n:
        return
    _, where, what = column.buffers()
    offsets = np.frombuffer(where, np.int64, n + 1, column.offset * 8)
    data = np.frombuffer(what, np.uint8) if what is not None and what.size else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        to = int(np.searchsorted(offsets, offsets[at] + most, side="right")) - 1
        to = min(max(to, at + 1), n)
        yield at, to, data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
        at = to


class Numbers:
    """A table from 64-bit numbers to small ones in flat arrays, looked up many at a time."""

    def __init__(self, expected: int) -> None:
        self.bits = max(int(expected * 3).bit_length(), 4)
        self.keys = np.zeros(1 << self.bits, U64)
        self.values = np.full(1 << self.bits, -1, np.int32)

    def _first(self, keys: np.ndarray) -> np.ndarray:
        return (mix(keys) >> U64(64 - self.bits)).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        """The value of each key, -1 where there is none."""
        at = self._first(keys)
        out = self.values[at]
        open_ = np.flatnonzero((out >= 0) & (self.keys[at] != keys))
        while len(open_):
            at[open_] = (at[open_] + 1) & (len(self.keys) - 1)
            out[open_] = found = self.values[at[open_]]
            open_ = open_[(found >= 0) & (self.keys[at[open_]] != keys[open_])]
        return out

    def put(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Add keys that are not there yet and differ from each other."""
        at = self._first(keys)
        left = np.arange(len(keys))
        while len(left):
            free = left[self.values[at[left]] < 0]
            _, one = np.unique(at[free], return_index=True)
            free = free[one]
            self.keys[at[free]], self.values[at[free]] = keys[free], values[free]
            left = left[self.keys[at[left]] != keys[left]]
            at[left] = (at[left] + 1) & (len(self.keys) - 1)


def spread(counts: np.ndarray) -> np.ndarray:
    """0, 1, ... within each of the counted groups."""
    return np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word of a run, and the number of words of each row."""
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = ~_SPACE[data]
    before = inside[:-2].copy()
    after = inside[2:].copy()
    here = inside[1:-1]
    bounds = offsets[(offsets > 0) & (offsets < len(data))]
    before[bounds] = False
    after[bounds - 1] = False
    start = np.flatnonzero(here & ~before)
    end = np.flatnonzero(here & ~after) + 1
    return start, end, np.diff(np.searchsorted(start, offsets))


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of every word of a run, and the number of words of each row."""
    start, end, counts = words_of(data, offsets)
    return mix(Rolling(data).of(start, end)), counts


def owners(counts: np.ndarray) -> np.ndarray:
    """The row that each of the counted things belongs to."""
    return np.repeat(np.arange(len(counts)), counts)


#: Bits of a filter of ids: 2 MB whatever the input. With more ids it lets more through, never fewer.
FILTER_BITS = 24


def _bit_of(ids: np.ndarray) -> np.ndarray:
    return (mix(ids.astype(np.int64).view(U64) + U64(1)) >> U64(64 - FILTER_BITS)).astype(np.int64)


def id_filter(ids: DataFrame, column: str) -> np.ndarray:
    """A bitmap of fixed size that holds every id of a column: a test before a shuffle, not a result."""
    slice_bits = 1 << 15

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(1 << FILTER_BITS, bool)
        for batch in batches:
            bits[_bit_of(batch.column(0).drop_null().to_numpy(zero_copy_only=False))] = True
        parts = bits.reshape(-1, slice_bits)
        full = np.flatnonzero(parts.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(full), pa.array([np.packbits(parts[k]).tobytes() for k in full], pa.binary())], ["slice", "bits"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own[k] = own.get(k, 0) | np.frombuffer(b, np.uint8)
        yield pa.RecordBatch.from_arrays([pa.array(list(own), pa.int64()), pa.array([b.tobytes() for b in own.values()], pa.binary())], ["slice", "bits"])

    parts = ids.select(column).mapInArrow(mark, "slice long, bits binary").repartition("slice").mapInArrow(merge, "slice long, bits binary")
    bits = np.zeros((1 << FILTER_BITS) // 8, np.uint8)
    for r in parts.collect():  # bounded: 2 ** FILTER_BITS bits
        bits[r.slice * slice_bits // 8 : (r.slice + 1) * slice_bits // 8] = np.frombuffer(r.bits, np.uint8)
    return bits


def in_filter(bits: np.ndarray, ids: pa.Array) -> np.ndarray:
    """Which ids may be among those of the filter: all of them, few others, and no null."""
    at = _bit_of(ids.fill_null(0).to_numpy(zero_copy_only=False))
    return ((bits[at >> 3] >> (7 - (at & 7))) & 1).astype(bool) & ids.is_valid().to_numpy(zero_copy_only=False)


def rows_in_filter(df: DataFrame, bits: np.ndarray, column: str, inside: bool = True) -> DataFrame:
    """Rows whose id may be among those of the filter, or with ``inside`` off those whose id is not.

    One Python worker per task: steps in Python that follow should come after a shuffle.
    """
    shared = df.sparkSession.sparkContext.broadcast(bits)
    at = df.columns.index(column)

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(in_filter(shared.value, batch.column(at)) == inside))

    return df.mapInArrow(test, df.schema)


def joined_apart(rows: DataFrame, other: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """A join whose tasks read a shuffle, however small ``other`` is: Python steps before and after it are never in one task.

    A task has a Python worker for each of its Python steps, and an executor keeps all workers it ever had at once, with their memory.
    """
    return rows.join(other.hint("merge"), key, how)
