"""Toxicity by logistic regression over hashed words, word pairs and skip-grams, learned with
FTRL-proximal: a learning rate per coordinate, and L1 sparsity that leaves a compact table of weights.

A feature is one of ``2 ** BITS`` places; the text has it or not, however often. Texts are lower-cased
(A to Z) and split into words. A word, a pair of neighbours and a pair with one word between give a feature each.
The model is learned in one task from a bounded sample and then scores every whole text.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from tallyframe.llm.base import U64, lower_ascii, mix, owners, text_runs, word_hashes

BITS = 20
#: Most labelled rows a model is learned from; fewer if there are fewer. They are drawn by a hash of the id.
SAMPLE_ROWS = 20_000
#: Times that the learner goes over the sample.
PASSES = 2


@dataclass(frozen=True)
class Ftrl:
    """Parameters of the learner. ``alpha`` and ``beta`` set the rate per coordinate, ``l1`` and ``l2`` shrink."""

    alpha: float = 2.0
    beta: float = 1.0
    l1: float = 4.0
    l2: float = 0.0
    passes: int = PASSES


@dataclass(frozen=True)
class Weights:
    """The places with a weight, their weights, and the constant."""

    places: np.ndarray
    values: np.ndarray
    constant: float

    def dense(self) -> np.ndarray:
        out = np.zeros(1 << BITS, np.float64)
        out[self.places] = self.values
        return out


def features_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct features of each text of a run: (row, place), ordered by both."""
    words, counts = word_hashes(lower_ascii(data), offsets)
    row = owners(counts)
    keys = [mix(words + U64(1))]
    rows = [row]
    for gap, salt in ((1, 0xC2B2AE3D27D4EB4F), (2, 0x165667B19E3779F9)):
        same = row[:-gap] == row[gap:]
        keys.append(mix(words[:-gap] * U64(salt) + words[gap:])[same])
        rows.append(row[:-gap][same])
    found = np.unique((np.concatenate(rows).astype(np.int64) << BITS) | (np.concatenate(keys) >> U64(64 - BITS)).astype(np.int64))
    return found >> BITS, found & ((1 << BITS) - 1)


def _feature_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at, to, data, offsets in text_runs(batch.column(0)):
            row, place = features_of(data, offsets)
            cuts = np.searchsorted(row, np.arange(to - at + 1)).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(cuts), pa.array(place.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([lists, batch.column(1).slice(at, to - at), batch.column(2).slice(at, to - at)], ["features", "label", "draw"])


def learn(rows: Iterable[tuple[np.ndarray, float]], how: Ftrl) -> Weights:
    """FTRL-proximal over (places, label) in the order given, ``how.passes`` times."""
    z, n = np.zeros(1 << BITS), np.zeros(1 << BITS)
    z0 = n0 = 0.0

    def weight(z, n):
        return np.where(np.abs(z) <= how.l1, 0.0, -(z - np.sign(z) * how.l1) / ((how.beta + np.sqrt(n)) / how.alpha + how.l2))

    for _ in range(how.passes):
        for places, label in rows:
            zi, ni = z[places], n[places]
            w = weight(zi, ni)
            w0 = -z0 / ((how.beta + n0**0.5) / how.alpha)
            p = 1 / (1 + np.exp(-np.clip(w.sum() + w0, -35, 35)))
            g = p - label
            z[places] = zi + g - (np.sqrt(ni + g * g) - np.sqrt(ni)) / how.alpha * w
            n[places] = ni + g * g
            z0 += g - ((n0 + g * g) ** 0.5 - n0**0.5) / how.alpha * w0
            n0 += g * g
    w = weight(z, n)
    places = np.flatnonzero(w)
    return Weights(places, w[places], float(-z0 / ((how.beta + n0**0.5) / how.alpha)))


class _Sample:
    """Features and labels of the sample in flat arrays, gone over as often as asked."""

    def __init__(self, batches: Iterator[pa.RecordBatch]) -> None:
        self.parts = []
        for batch in batches:
            lists = batch.column(0)
            self.parts.append((lists.flatten().to_numpy(), np.cumsum([0, *lists.value_lengths().to_pylist()]), batch.column(1).to_pylist()))

    def __iter__(self) -> Iterator[tuple[np.ndarray, float]]:
        for flat, cuts, labels in self.parts:
            for i, label in enumerate(labels):
                yield flat[cuts[i] : cuts[i + 1]], float(label)


def train(rows: DataFrame, how: Ftrl = Ftrl()) -> Weights:
    """Learn from ``rows`` (text, label 0 or 1, draw), a bounded sample, in order of ``draw``.

    Texts become features where they lie; only those meet in the one task that learns. The result is at most
    ``2 ** BITS`` weights, of which L1 leaves few. Without rows all weights are 0 and every score is 0.5.
    """

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = learn(_Sample(batches), how)
        yield pa.RecordBatch.from_arrays([pa.array([w.places], pa.list_(pa.int64())), pa.array([w.values], pa.list_(pa.float64())), pa.array([w.constant])], ["places", "weights", "constant"])

    got = (
        rows.select(F.col("text").cast("string"), F.col("label").cast("int"), F.col("draw").cast("long"))
        .mapInArrow(_feature_batches, "features array<int>, label int, draw long")
        .repartition(1).sortWithinPartitions("draw", "label", "features")
        .select("features", "label")
        .mapInArrow(fit, "places array<long>, weights array<double>, constant double")
        .first()
    )
    return Weights(np.array(got.places, np.int64), np.array(got.weights), got.constant) if got else Weights(np.zeros(0, np.int64), np.zeros(0), 0.0)


def sample(docs: DataFrame, labels: DataFrame, label: str = "toxic", rows: int = SAMPLE_ROWS, where=None) -> DataFrame:
    """At most ``rows`` labelled documents as (text, label, draw), drawn by a hash of the id.

    ``where`` filters the labels. Labels that are null or neither 0 nor 1 are left out, an id labelled twice with
    different labels counts by the larger one, and documents without a label never are in the sample.
    """
    known = labels if where is None else labels.filter(where)
    known = known.filter(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max(label).alias("label"))
    drawn = known.withColumn("draw", F.xxhash64(F.col("doc_id").cast("long"), F.lit(17))).orderBy("draw", "doc_id").limit(rows)
    # Bounded: `rows` ids of 24 bytes each.
    return docs.select("doc_id", "text").join(F.broadcast(drawn), "doc_id").select("text", "label", "draw")


def scored(docs: DataFrame, weights: Weights, text_col: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with a score from 0 to 1 per row, higher where label 1 is likelier.

    Every row is scored by its whole text alone; null counts as empty, and an empty text gets the constant's
    score. A column of the same name is replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(weights)  # at most 2 ** BITS pairs
    names = [c for c in docs.columns if c != name]
    schema = StructType([docs.schema[c] for c in names] + [StructField(name, DoubleType())])
    text_at = names.index(text_col)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dense, constant = shared.value.dense(), shared.value.constant
        for batch in batches:
            got = np.full(batch.num_rows, constant)
            for at, to, data, offsets in text_runs(batch.column(text_at).cast(pa.string())):
                row, place = features_of(data, offsets)
                got[at:to] += np.bincount(row, dense[place], to - at)
            p = 1 / (1 + np.exp(-np.clip(got, -35, 35)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(p)], [*names, name])

    return docs.select(*names).mapInArrow(score, schema)


def held_out(doc_id: str = "doc_id"):
    """Rows that a model is never learned from: crc32 of the id as text is divisible by 5. False for a null id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def model(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, how: Ftrl = Ftrl()) -> Weights:
    return train(sample(docs, labels, rows=rows, where=~held_out()), how)
