"""N-gram Jaccard join by a token-group matrix.

The tokens of a document are its distinct word shingles, as 64-bit hashes. Documents with equal sets
are one class, and the join is over classes. Similar classes are put into groups; the matrix says
which tokens occur in which group. A class can only have a partner in a group if the group's union
holds enough of its tokens, so only such groups are opened and their members compared exactly.

1. Counts of hashed tokens in a table of fixed size give a global order, rare tokens first.
2. Each document gives its set's digest and its *prefix*: so many of its rarest tokens that two linked
   documents must share at least ``COMMON`` of them (all that can be needed, for very small sets).
3. Prefix tokens of one class alone go. A class left with fewer than it must share has no partner. Of the others,
   those with the same most frequent shared token form a group, in blocks of bounded size.
4. The matrix is stored by token, from prefixes: a class can only have a partner in a group that holds
   enough of its prefix and whose range of set sizes allows a link.
5. Texts of the classes concerned are read again, and each group meets its visitors: the bound on the whole
   token union first, members after. Links that follow from others inside a group are left out.
6. Components of the links give the result.

The order, the groups, the blocks and the filter of ids change only how much work there is, not which links are found.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.llm.base import U64, id_filter, joined_apart, lower_ascii, mix, owners, rows_in_filter, settle, text_runs, word_hashes
from tallyframe.llm.components import components

#: Counters of hashed tokens: 2 ** BITS of 4 bytes, whatever the input.
BITS = 20
SLICE = 1 << 12
#: Classes of one block of a group, and visitors that meet one copy of it.
BLOCK = 256
VISITORS = 2048
#: Prefix tokens that linked sets share at least, if they have so many.
COMMON = 6


def token_sets(data: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each row of a run: their bounds by row, and the hashes in ascending order."""
    words, counts = word_hashes(data, offsets)
    rows = owners(counts)
    rolled = np.zeros(len(words), U64)
    n = len(words) - width + 1
    if n > 0:
        for i in range(width):
            rolled[:n] = mix(rolled[:n] + words[i : n + i])
    first = np.concatenate([[0], np.cumsum(counts)])
    whole = np.zeros(len(words), bool)
    if n > 0:
        whole[:n] = rows[:n] == rows[width - 1 :]
    for r in np.flatnonzero((counts > 0) & (counts < width)):
        short = U64(counts[r])
        for w in words[first[r] : first[r + 1]]:
            short = mix(np.array([short ^ w], U64) * U64(0xD6E8FEB86659FD93))[0]
        rolled[first[r]] = short
        whole[first[r]] = True
    token, row = rolled[whole], rows[whole]
    order = np.lexsort((token, row))
    token, row = token[order], row[order]
    fresh = np.ones(len(token), bool)
    fresh[1:] = (token[1:] != token[:-1]) | (row[1:] != row[:-1])
    return np.searchsorted(row[fresh], np.arange(len(counts) + 1)), token[fresh]


def _sets(column: pa.Array, width: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, tokens) of every row of a column of texts."""
    for at, to, data, offsets in text_runs(column):
        cuts, tokens = token_sets(lower_ascii(data), offsets, width)
        for i in range(to - at):
            yield at + i, tokens[cuts[i] : cuts[i + 1]]


def _digest(tokens: np.ndarray) -> bytes:
    return hashlib.blake2b(tokens.tobytes(), digest_size=16).digest()


def token_counts(docs: DataFrame, width: int) -> np.ndarray:
    """How often each hashed token occurs: one table of 2 ** BITS counters, at any size of the input."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << BITS, np.int32)
        for batch in batches:
            for _, _, data, offsets in text_runs(batch.column(0)):
                _, tokens = token_sets(lower_ascii(data), offsets, width)
                np.add.at(total, (tokens >> U64(64 - BITS)).astype(np.int64), 1)
        if total.any():
            parts = total.reshape(-1, SLICE)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(parts), dtype=np.int64)), pa.array([p.tobytes() for p in parts])], ["slice", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own[k] = own.get(k, 0) + np.frombuffer(c, np.int32).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(list(own), pa.int64()), pa.array([np.minimum(c, 2**31 - 1).astype(np.int32).tobytes() for c in own.values()], pa.binary())], ["slice", "counts"])

    parts = docs.select("text").mapInArrow(count, "slice long, counts binary")
    # Bounded: 2 ** BITS counters of 4 bytes.
    rows = parts.repartition(F.col("slice")).mapInArrow(add, "slice long, counts binary").collect()
    total = np.zeros(1 << BITS, np.int32)
    for r in rows:
        total[r.slice * SLICE : (r.slice + 1) * SLICE] = np.frombuffer(r.counts, np.int32)
    return total


def _needed(n, percent: int):
    """Fewest common tokens with a linked set, for a set of ``n`` tokens."""
    return -(-percent * n // 100)


def signed(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """doc_id, n, digest and prefix of every row; an empty set has no digest and no prefix."""
    shared = docs.sparkSession.sparkContext.broadcast(token_counts(docs, width))  # 2 ** BITS counters

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = shared.value
        for batch in batches:
            size, digest, prefix = [], [], []
            for _, tokens in _sets(batch.column(1), width):
                n = len(tokens)
                size.append(n)
                if not n:
                    digest.append(None), prefix.append(None)
                    continue
                often = counts[(tokens >> U64(64 - BITS)).astype(np.int64)]
                need = _needed(n, percent)
                k = n - need + min(COMMON, need)
                rare = np.argpartition(often, k - 1)[:k] if k < n and not (often == often[0]).all() else np.arange(n)
                most = often[rare].max()
                below = tokens[often < most]
                ties = tokens[often == most][: k - len(below)]
                digest.append(_digest(tokens))
                prefix.append(np.concatenate([below, ties]).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(size, pa.int64()), pa.array(digest, pa.binary()), pa.array(prefix, pa.list_(pa.int64()))],
                ["doc_id", "n", "digest", "prefix"],
            )

    return docs.select("doc_id", "text").mapInArrow(sign, "doc_id long, n long, digest binary, prefix array<long>")


def _must_share(percent: int):
    """Prefix tokens that a set of ``n`` tokens shares with any partner at least."""
    return F.least(F.lit(COMMON), F.ceil(F.col("n") * percent / 100))


def _shared_tokens(classes: DataFrame) -> DataFrame:
    """(token, rep, often): prefix tokens that more than one class has."""
    often = F.count("*").over(Window.partitionBy("token"))
    tokens = classes.select("rep", F.explode("prefix").alias("token"))
    return settle(tokens.withColumn("often", often).filter("often > 1"), "shared_tokens", narrow=True)


def _grouped(classes: DataFrame, shared: DataFrame, percent: int) -> DataFrame:
    """Classes that can have a partner at all, each with the block of the group it belongs to.

    The group is that of the class's most frequent shared token, so a large family of near copies makes few groups; it
    has as many blocks as its size asks for.
    """
    known = shared.groupBy("rep").agg(F.count("*").alias("tokens"), F.max(F.struct("often", "token")).alias("sig"))
    able = classes.select("rep", "digest", "n", _must_share(percent).alias("least")).join(known, "rep").filter("tokens >= least")
    able = able.select("rep", "digest", "n", "least", F.col("sig.token").alias("sig"))
    many = able.groupBy("sig").agg(F.count("*").alias("size"))
    block = F.pmod(F.xxhash64("rep"), F.ceil(F.col("size") / BLOCK))
    return settle(able.join(many, "sig").select("rep", "digest", "n", "least", F.xxhash64("sig", block).alias("g")), "groups", narrow=True)


def visits(grouped: DataFrame, shared: DataFrame, percent: int) -> DataFrame:
    """(rep, g, own): classes and the groups that may hold a partner, ``own`` telling that it is the class's own.

    Every pair of classes in different groups is met once, from the lower group to the higher. A group's column of the
    matrix has for each token how many members have it, and the range of their set sizes.
    """
    held = shared.select("token", "rep").join(grouped.select("rep", "n", "least", "g"), "rep")
    columns = held.groupBy("token", F.col("g").alias("to")).agg(
        F.count("*").alias("members"), F.min("n").alias("low"), F.max("n").alias("high"), F.min("least").alias("to_least")
    )
    fits = (F.col("n") * percent <= F.col("high") * 100) & (F.col("low") * percent <= F.col("n") * 100)
    there = (F.col("g") < F.col("to")) | ((F.col("g") == F.col("to")) & (F.col("members") > 1))
    met = held.join(columns, "token").filter(there & fits).groupBy("rep", "g", "to", "least").agg(F.count("*").alias("tokens"), F.min("to_least").alias("to_least"))
    return met.filter(F.col("tokens") >= F.least("least", "to_least")).select("rep", F.col("to").alias("g"), (F.col("g") == F.col("to")).alias("own"))


def _routes(grouped: DataFrame, met: DataFrame) -> DataFrame:
    """Where each class goes: (rep, digest, ways), a way being (g, part, visitor).

    All members of a visited group go to every part of it, and a visitor goes to one. In a group without visitors, only
    members that may link with each other go.
    """
    pairs, inner = met.filter("not own").select("rep", "g"), met.filter("own").select("rep", "g")
    guests = pairs.groupBy("g").agg(F.ceil(F.count("*") / VISITORS).alias("parts"))
    visited = grouped.select("rep", "g").join(guests, "g").select("rep", "g", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"))
    alone = inner.join(guests, "g", "left_anti").select("rep", "g", F.lit(0).cast("long").alias("part"))
    visitors = pairs.join(guests, "g").select("rep", "g", F.pmod(F.xxhash64("rep"), F.col("parts")).alias("part"), F.lit(1).alias("visitor"))
    ways = visited.unionByName(alone).withColumn("visitor", F.lit(0)).unionByName(visitors)
    return ways.groupBy("rep").agg(F.collect_list(F.struct("g", "part", "visitor")).alias("ways")).join(grouped.select("rep", "digest"), "rep")


def _expand(width: int):
    """Texts with their ways become one row of tokens per way."""

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["g", "part", "visitor", "rep", "tokens"]
        types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary()]

        def out(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

        for batch in batches:
            reps, digests, ways = (batch.column(i).to_pylist() for i in range(3))
            rows, held = [], 0
            for i, tokens in _sets(batch.column(3), width):
                if _digest(tokens) != digests[i]:
                    continue  # another text under the same id
                packed = tokens.tobytes()
                for w in ways[i]:
                    rows.append((w["g"], w["part"], w["visitor"], reps[i], packed))
                    held += len(packed)
                if held > 1 << 24:
                    yield out(rows)
                    rows, held = [], 0
            if rows:
                yield out(rows)

    return expand


class Group:
    """One block: its members' tokens by token, and the components its own links make."""

    def __init__(self, percent: int) -> None:
        self.percent, self.reps, self.sets = percent, [], []

    def add(self, rep: int, tokens: np.ndarray) -> None:
        self.reps.append(rep)
        self.sets.append(tokens)

    def close(self) -> list[tuple[int, int]]:
        """Index the members; gives links that connect all members which links connect."""
        self.sizes = np.array([len(s) for s in self.sets], np.int64)
        tokens = np.concatenate(self.sets)
        owner = np.repeat(np.arange(len(self.sets)), self.sizes)
        order = np.argsort(tokens, kind="stable")
        tokens, self.owner = tokens[order], owner[order]
        new = np.ones(len(tokens), bool)
        new[1:] = tokens[1:] != tokens[:-1]
        self.union, self.cuts = tokens[new], np.append(np.flatnonzero(new), len(tokens))
        self.root = np.arange(len(self.sets))
        links = []
        if len(self.sets) > 1:
            for i, own in enumerate(self.sets):
                for j in self.linked(own):
                    if self.root[i] != self.root[j]:
                        self.root[self.root == self.root[j]] = self.root[i]
                        links.append((self.reps[i], self.reps[j]))
        self.sets = []
        return links

    def linked(self, tokens: np.ndarray) -> np.ndarray:
        """Members linked with a set: the bound of the whole group first, then its members."""
        at = np.searchsorted(self.union, tokens)
        at[at == len(self.union)] = 0
        at = at[self.union[at] == tokens]
        if 100 * len(at) < self.percent * len(tokens):
            return np.zeros(0, np.int64)
        length = self.cuts[at + 1] - self.cuts[at]
        places = np.repeat(self.cuts[at] - np.concatenate([[0], np.cumsum(length)[:-1]]), length) + np.arange(length.sum())
        common = np.bincount(self.owner[places], minlength=len(self.sizes))
        return np.flatnonzero(100 * common >= self.percent * (len(tokens) + self.sizes - common))

    def visit(self, rep: int, tokens: np.ndarray) -> list[tuple[int, int]]:
        """One link of a visitor to each component it is linked with."""
        links, seen = [], set()
        for j in self.linked(tokens):
            if self.root[j] not in seen:
                seen.add(self.root[j])
                links.append((rep, self.reps[j]))
        return links


def _meet(percent: int):
    """Rows in order of group, part and kind: members make the group, visitors are compared one by one."""

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, group, closed = None, None, False
        for batch in batches:
            links = []
            for g, part, visitor, rep, packed in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (g, part) != key:
                    if group is not None and not closed:
                        links += group.close()
                    key, group, closed = (g, part), Group(percent), False
                tokens = np.frombuffer(packed, U64)
                if visitor:
                    if not closed:
                        links += group.close()
                        closed = True
                    links += group.visit(rep, tokens)
                else:
                    group.add(rep, tokens)
            yield _link_batch(links)
        if group is not None and not closed:
            yield _link_batch(group.close())

    return meet


def _link_batch(links: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x[i] for x in links], pa.int64()) for i in (0, 1)], ["a", "b"])


def linked_classes(docs: DataFrame, sets: DataFrame, width: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Classes (digest, rep, ...) and links between their representatives."""
    classes = sets.filter("digest is not null and doc_id is not null").groupBy("digest").agg(
        F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("prefix").alias("prefix")
    )
    classes = settle(classes, "classes", narrow=True)
    shared = _shared_tokens(classes)
    grouped = _grouped(classes, shared, percent)
    ways = settle(_routes(grouped, settle(visits(grouped, shared, percent), "visits", narrow=True)), "ways", narrow=True)
    texts = docs.select(F.col("doc_id").alias("rep"), "text")
    texts = joined_apart(rows_in_filter(texts, id_filter(ways, "rep"), "rep"), ways, "rep").select("rep", "digest", "ways", "text")
    seats = texts.mapInArrow(_expand(width), "g long, part long, visitor int, rep long, tokens binary")
    seats = seats.repartition("g", "part").sortWithinPartitions("g", "part", "visitor", "rep")
    return classes, seats.mapInArrow(_meet(percent), "a long, b long")


def jaccard_components(docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id (the smallest id reachable by links).

    Two documents link when their sets of ``width``-word shingles (ASCII letters lower-cased; a shorter text as one
    shingle) have a Jaccard similarity of ``percent`` % or more. Copies are linked through their class. A null or empty
    text, or one of white space, has an empty set, links with nothing and is its own component; a null id links with
    nothing and has a null component. Rows repeated under one id get the same result; other columns are ignored.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    sets = settle(signed(docs, width, percent), "sets")
    classes, links = linked_classes(docs, sets, width, percent)
    roots = components(links)
    label = classes.select("digest", "rep").join(roots, F.col("rep") == F.col("node"), "left").select("digest", F.coalesce("root", "rep").alias("root"))
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("root", "doc_id"))
    return sets.select("doc_id", "n", "digest").join(label, "digest", "left").select("doc_id", F.col("n").alias("n_shingles"), own.alias("component_id"))


def one_of_each(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` (doc_id, text and others) without those whose component has a smaller id.

    Of rows repeated under one id the first by text stays. Rows without id stay. Only rows that may have to go meet the
    result in a shuffle.
    """
    found = settle(jaccard_components(docs, width, percent), "components", narrow=True)
    gone = found.filter("component_id < doc_id").select("doc_id").distinct()
    again = found.groupBy("doc_id").agg(F.count("*").alias("rows")).filter("rows > 1 and doc_id is not null").select("doc_id")
    doubtful = id_filter(gone.unionByName(again), "doc_id")
    safe = rows_in_filter(docs, doubtful, "doc_id", inside=False)
    first = F.row_number().over(Window.partitionBy("doc_id").orderBy("text"))
    left = rows_in_filter(docs, doubtful, "doc_id").join(gone, "doc_id", "left_anti").withColumn("__first", first).filter("__first = 1").drop("__first")
    return safe.unionByName(left.select(*docs.columns))
