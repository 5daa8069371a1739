"""Approximate nearest neighbours on robust-pruned directed graphs, one per shard.

A shard's graph is built by inserting its vectors in batches: a greedy beam search on the graph so far proposes
neighbours (all places it visited), and relaxed distance pruning keeps those that no kept neighbour is clearly nearer to, so
edges stay diverse. Edges are added back from the neighbours, which are pruned again when full. A search is the same beam
search from the shard's most central vector; results of all shards are merged by exact distance.

Equal vectors are one node with the smallest ids that any query can need, so a very common vector costs one node.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.llm.base import settle

#: Vectors of a shard, about. Larger shards make fewer searches per query and longer builds.
SHARD_ROWS = 8192
#: Queries that meet one copy of a shard.
QUERY_ROWS = 8192
#: Out-edges of a node, places a beam holds while building and searching, places expanded at once.
DEGREE = 32
BEAM = 64
SEARCH_BEAM = 128
WIDTH = 4
#: A candidate is dropped when a kept neighbour is nearer to it than the node is, by this factor.
RELAX = 1.2
#: Most nodes inserted at once, as a share of the shard.
BATCH_SHARE = 0.04
RUN = 128


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of ``a`` (n, d) to ``b`` (n, m, d)."""
    diff = b - a[:, None, :]
    return np.einsum("nmd,nmd->nm", diff, diff)


def _unique_by_distance(ids: np.ndarray, dist: np.ndarray, keep: int, *flags: np.ndarray):
    """Per row the ``keep`` nearest distinct ids, nearest first; -1 marks no id. Of equal ids the first stays."""
    order = np.argsort(ids, axis=1, kind="stable")
    ranked = np.take_along_axis(ids, order, 1)
    again = np.zeros(ids.shape, bool)
    np.put_along_axis(again, order[:, 1:], (ranked[:, 1:] == ranked[:, :-1]), 1)
    dist = np.where(again | (ids < 0), np.inf, dist)
    order = np.argsort(dist, axis=1, kind="stable")[:, :keep]
    dist = np.take_along_axis(dist, order, 1)
    ids = np.where(np.isinf(dist), -1, np.take_along_axis(ids, order, 1))
    return ids, dist, *(np.take_along_axis(f, order, 1) for f in flags)


def beam_search(vectors: np.ndarray, edges: np.ndarray, entry: int, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For many queries at once: the beam's ids and squared distances, nearest first, and all visited places."""
    n = len(queries)
    ids = np.full((n, 1), entry, np.int64)
    dist = _distances(queries, vectors[ids])
    open_ = np.ones((n, 1), bool)
    seen_ids, seen_dist = [], []
    rows = np.arange(n)
    while True:
        rank = np.cumsum(open_, axis=1)
        chosen = open_ & (rank <= WIDTH)
        if not chosen.any():
            break
        at = np.argsort(~chosen, axis=1, kind="stable")[:, :WIDTH]
        picked = np.take_along_axis(chosen, at, 1)
        now = np.where(picked, np.take_along_axis(ids, at, 1), -1)
        seen_ids.append(now)
        seen_dist.append(np.where(picked, np.take_along_axis(dist, at, 1), np.inf))
        open_ &= ~chosen
        live = rows[picked.any(axis=1)]
        found = edges[now[live]]
        found[now[live] < 0] = -1
        found = found.reshape(len(live), -1)
        far = np.full(found.shape, np.inf)
        r, c = np.nonzero(found >= 0)
        diff = vectors[found[r, c]] - queries[live[r]]
        far[r, c] = np.einsum("nd,nd->n", diff, diff)
        a = np.concatenate([ids[live], found], axis=1)
        b = np.concatenate([dist[live], far], axis=1)
        o = np.concatenate([open_[live], np.ones(found.shape, bool)], axis=1)
        a, b, o = _unique_by_distance(a, b, beam, o)
        if a.shape[1] > ids.shape[1]:
            grow = a.shape[1] - ids.shape[1]
            ids = np.pad(ids, ((0, 0), (0, grow)), constant_values=-1)
            dist = np.pad(dist, ((0, 0), (0, grow)), constant_values=np.inf)
            open_ = np.pad(open_, ((0, 0), (0, grow)))
        w = a.shape[1]
        ids[live, :w], dist[live, :w], open_[live, :w] = a, b, o & (a >= 0)
    return ids, dist, np.concatenate(seen_ids, axis=1), np.concatenate(seen_dist, axis=1)


def robust_prune(vectors: np.ndarray, nodes: np.ndarray, ids: np.ndarray, degree: int, relax: float) -> np.ndarray:
    """Out-edges of each node from its candidates (-1: none): nearest first, each dropping those it is much nearer to."""
    ids = np.where(ids == nodes[:, None], -1, ids)
    dist = np.where(ids >= 0, _distances(vectors[nodes], vectors[ids]), np.inf)
    ids, dist = _unique_by_distance(ids, dist, ids.shape[1])
    own = vectors[ids]
    norm = np.einsum("nmd,nmd->nm", own, own)
    between = np.maximum(norm[:, :, None] + norm[:, None, :] - 2 * own @ own.transpose(0, 2, 1), 0)
    alive = ids >= 0
    out = np.full((len(nodes), degree), -1, np.int64)
    rows = np.arange(len(nodes))
    for k in range(degree):
        first = np.argmax(alive, axis=1)
        some = alive[rows, first]
        if not some.any():
            break
        out[some, k] = ids[some, first[some]]
        alive &= ~((relax * relax * between[rows, first] <= dist) & some[:, None])
        alive[rows, first] = False
    return out


def build(vectors: np.ndarray, degree: int = DEGREE, beam: int = BEAM, relax: float = RELAX, seed: int = 5) -> tuple[np.ndarray, int]:
    """Out-edges of every vector (-1: none) and the place where searches begin."""
    n = len(vectors)
    edges = np.full((n, degree), -1, np.int64)
    middle = vectors.mean(axis=0)
    entry = int(np.argmin(np.einsum("nd,nd->n", vectors - middle, vectors - middle)))
    order = np.random.default_rng(seed).permutation(n)
    order = order[order != entry]
    done = 0
    while done < len(order):
        batch = order[done : done + max(1, min(done + 1, int(BATCH_SHARE * n) + 1))]
        done += len(batch)
        for at in range(0, len(batch), RUN):
            run = batch[at : at + RUN]
            ids, _, seen, _ = beam_search(vectors, edges, entry, vectors[run], beam)
            edges[run] = robust_prune(vectors, run, np.concatenate([ids, seen], axis=1), degree, relax)
        _add_back(vectors, edges, batch, degree, relax)
    return edges, entry


def _add_back(vectors: np.ndarray, edges: np.ndarray, batch: np.ndarray, degree: int, relax: float) -> None:
    """Edges from the new nodes' neighbours to the new nodes: appended where there is room, else the node is pruned."""
    to = edges[batch].ravel()
    new = np.repeat(batch, degree)[to >= 0]
    to = to[to >= 0]
    order = np.argsort(to, kind="stable")
    to, new = to[order], new[order]
    # Up to ``degree`` new edges per node and round; a node with more has a place in the next round too.
    while len(to):
        nodes, first, count = np.unique(to, return_index=True, return_counts=True)
        nth = np.arange(len(to)) - np.repeat(first, count)
        now = nth < degree
        row = np.repeat(np.arange(len(nodes)), count)[now]
        more = np.full((len(nodes), degree), -1, np.int64)
        more[row, nth[now]] = new[now]
        used = (edges[nodes] >= 0).sum(axis=1)
        fits = used + np.minimum(count, degree) <= degree
        easy = now & np.repeat(fits, count)
        edges[to[easy], np.repeat(used, count)[easy] + nth[easy]] = new[easy]
        full = np.flatnonzero(~fits)
        for at in range(0, len(full), RUN):
            some = full[at : at + RUN]
            edges[nodes[some]] = robust_prune(vectors, nodes[some], np.concatenate([edges[nodes[some]], more[some]], axis=1), degree, relax)
        to, new = to[~now], new[~now]


def usable(vector: Column) -> Column:
    """Whether a vector takes part: not null or empty, no null or non-finite component, not all zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _nodes(vectors: DataFrame, k: int) -> DataFrame:
    """Distinct vectors with the ``k + 1`` smallest ids that have them: more can never be among a query's nearest."""
    ids = vectors.groupBy("vector", "vec_id").agg(F.lit(1).alias("one"))
    rank = F.row_number().over(Window.partitionBy("vector").orderBy("vec_id"))
    few = ids.withColumn("rank", rank).filter(F.col("rank") <= k + 1)
    return few.groupBy("vector").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))


def build_index(vectors: DataFrame, k: int, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Every usable vector (vec_id, vector) as a node of its shard's graph: size, shard, node, vector, ids, edges, entry.

    Vectors of different length never meet. Nodes are dealt to shards by a hash, so shards are alike in size.
    """
    nodes = settle(_nodes(vectors, k).withColumn("size", F.size("vector")), "nodes")
    # Bounded: one row per length of vector.
    many = nodes.groupBy("size").agg(F.ceil(F.count("*") / shard_rows).alias("shards"))
    dealt = nodes.join(F.broadcast(many), "size").withColumn("shard", F.pmod(F.xxhash64("vector"), F.col("shards")))

    def make(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("first", ignore_index=True)
        data = np.stack(frame["vector"])
        edges, entry = build(data / max(np.abs(data).max(), 1e-300))
        return pd.DataFrame({
            "size": frame["size"], "shard": frame["shard"], "node": np.arange(len(frame)), "vector": frame["vector"], "ids": frame["ids"],
            "edges": list(edges.astype(np.int32)), "entry": np.arange(len(frame)) == entry,
        })

    types = "size int, shard long, node int, vector array<double>, ids array<long>, edges array<int>, entry boolean"
    dealt = dealt.select("size", "shard", "vector", "ids", F.col("ids")[0].alias("first"))
    return settle(dealt.groupBy("size", "shard").applyInPandas(make, types), "index")


def search(index: DataFrame, queries: DataFrame, k: int, beam: int = SEARCH_BEAM, query_rows: int = QUERY_ROWS) -> DataFrame:
    """The ``k`` nearest of each query (query_id, vector): query_id, rank, vec_id, score (Euclidean distance).

    Queries meet every shard of their length, in blocks of about ``query_rows``; a shard's rows are copied once per block,
    so a task holds one shard and one block.
    """
    queries = settle(queries.withColumn("q_size", F.size("vector")).dropDuplicates(["query_id", "vector"]), "queries")
    shards = index.select(F.col("size").alias("q_size"), F.col("shard").alias("q_shard")).distinct()
    blocks = max(1, -(-queries.count() // query_rows))
    asked = queries.withColumn("q_block", F.pmod(F.xxhash64("query_id"), F.lit(blocks).cast("long"))).join(shards, "q_size")
    held = index.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))

    def look(held: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        out = {"query_id": [], "vec_id": [], "score": []}
        if len(held) and len(asked):
            held = held.sort_values("node", ignore_index=True)
            data, edges = np.stack(held["vector"]), np.stack(held["edges"]).astype(np.int64)
            scale = max(np.abs(data).max(), 1e-300)
            entry = int(np.flatnonzero(held["entry"])[0])
            points, ids = np.stack(asked["vector"]), held["ids"].tolist()
            for at in range(0, len(asked), RUN):
                got = beam_search(data / scale, edges, entry, points[at : at + RUN] / scale, beam)[0]
                for i, near in enumerate(got):
                    near = near[near >= 0]
                    diff = data[near] - points[at + i]
                    score = np.sqrt(np.einsum("nd,nd->n", diff, diff))
                    own = int(asked["query_id"].iloc[at + i])
                    pairs = sorted((s, v) for s, node in zip(score.tolist(), near.tolist(), strict=True) for v in ids[node] if v != own)
                    for s, v in pairs[:k]:
                        out["query_id"].append(own), out["vec_id"].append(v), out["score"].append(s)
        return pd.DataFrame(out).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})

    pairs = held.groupBy("size", "shard", "block").cogroup(asked.groupBy("q_size", "q_shard", "q_block"))
    found = pairs.applyInPandas(look, "query_id long, vec_id long, score double")
    best = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return best.withColumn("rank", rank.cast("int")).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def nearest(table: DataFrame, k: int = 10, every: int = 100, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """The ``k`` nearest vectors of each row whose id is divisible by ``every``, among all other rows.

    Vectors that are null, empty, all zero, or hold a null or non-finite component take no part, nor do rows without id.
    An id on several rows counts as one candidate for each of its vectors and as one query with all of them; its nearest
    distance counts. Ties go to the smaller id. Other columns are ignored; without rows the result has none.
    """
    vector = F.transform(F.col(vector_col).cast("array<double>"), lambda x: x + F.lit(0.0))  # no negative zero
    rows = table.select(F.col(id_col).cast("long").alias("vec_id"), vector.alias("vector")).filter(F.col("vec_id").isNotNull() & usable(F.col("vector")))
    index = build_index(rows, k)
    return search(index, rows.filter(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("query_id"), "vector"), k)
