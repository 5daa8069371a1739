"""Mixing sources to target weights as a flow of least cost.

Documents may belong to several sources. Those with the same set of sources (a membership pattern) are one
supply: so many words, which may be used up to ``most`` times, each further time at a higher cost. Sources are the
demands: their quotas. The flow from patterns to sources is solved on the driver over patterns and sources alone;
it says how many words of each pattern the mix takes. Which documents these are follows from a seeded hash: all
documents of a pattern are taken so many whole times, and the remainder goes to those that come first in hash order. A document
larger than what is left is skipped, and the next ones that fit are taken, until nothing fits.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.llm.base import settle

#: Weights given to sources in order of their names, over and over.
WEIGHTS = (5, 2, 1)
#: How often a document can be used.
MOST = 3
#: Most patterns and most sources that one mix may have; more is an error, not a cut.
MOST_PATTERNS = 2_000
SEED = 11
#: Bits of the hash that one pass over the documents resolves, of so many.
STEP = 10
BITS = 60


@dataclass
class _Edge:
    to: int
    room: float
    cost: float
    back: int


class Network:
    """Least-cost flow by shortest augmenting paths. Small: nodes are patterns and sources."""

    def __init__(self, n: int) -> None:
        self.edges: list[list[_Edge]] = [[] for _ in range(n)]

    def join(self, a: int, b: int, room: float, cost: float) -> _Edge:
        there, back = _Edge(b, room, cost, len(self.edges[b])), _Edge(a, 0.0, -cost, len(self.edges[a]))
        self.edges[a].append(there)
        self.edges[b].append(back)
        return there

    def push(self, source: int, sink: int, least: float = 1e-6) -> None:
        """Send as much as fits, each time along the cheapest path."""
        while True:
            cost, via = {source: 0.0}, {}
            queue = [source]
            waiting = {source}
            for a in queue:
                waiting.discard(a)
                for k, e in enumerate(self.edges[a]):
                    if e.room > least and cost[a] + e.cost < cost.get(e.to, 1e300) - 1e-12:
                        cost[e.to], via[e.to] = cost[a] + e.cost, (a, k)
                        if e.to not in waiting:
                            queue.append(e.to)
                            waiting.add(e.to)
            if sink not in via:
                return
            path, at = [], sink
            while at != source:
                a, k = via[at]
                path.append(self.edges[a][k])
                at = a
            amount = min(e.room for e in path)
            for e in path:
                e.room -= amount
                self.edges[e.to][e.back].room += amount


def targets(sizes: dict, weights: dict, total: float | None = None, most: int = MOST) -> dict:
    """Words each source should give: shares of ``total`` (all words) by weight, none above ``most`` times its size.

    What a source cannot give is shared again by weight among those that still can. If none can, less is taken.
    """
    left = float(sum(sizes.values()) if total is None else total)
    found: dict = {}
    free = {s for s in sizes if weights[s] > 0}
    while free:
        share = left / sum(weights[s] for s in free)
        over = {s for s in free if share * weights[s] > most * sizes[s]}
        if not over:
            return {s: 0.0 for s in sizes} | found | {s: share * weights[s] for s in free}
        for s in over:
            found[s] = float(most * sizes[s])
            left -= found[s]
        free -= over
    return {s: 0.0 for s in sizes} | found


def flow(patterns: dict[tuple, int], quotas: dict, most: int = MOST) -> dict[tuple, float]:
    """Words to take of each pattern: quotas are met as far as possible, at least cost of repetition.

    The n-th use of a pattern costs n; so words are used once before any is used twice, as the quotas allow. Documents
    of fewer sources are preferred at equal cost, which leaves those of several sources free for any of them.
    """
    names, keys = list(quotas), list(patterns)
    place = {s: 1 + len(keys) + i for i, s in enumerate(names)}
    sink = 1 + len(keys) + len(names)
    net = Network(sink + 1)
    used = []
    for i, key in enumerate(keys):
        used.append([net.join(0, 1 + i, float(patterns[key]), float(n + 1)) for n in range(most)])
        for s in key:
            net.join(1 + i, place[s], float(most * patterns[key]), 0.01 * (len(key) - 1))
    for s in names:
        net.join(place[s], sink, float(quotas[s]), 0.0)
    net.push(0, sink)
    return {key: sum(patterns[key] - e.room for e in edges) for key, edges in zip(keys, used, strict=True)}


def words(text: Column) -> Column:
    """Words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _top() -> Column:
    """A row's place as a number of ``BITS`` bits, never negative."""
    return F.shiftrightunsigned(F.col("place"), 64 - BITS)


def _cut(rows: DataFrame, wanted: list[tuple[str, int, int]]) -> dict[str, tuple[int, int, int | None]]:
    """Per pattern, with words wanted and a first place: the place up to which all documents from there that are no larger than
    the words wanted stay within them together, those words, and where to go on behind the document that exceeds (None: nothing does).

    The range that holds the cut gets narrower by ``STEP`` bits a pass, until it holds one document; each pass sums words per
    pattern and part of its range, before the shuffle. The driver keeps one row per pattern.
    """
    state = {p: (want, low, 0) for p, want, low in wanted}
    cuts: dict[str, tuple[int, int, int | None]] = {}
    for done in range(STEP, BITS + STEP, STEP):
        if not state:
            break
        width = 1 << (BITS - done)
        now = rows.sparkSession.createDataFrame([(p, *x) for p, x in state.items()], "pattern string, want long, low long, got long")
        inside = (F.col("size") <= F.col("want")) & (_top() >= F.col("low")) & (_top() < F.col("low") + width * (1 << STEP))
        part = F.shiftright(_top() - F.col("low"), BITS - done)
        sums = rows.join(F.broadcast(now), "pattern").filter(inside).groupBy("pattern", "want", "got", part.alias("part"))
        upto = Window.partitionBy("pattern").orderBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        # At most 2 ** STEP rows per pattern.
        sums = sums.agg(F.sum("size").alias("size"), F.count("*").alias("rows")).withColumn("after", F.col("got") + F.sum("size").over(upto))
        over = F.col("after") > F.col("want")
        stop = F.min(F.when(over, F.struct("part", "rows"))).alias("stop")
        met = {r.pattern: r for r in sums.groupBy("pattern").agg(stop, F.max(F.when(~over, F.col("after"))).alias("within")).collect()}
        for p, (want, low, got) in list(state.items()):
            r = met.get(p)
            got = max(got, (r and r.within) or 0)
            if r is None or r.stop is None:  # nothing exceeds, so the whole range is within
                cuts[p] = (1 << BITS, got, None)
                del state[p]
                continue
            low += r.stop.part * width
            state[p] = (want, low, got)
            if r.stop.rows == 1 or width == 1:  # one document, larger than what is left; or rows of one place, which go together
                cuts[p] = (low, got, low if r.stop.rows == 1 else low + 1)
                del state[p]
    return cuts


def _more_uses() -> Column:
    """Uses of a row beyond the whole ones: one for each span that holds its place and sizes like its own."""
    return F.size(F.filter("spans", lambda s: (_top() >= s["low"]) & (_top() < s["high"]) & (F.col("size") <= s["largest"]))).cast("long")


def _spans(rows: DataFrame, wanted: dict[str, int], rounds: dict[str, int]) -> dict[str, list[tuple[int, int, int]]]:
    """Per pattern the spans (first place, place behind the last, largest size) whose documents are used once more.

    A span ends before a document larger than what is left; the next goes on behind it with those no larger, so each ends
    with less left than the size it stopped at. What is left at the last place is filled from the first one again, as ``rounds`` allow; the
    documents that still fit have then all been used equally often. In the end no document fits, whatever number of spans that takes.
    """
    spans: dict[str, list[tuple[int, int, int]]] = {p: [] for p in wanted}
    todo = {p: (want, 0, rounds[p], False) for p, want in wanted.items() if want > 0 and rounds[p] > 0}
    while todo:
        cuts = _cut(rows, [(p, left, low) for p, (left, low, _, _) in todo.items()])
        for p, (left, low, more, used) in list(todo.items()):
            high, got, behind = cuts[p]
            if got:
                spans[p].append((low, high, left))
            left, used = left - got, used or got > 0
            if behind is None:
                more, used, ended = more - 1, False, not used
                behind = 0
            else:
                ended = False
            todo[p] = (left, behind, more, used)
            if ended or left <= 0 or more <= 0:
                del todo[p]
    return spans


def pattern(sources: Column) -> Column:
    """A set of sources as one text: names marked s, the missing name as t; null for no sources."""
    names = F.array_sort(F.array_distinct(F.transform(sources, lambda s: F.coalesce(F.concat(F.lit("s"), s), F.lit("t")))))
    return F.when(F.size(names) > 0, F.to_json(names))


def _placed(docs: DataFrame) -> DataFrame:
    """Sizes without nulls, the pattern of the sources, and a place in a fixed order: a seeded hash of id and size."""
    size = F.coalesce(F.col("size"), F.lit(0)).cast("long")
    return docs.withColumn("size", size).withColumn("pattern", pattern(F.col("sources"))).withColumn("place", F.xxhash64("doc_id", "size", F.lit(SEED)))


@dataclass(frozen=True)
class Plan:
    """What a mix takes. ``rules``: per pattern how many whole times its documents are used, and the spans of places and sizes
    in which they are used once more. ``quotas``: (source, its words, its target)."""

    rules: list[tuple[str, int, list[tuple[int, int, int]]]]
    quotas: list[tuple[str | None, int, float]]

    def apply(self, docs: DataFrame) -> DataFrame:
        """``docs`` (doc_id, size, sources and any others) with pattern and times (uses of each row), without a shuffle."""
        spark = docs.sparkSession
        rules = spark.createDataFrame(self.rules, "pattern string, whole long, spans array<struct<low: long, high: long, largest: long>>")
        rows = _placed(docs).join(F.broadcast(rules), "pattern", "left")  # at most MOST_PATTERNS rules
        times = F.when(F.col("size") > 0, F.col("whole") + _more_uses())
        return rows.withColumn("times", F.coalesce(times, F.lit(0))).drop("place", "whole", "spans")


def plan(docs: DataFrame, weights=None, most: int = MOST, total: float | None = None) -> Plan:
    """How a mix uses documents (doc_id, size in words, sources: array of names; null stands for the missing name).

    ``weights`` gives each source's weight; by default ``WEIGHTS`` in order of names by code point, null last. A document is
    used a whole number of times, at most ``most``, so the words taken are a multiple of its size. Rows without sources
    and those of size 0 are not used. Repeated rows are documents of their own with one place in the order, and are used
    alike. Other columns do not matter. Without rows there are no rules and no quotas.

    Hot patterns cost no more than others: sums are made per task first, and nothing sorts the documents of a pattern.
    """
    rows = settle(_placed(docs.select("doc_id", "size", "sources")).select("pattern", "size", "place"), "sizes")
    # Bounded: one row per pattern, checked.
    got = rows.filter("pattern is not null").groupBy("pattern").agg(F.sum("size").alias("size")).limit(MOST_PATTERNS + 1).collect()
    if len(got) > MOST_PATTERNS:
        raise ValueError(f"more than {MOST_PATTERNS} membership patterns")
    text = {tuple(json.loads(r.pattern)): r.pattern for r in got}
    sizes = {tuple(json.loads(r.pattern)): int(r.size) for r in got}
    sources = sorted({s for key in sizes for s in key}, key=lambda s: (s[0] == "t", s))
    by_source = {s: sum(n for key, n in sizes.items() if s in key) for s in sources}
    share = {s: WEIGHTS[i % len(WEIGHTS)] if weights is None else weights[s[1:] if s[0] == "s" else None] for i, s in enumerate(sources)}
    quota = targets(by_source, share, sum(sizes.values()) if total is None else total, most)
    taken = flow(sizes, quota, most)
    whole = {key: min(most, int(taken[key] // n + 1e-9)) if n else 0 for key, n in sizes.items()}
    wanted = {text[key]: max(0, round(taken[key] - whole[key] * n)) for key, n in sizes.items()}
    quotas = [(s[1:] if s[0] == "s" else None, by_source[s], quota[s]) for s in sources]
    spans = _spans(rows.filter("size > 0"), wanted, {text[key]: most - n for key, n in whole.items()})
    return Plan([(text[key], whole[key], spans[text[key]]) for key in sizes], quotas)


def mix_documents(docs: DataFrame) -> tuple[DataFrame, Plan]:
    """Documents (text, source) that belong to the one source they name, with size, pattern and times; and the plan."""
    sized = docs.withColumn("size", words(F.col("text"))).withColumn("sources", F.array("source"))
    made = plan(sized)
    return made.apply(sized).drop("sources"), made
