"""What is known about a row from many other tables, declared as data.

A wide job brings dozens of single values to a fact: the newest row of some kind, a sum, a flag. Each is declared as a
``Side``: its table, the key by which the fact meets it, and how one value per key is made. ``gather`` works out all of them
with one pass over each table and one join per key: the tables of a key are narrowed to entries, put under each other,
shuffled once and aggregated together, so a further value costs a column and neither a scan nor a join.

An aggregate combines on the map side, so a key that holds a third of a table sends one row per task. Many values of one table make
entries several times as wide as its rows; there the rows are shuffled as they are, and entries are made and aggregated where they arrive.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.functions.numbers import sum_money


@dataclass(frozen=True)
class Pick:
    """Columns of the newest (or oldest) row of a key by ``order``, nulls counting as oldest (as newest)."""

    columns: Mapping[str, Column]
    order: Sequence[Column]
    oldest: bool = False

    def entry(self) -> Column:
        rank = [x for c in self.order for x in ((c.isNull(), c) if self.oldest else (c,))]
        return F.struct(F.struct(*[c.alias(f"o{i}") for i, c in enumerate(rank)]).alias("rank"), F.struct(*[c.alias(n) for n, c in self.columns.items()]).alias("row"))

    def merged(self, entry: Column) -> Column:
        best = F.min(entry) if self.oldest else F.max(entry)
        return best["row"]

    def out(self, value: Column) -> list[Column]:
        return [value[n].alias(n) for n in self.columns]


@dataclass(frozen=True)
class Value:
    """One aggregate of a column: ``max``, ``min`` or ``sum`` (of money), ``count`` of rows, ``exists``."""

    name: str
    how: str
    column: Column | None = None

    def entry(self) -> Column:
        return F.lit(True) if self.column is None else self.column

    def merged(self, entry: Column) -> Column:
        makers = {"max": F.max, "min": F.min, "sum": sum_money, "count": F.count, "exists": F.max}
        return makers[self.how](entry)

    def out(self, value: Column) -> list[Column]:
        if self.how == "count":
            value = F.coalesce(value, F.lit(0).cast("long"))
        if self.how == "exists":
            value = F.coalesce(value, F.lit(False))
        return [value.alias(self.name)]


@dataclass(frozen=True)
class Listing:
    """The distinct texts of a key in order, as one text. For tables with few rows per key, such as one per kind."""

    name: str
    item: Column
    sep: str = ", "

    def entry(self) -> Column:
        return self.item

    def merged(self, entry: Column) -> Column:
        return F.array_join(F.sort_array(F.collect_set(entry)), self.sep)

    def out(self, value: Column) -> list[Column]:
        return [F.when(value != "", value).alias(self.name)]


@dataclass(frozen=True)
class Side:
    """A value per key of ``table``: ``on`` maps columns of the fact to expressions over the table, ``where`` chooses its rows."""

    table: str
    on: Mapping[str, str]
    make: Pick | Value | Listing
    where: Column | None = None


#: From so many values of a single table on, its rows are shuffled instead of their entries.
WIDE = 8


def _entries(table: DataFrame, keys: Sequence[str], sides: Sequence[tuple[int, Side]]) -> DataFrame:
    """A table as its keys and one entry per side, without rows that no side wants and without null keys."""
    if all(s.where is not None for _, s in sides):
        table = table.filter(reduce(lambda a, b: a | b, [s.where for _, s in sides]))
    chosen = [(s.make.entry() if s.where is None else F.when(s.where, s.make.entry())).alias(f"__e{i}") for i, s in sides]
    rows = table.select(*[F.expr(k).alias(f"__k{n}") for n, k in enumerate(keys)], *chosen)
    return rows.dropna(subset=[f"__k{n}" for n in range(len(keys))])


def gathered(tables: Mapping[str, DataFrame], sides: Sequence[Side]) -> DataFrame:
    """One row per key with all values of ``sides``, which share one key of the fact: key columns ``__k0``, ... and the values."""
    by_table: dict[tuple[str, tuple[str, ...]], list[tuple[int, Side]]] = {}
    for i, s in enumerate(sides):
        by_table.setdefault((s.table, tuple(s.on.values())), []).append((i, s))
    if len(by_table) == 1 and len(sides) >= WIDE:
        (name, keys), = by_table
        tables = {name: tables[name].repartition(*[F.expr(k) for k in keys])}
    parts = [_entries(tables[name], keys, own) for (name, keys), own in by_table.items()]
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    names = [c for c in rows.columns if c.startswith("__k")]
    return rows.groupBy(*names).agg(*[s.make.merged(F.col(f"__e{i}")).alias(f"__v{i}") for i, s in enumerate(sides)])


def gather(fact: DataFrame, tables: Mapping[str, DataFrame], sides: Sequence[Side]) -> DataFrame:
    """``fact`` with the values of all sides: one pass per table and key, one join per key of the fact.

    Fact rows without a match keep nulls (0 for counts, false for flags). A side may use a column that an earlier side brings as
    its key; it is worked out after it.
    """
    by_key: dict[tuple[str, ...], list[Side]] = {}
    for s in sides:
        by_key.setdefault(tuple(s.on), []).append(s)
    for keys, own in by_key.items():
        values = gathered(tables, own)
        match = reduce(lambda a, b: a & b, [F.col(f"`{k}`") == F.col(f"__k{n}") for n, k in enumerate(keys)])
        outs = [c for i, s in enumerate(own) for c in s.make.out(F.col(f"__v{i}"))]
        fact = fact.join(values, match, "left").select(*[F.col(f"`{c}`") for c in fact.columns], *outs)
    return fact
