"""Values inside JSON text of unknown shape.

One document is parsed once, to a variant, and opened level by level into an array of nodes that stays in its row: no
shuffle, no Python worker, and every wanted field reads the same array. Positions are kept, so "first match" follows the
order of the document. ``variants`` has the steps, and what works on documents that are stored parsed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.functions import variants as W
from tallyframe.functions.text import fold_name
from tallyframe.functions.variants import Field, found_fields

__all__ = ["Field", "array_empty_default", "array_first_or_join", "deep_find", "first_scalar", "found_fields", "unwrap_value", "with_json_nodes"]


def with_json_nodes(df: DataFrame, json_col: str, out: str = "nodes") -> DataFrame:
    """Add the named, non-null values at every depth of a JSON text column, as ``variants.with_nodes`` does for a parsed one."""
    parsed = df.withColumn("__document", W.parsed(F.col(json_col)))
    return W.with_nodes(parsed, "__document", out).drop("__document")


def deep_find(nodes: Column, names: Sequence[str], match: str = "exact") -> Column:
    """First value under any of ``names`` anywhere in the document.

    ``match``: ``exact`` name, ``folded`` (no case, no accents), or ``suffix`` (folded
    name ends with the wanted one). Names are tried in the given order.
    """
    if match not in ("exact", "folded", "suffix"):
        raise ValueError(f"unknown match {match!r}")

    def first(name: str) -> Column:
        wanted = F.lit(name if match == "exact" else fold_name(name))

        def hit(n: Column) -> Column:
            if match == "exact":
                return n["key"] == wanted
            return n["folded"] == wanted if match == "folded" else F.endswith(n["folded"], wanted)

        return F.get(F.filter(nodes, hit), F.lit(0))["value"]

    return F.coalesce(*[first(name) for name in names])


def first_scalar(text: Column) -> Column:
    """The first plain value inside JSON text at any depth, in document order; plain text is itself."""
    inside = W.once(W.parsed(text), lambda d: W.first_plain(d["tree"], d["opens"]))
    return F.when(W.looks_nested(text), inside).otherwise(text)


def unwrap_value(value: Column) -> Column:
    """A found value without nesting: an object becomes its first plain value, a list the
    list of the first plain value of each item; anything else stays."""
    start = F.ltrim(value)

    def each(d: Column) -> Column:
        items = F.try_variant_get(d["tree"], "$", "array<variant>")
        return F.to_json(F.filter(F.transform(items, lambda v: W.first_plain(v, d["opens"])), lambda v: v.isNotNull()))

    return (
        F.when(start.startswith("{"), first_scalar(value))
        .when(start.startswith("["), F.coalesce(W.once(W.parsed(value), each), value))
        .otherwise(value)
    )


def array_first_or_join(c: Column, first_only: bool = False, sep: str = ", ") -> Column:
    """First element, or all non-null elements joined; null for an empty array."""
    kept = F.filter(c, lambda x: x.isNotNull())
    if first_only:
        return F.get(kept, F.lit(0)).cast("string")
    texts = F.transform(kept, lambda x: x.cast("string"))
    return F.when(F.size(kept) > 0, F.array_join(texts, sep))


def array_empty_default(c: Column, default: str = "0") -> Column:
    """An empty array becomes ``default``, any other its JSON text."""
    return F.when(F.size(c) == 0, F.lit(default)).otherwise(F.to_json(c))
