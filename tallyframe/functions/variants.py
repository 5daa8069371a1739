"""JSON documents as variants: parsed once, kept so in Parquet, and searched at any depth.

A variant keeps the members of an object in the order of their names, and of two members of one name it
takes none. The first match of a search follows the order of the document. So every name gets its place in the document
as a prefix of fixed width before the text is parsed: the order of names is then the order of the document, and equal names differ.
The prefix is taken off wherever a name or the text of an object leaves these functions.

A document stays in its row while it is searched: a step opens all objects and lists of a level, by casts to maps and lists of
variants, so there is no shuffle and no text is parsed again (but for texts inside a document that are JSON themselves,
which are parsed when they are met). Fields wanted by name are data: a node's name is tested against a hash set, and
joined to the catalogue, so a node costs the same for ten fields and for a thousand.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.functions.text import fold_accents, fold_name, list_like, loose_items

#: Digits of a name's place. A document with more tokens than that has no place for its names and counts as broken.
WIDTH = 9
#: The parts of a JSON text: a string with the colon that makes it a name, what is between strings, and a quote that nothing closes.
TOKENS = r'(?s)"(?:[^"\\]|\\.)*+"\s*+:?|[^"]++|"'
PLACED_NAME = r'(?s)"[0-9]{%d}((?:[^"\\]|\\.)*+":)' % WIDTH

MEMBER = "struct<place:int,key:string,value:variant>"
NODE = "struct<path:array<int>,key:string,value:variant>"


@dataclass(frozen=True)
class Field:
    """A wanted value: the column it fills, names it may have in a document (best first, whole and without regard to
    case or accents), and whether a name that only ends with the last of them will do."""

    column: str
    names: tuple[str, ...]
    by_ending: bool = False


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is worked out once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def looks_nested(text: Column) -> Column:
    return F.substring(F.ltrim(text), 1, 1).isin("{", "[")


def _placed(text: Column) -> Column:
    """JSON text with every name's place in front of it."""

    def with_place(token: Column, i: Column) -> Column:
        place = F.lpad(i.cast("string"), WIDTH, "0")
        is_name = F.startswith(token, F.lit('"')) & F.endswith(token, F.lit(":"))
        return F.when(is_name, F.concat(F.lit('"'), place, F.substring(token, F.lit(2), F.length(token)))).otherwise(token)

    return F.array_join(F.transform(F.regexp_extract_all(text, F.lit(TOKENS), F.lit(0)), with_place), "")


def parsed(text: Column) -> Column:
    """A document: struct of ``tree``, the variant, and ``opens``, how many objects and lists it can hold at most.

    The tree of a text that is no JSON is null.
    """
    opens = F.coalesce(F.length(text) - F.length(F.translate(text, "{[", "")), F.lit(0))
    return F.struct(F.try_parse_json(_placed(text)).alias("tree"), opens.alias("opens"))


def with_document(df: DataFrame, json_col: str, out: str = "document") -> DataFrame:
    """Add the parsed document of a JSON text column. The column can be written to Parquet and searched from there."""
    return df.withColumn(out, parsed(F.col(json_col)))


def members(v: Column) -> Column:
    """place, key and value of what an object or list holds, in document order; keys of a list's items are null. A text that is
    JSON itself is opened too. Null for any other plain value."""

    def of_tree(tree: Column, otherwise: Column) -> Column:
        by_name = F.try_variant_get(tree, "$", "map<string,variant>")
        items = F.try_variant_get(tree, "$", "array<variant>")
        named = F.transform(
            F.map_entries(by_name),
            lambda e: F.struct(F.substring(e["key"], 1, WIDTH).cast("int").alias("place"), F.substring(e["key"], F.lit(WIDTH + 1), F.length(e["key"])).alias("key"), e["value"].alias("value")),
        )
        listed = F.transform(items, lambda v, i: F.struct(i.alias("place"), F.lit(None).cast("string").alias("key"), v.alias("value")))
        return F.coalesce(named.cast(f"array<{MEMBER}>"), listed.cast(f"array<{MEMBER}>"), otherwise)

    none = F.lit(None).cast(f"array<{MEMBER}>")
    text = F.try_variant_get(v, "$", "string")
    inside = once(text, lambda t: F.when(looks_nested(t), once(F.try_parse_json(_placed(t)), lambda tree: of_tree(tree, none))))
    return of_tree(v, inside)


def is_container(v: Column) -> Column:
    return F.try_variant_get(v, "$", "map<string,variant>").isNotNull() | F.try_variant_get(v, "$", "array<variant>").isNotNull()


def text_of(v: Column) -> Column:
    """A value as text: a plain one as it is, an object or list as JSON with its names as they were."""
    text = F.try_variant_get(v, "$", "string")
    return once(text, lambda t: F.when(looks_nested(t) & is_container(v), F.regexp_replace(t, PLACED_NAME, '"$1')).otherwise(t))


def _steps(start: Column, times: Column, step: Callable[[Column], Column]) -> Column:
    """``step`` over ``start``, once and then as often as ``times`` says beyond that."""
    return F.aggregate(F.sequence(F.lit(1), F.greatest(times, F.lit(1))), start, lambda state, _: step(state))


def _all_nodes(document: Column, kept: Callable[[Column], Column]) -> Column:
    """Named, non-null nodes of all levels that ``kept`` takes by their name."""
    none = F.array().cast(f"array<{NODE}>")

    def below(node: Column) -> Column:
        return F.transform(
            F.coalesce(members(node["value"]), F.array().cast(f"array<{MEMBER}>")),
            lambda m: F.struct(F.concat(node["path"], F.array(m["place"])).alias("path"), m["key"].alias("key"), m["value"].alias("value")),
        )

    def deeper(state: Column) -> Column:
        level = F.filter(F.flatten(F.transform(state["open"], below)), lambda n: ~F.is_variant_null(n["value"]))
        found = once(level, lambda new: F.struct(F.concat(state["found"], F.filter(new, lambda n: n["key"].isNotNull() & kept(n["key"]))).alias("found"), new.alias("open")))
        return F.when(F.size(state["open"]) == 0, state).otherwise(found)

    root = F.struct(F.array().cast("array<int>").alias("path"), F.lit(None).cast("string").alias("key"), document["tree"].alias("value"))
    start = F.struct(none.alias("found"), F.when(document["tree"].isNull(), none).otherwise(F.array(root).cast(f"array<{NODE}>")).alias("open"))
    # A level more than there are containers: the last one holds plain values.
    return _steps(start, document["opens"] + 1, deeper)["found"]


def with_nodes(df: DataFrame, document: str, out: str = "nodes", kept: Callable[[Column], Column] | None = None) -> DataFrame:
    """Add the named, non-null values of a document at every depth, in match order: what an object holds itself before what its
    children hold, then by place. An entry has holder, position, key, folded (no case, no accents), value (text) and item (variant).

    ``kept`` says of a key which entries are wanted; others are left out before their values become text.
    """
    nodes = _all_nodes(F.col(document), kept or (lambda key: F.lit(True)))

    def ranked(found: Column) -> Column:
        # Variants have no order, so what is sorted are places.
        places = F.transform(found, lambda n, i: F.struct(F.slice(n["path"], F.lit(1), F.size(n["path"]) - 1).alias("holder"), F.element_at(n["path"], -1).alias("position"), i.alias("i")))
        return F.transform(F.array_sort(places), lambda p: once(F.get(found, p["i"]), lambda n: entry(p, n)))

    def entry(place: Column, n: Column) -> Column:
        return F.struct(
            place["holder"].alias("holder"), place["position"].alias("position"), n["key"].alias("key"), fold(n["key"]).alias("folded"),
            text_of(n["value"]).alias("value"), n["value"].alias("item"),
        )

    # One array per row through a generator: filters on found values stay above it, so the documents are opened once.
    return df.select("*", F.explode(F.array(once(nodes, ranked))).alias(out))


def fold(name: Column) -> Column:
    return F.lower(fold_accents(name))


def first_plain(v: Column, opens: Column) -> Column:
    """The first plain value inside a variant at any depth, as text, in document order; null if there is none.

    A list of what is still to be looked at starts with the value; each step opens its first entry in place, until that is plain.
    """

    def plain_text(x: Column) -> Column:
        return F.when(~is_container(x), once(F.try_variant_get(x, "$", "string"), lambda t: F.when(~looks_nested(t), t)))

    def opened(waiting: Column, inside: Column) -> Column:
        known = F.filter(F.transform(inside, lambda m: m["value"]), lambda x: ~F.is_variant_null(x))
        rest = F.slice(waiting, F.lit(2), F.greatest(F.size(waiting) - 1, F.lit(0)))
        return F.struct(F.concat(known, rest).alias("waiting"), F.lit(False).alias("done"))

    def open_first(state: Column) -> Column:
        waiting = state["waiting"]
        done = F.struct(waiting.alias("waiting"), F.lit(True).alias("done"))
        step = once(members(F.get(waiting, F.lit(0))), lambda inside: F.when(inside.isNull(), done).otherwise(opened(waiting, inside)))
        return F.when(state["done"], state).otherwise(step)

    start = F.struct(F.array(v).alias("waiting"), F.lit(False).alias("done"))
    search = once(F.get(_steps(start, opens, open_first)["waiting"], F.lit(0)), plain_text)
    return once(plain_text(v), lambda t: F.coalesce(t, search))


def listed(v: Column, opens: Column) -> Column:
    """The texts of a list: of each item that has one, its first plain value. A text that is a JSON list or only looks like one is
    a list too, the latter cut at its commas. Null for any other value."""
    text = F.try_variant_get(v, "$", "string")
    own = F.try_variant_get(v, "$", "array<variant>")
    inside = F.try_variant_get(F.try_parse_json(_placed(text)), "$", "array<variant>")
    items = F.coalesce(own, F.when(F.startswith(F.ltrim(text), F.lit("[")), inside))
    plain = once(items, lambda i: F.filter(F.transform(i, lambda x: first_plain(x, opens)), lambda t: t.isNotNull()))
    return F.coalesce(plain, F.when(list_like(text) & ~is_container(v), loose_items(text)))


def catalogue(spark: SparkSession, fields: Iterable[Field]) -> DataFrame:
    """Wanted fields as data: name (folded), by_ending, column, rank. Whole names of a field rank in their order, its ending behind them."""
    rows = []
    for f in fields:
        names = list(dict.fromkeys(map(fold_name, f.names)))
        rows += [(name, False, f.column, rank) for rank, name in enumerate(names)]
        if f.by_ending:
            rows.append((fold_name(f.names[-1]), True, f.column, len(f.names)))
    return spark.createDataFrame(rows, "name string, by_ending boolean, column string, rank int")


def _wanted_names(folded: Column, fields: Sequence[Field]) -> Column:
    """The catalogue's names that a folded name is or ends with. Endings are cut at the catalogue's lengths and looked up in a hash
    set, which is the same as a search in an index of reversed names."""
    whole = sorted({fold_name(n) for f in fields for n in f.names})
    endings = sorted({fold_name(f.names[-1]) for f in fields if f.by_ending})
    lengths = sorted({len(e) for e in endings})

    def entry(name: Column, by_ending: bool) -> Column:
        return F.struct(name.alias("name"), F.lit(by_ending).alias("by_ending"))

    as_whole = F.when(folded.isin(whole), F.array(entry(folded, False))).otherwise(F.array().cast("array<struct<name:string,by_ending:boolean>>"))
    if not endings:
        return as_whole
    tails = F.transform(F.filter(F.array(*map(F.lit, lengths)), lambda n: n < F.length(folded)), lambda n: F.substring(folded, -n, n))
    return F.concat(as_whole, F.transform(F.filter(tails, lambda t: t.isin(endings)), lambda t: entry(t, True)))


def wants(fields: Sequence[Field]) -> Callable[[Column], Column]:
    """Which keys ``fields`` want, for ``with_nodes``."""
    return lambda key: F.size(_wanted_names(fold(key), fields)) > 0


def found_fields(df: DataFrame, nodes: str, keep: Sequence[str], fields: Sequence[Field]) -> DataFrame:
    """One row per wanted value in a document's nodes: the ``keep`` columns, column, rank, position (in match order), value (text), item (variant).

    A node's names meet the catalogue in a join, whose small side Spark measures.
    """
    rows = df.select(*keep, F.posexplode(nodes).alias("position", "__n"))
    names = F.explode(_wanted_names(F.col("__n.folded"), fields)).alias("__w")
    rows = rows.select(*keep, "position", F.col("__n.value").alias("value"), F.col("__n.item").alias("item"), names)
    rows = rows.select(*keep, "position", "value", "item", F.col("__w.name").alias("__name"), F.col("__w.by_ending").alias("__by_ending"))
    wanted = catalogue(df.sparkSession, fields).withColumnsRenamed({"name": "__name", "by_ending": "__by_ending"})
    return rows.join(wanted, ["__name", "__by_ending"]).select(*keep, "column", "rank", "position", "value", "item")


def wanted_fields(df: DataFrame, document: str, keep: Sequence[str], fields: Sequence[Field]) -> DataFrame:
    """``found_fields`` of a parsed document: values that nobody wants are left out while it is open, before they become text."""
    nodes = with_nodes(df, document, "__nodes", wants(fields))
    return found_fields(nodes, "__nodes", keep, fields)
