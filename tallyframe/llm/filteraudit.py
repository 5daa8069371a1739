"""Interaction of filters: what each removes under every order in which they can be applied, and what it removes on average.

Every document fails some of the filters, which is a mask. Documents of one part and mask behave alike, so the table is
reduced to cells (part, mask) with their numbers of documents, good and toxic ones. A cell is folded across the array of
all orders: an outer ``transform`` over the orders, an ``aggregate`` over the steps of one, which carries whether
the cell's documents are still there. That makes one struct per order and step, weighted by the cell's numbers; the
structs of a part's cells, of which there are at most as many as masks, are merged by elementwise sums. Everything is
a built-in expression.

The order array is a literal of the plan (5 filters have 120 orders, 600 steps), so it reaches every task with the plan.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.base import settle

#: White space beside the blank, and the characters of filter D.
OTHER_SPACE, MARKS = "\t\n\x0b\x0c\r", "#$%&*|"
#: What is counted at each step, in the order of the structs' fields.
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")


def words_of(text: Column) -> Column:
    """The words of a text. Plain replacements and a one-letter separator take half of a pattern's time."""
    for c in OTHER_SPACE:
        text = F.replace(text, F.lit(c), F.lit(" "))
    return F.array_remove(F.split(text, " "), "")


def text_filters(text: Column, words: Column) -> dict[str, Column]:
    """Filters A to D of a text that is not null and of its words, each true where the text fails."""
    n = F.size(words).cast("long")
    marked = F.lit(False)
    for c in MARKS:
        marked = marked | F.contains(text, F.lit(c))
    return {
        "A": n < 50,
        "B": F.size(F.array_distinct(words)).cast("long") * 100 < n * 65,
        "C": F.regexp_count(text, F.lit("[A-Z]")).cast("long") * 100 > F.length(text).cast("long") * 5,
        "D": marked,
    }


def mask_of(failed: Mapping[str, Column]) -> Column:
    """A bit per filter, the first one lowest."""
    bits = [F.when(c, F.lit(1 << k)).otherwise(0) for k, c in enumerate(failed.values())]
    out = bits[0]
    for b in bits[1:]:
        out = out + b
    return out


def documents_by_text(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Narrow rows doc_id, digest, part, mask of filters A to D, good, toxic and n, the number of equal ones: what the audit needs of
    ``docs`` (doc_id, text, source) and ``labels`` (doc_id, quality, toxic).

    Texts are read once and do not leave their task. Rows without an id meet no label; they are spread by their text.
    """
    spread = F.when(F.col("doc_id").isNull(), F.pmod(F.hash("digest"), F.lit(1 << 20))).otherwise(0)
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"))
    mask = _once(words_of(F.col("text")), lambda words: mask_of(text_filters(F.col("text"), words)))
    rows = rows.select("doc_id", "part", mask.alias("mask"), F.sha2("text", 256).alias("digest")).withColumn("spread", spread)
    rows = rows.groupBy("doc_id", "spread", "digest", "part", "mask").agg(F.count(F.lit(1)).alias("n"))
    known = labels.filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    known = known.agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic")).withColumn("spread", F.lit(0))
    joined = rows.join(known, ["doc_id", "spread"], "left")
    return joined.select("doc_id", "digest", "part", "mask", F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic"), "n")


def with_later_copies(rows: DataFrame, bit: int) -> DataFrame:
    """``rows`` of ``documents_by_text`` whose mask has ``bit`` too where a smaller id has the same text.

    The smallest id per text is a partial aggregate, and rows meet it by id and text, so a group of copies of any size is
    spread like other rows. A null id is smaller than none and copies none.
    """
    first = rows.filter("doc_id IS NOT NULL").groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("is_first", F.lit(True))
    joined = rows.join(first, ["doc_id", "digest"], "left")
    later = F.col("doc_id").isNotNull() & F.col("is_first").isNull()
    return joined.withColumn("mask", F.col("mask") + F.when(later, F.lit(1 << bit)).otherwise(0)).drop("is_first")


def cells(rows: DataFrame) -> DataFrame:
    """part, mask, docs, good, toxic: how many documents of a part fail just the filters of the mask."""
    n = F.col("n")
    return rows.groupBy("part", "mask").agg(F.sum(n).alias("docs"), F.sum(n * F.col("good")).alias("good"), F.sum(n * F.col("toxic")).alias("toxic"))


def folded(filters: str, mask: Column, docs: Column, good: Column, toxic: Column) -> Column:
    """One weighted struct per order of ``filters`` and step, for one cell: filter_order, step, letter and COUNTS."""
    bits = {f: 1 << k for k, f in enumerate(filters)}
    orders = F.array(*[F.struct(F.lit("".join(p)).alias("name"), F.array(*[F.lit(bits[f]) for f in p]).alias("bits")) for p in permutations(filters)])
    entry_type = f"struct<filter_order:string,step:int,letter:string,{','.join(f'{c}:bigint' for c in COUNTS)}>"
    none = F.lit(0).cast("long")

    def through(order: Column) -> Column:
        def step(state: Column, k: Column) -> Column:
            bit, there = F.element_at(order["bits"], k), state["there"]
            fails = mask.bitwiseAND(bit) != 0
            goes = there & fails
            counts = (
                F.when(there & ~fails, docs).otherwise(none), F.when(goes, docs).otherwise(none), F.when(~there & fails, docs).otherwise(none),
                F.when(mask == bit, docs).otherwise(none), F.when(goes, good).otherwise(none), F.when(goes, toxic).otherwise(none),
            )
            letter = F.substring(order["name"], k, F.lit(1))
            entry = F.struct(order["name"].alias("filter_order"), k.alias("step"), letter.alias("letter"), *[c.alias(n) for c, n in zip(counts, COUNTS, strict=True)])
            return F.struct((there & ~fails).alias("there"), F.concat(state["steps"], F.array(entry)).alias("steps"))

        start = F.struct(F.lit(True).alias("there"), F.array().cast(f"array<{entry_type}>").alias("steps"))
        return F.aggregate(F.sequence(F.lit(1), F.lit(len(filters))), start, step, lambda state: state["steps"])

    return F.flatten(F.transform(orders, through))


def merged(many: Column) -> Column:
    """Arrays of structs of equal orders and steps as one, its counts summed entry by entry."""

    def add(x: Column, y: Column) -> Column:
        return F.struct(*[x[f].alias(f) for f in ("filter_order", "step", "letter")], *[(x[c] + y[c]).alias(c) for c in COUNTS])

    return F.aggregate(F.slice(many, F.lit(2), F.greatest(F.size(many) - 1, F.lit(0))), F.get(many, F.lit(0)), lambda total, one: F.zip_with(total, one, add))


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is worked out once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def with_shapley(steps: Column, filters: str) -> Column:
    """``steps`` with shapley: what the step's filter removes, summed over all orders."""

    def removed_by(letter: str) -> Column:
        own = F.filter(steps, lambda s: s["letter"] == letter)
        return F.aggregate(own, F.lit(0).cast("long"), lambda total, s: total + s["removed"])

    totals = F.create_map(*[x for f in filters for x in (F.lit(f), removed_by(f))])
    return _once(totals, lambda t: F.transform(steps, lambda s: s.withField("shapley", F.element_at(t, s["letter"]))))


def interactions(counted: DataFrame, filters: str = "ABCDE") -> DataFrame:
    """One row per part, order of ``filters`` (a letter each) and step, from ``cells`` whose mask has a bit per filter.

    Columns: part, filter_order, step (from 1), kept, removed, redundant (fails, removed earlier), unique_fails (fails only this
    filter), good_lost, toxic_lost, shapley (what the step's filter removes, summed over all orders). A part has all its rows,
    zeros included; no cells give no rows.
    """
    own = counted.select("part", folded(filters, F.col("mask"), F.col("docs"), F.col("good"), F.col("toxic")).alias("fold"))
    # At most one array per mask and part.
    parts = own.groupBy("part").agg(F.collect_list("fold").alias("folds"))
    # explode_outer, since explode would bring a filter on the array's size that merges everything a second time.
    rows = parts.select("part", F.explode_outer(_once(merged(F.col("folds")), lambda steps: with_shapley(steps, filters))).alias("s"))
    return rows.select("part", "s.filter_order", "s.step", *[F.col(f"s.{c}") for c in COUNTS], "s.shapley")


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The interactions of five filters over whole texts of ``docs`` (doc_id, text, source), by source.

    A text fails A with under 50 words, B with distinct words under 65 % of its words, C with capitals A-Z above 5 % of its code
    points, D if it holds one of ``#$%&*|``, E if a smaller doc_id has the same text (up to collisions of SHA-256).
    A null text or source is empty; such a source and an empty one are the same part. Repeated rows count each. Rows
    without an id have no labels and are no copies. Of several labels of an id, one that says 1 decides. Other columns are left out.
    """
    rows = settle(documents_by_text(docs, labels), "masks")
    return interactions(cells(with_later_copies(rows, 4)))
