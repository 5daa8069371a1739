"""Joins. No table is broadcast by hint: Spark broadcasts a side only when its measured
size allows, and splits hot keys of the left side at run time (adaptive skew join)."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.operators.latest import first_per_key, latest_per_key
from tallyframe.sinks.loads import measured

Keys = str | Sequence[str] | Mapping[str, str]


def _pairs(on: Keys) -> list[tuple[str, str]]:
    if isinstance(on, str):
        return [(on, on)]
    if isinstance(on, Mapping):
        return list(on.items())
    return [(k, k) for k in on]


def lookup(
    left: DataFrame,
    right: DataFrame,
    on: Keys,
    columns: Mapping[str, str] | Sequence[str] | None = None,
    how: str = "left",
    right_filter: Column | None = None,
    condition: Column | None = None,
) -> DataFrame:
    """Equi-join that keeps all left columns and the chosen right ones under new names.

    ``on`` maps left to right key columns. ``right_filter`` is a constant condition on the
    right side. ``condition`` is a further condition over left columns and the new names.
    """
    if right_filter is not None:
        right = right.filter(right_filter)
    pairs = _pairs(on)
    if columns is None:
        columns = [c for c in right.columns if c not in {r for _, r in pairs}]
    if not isinstance(columns, Mapping):
        columns = {c: c for c in columns}
    right = right.select(
        *[F.col(r).alias(f"__k{i}") for i, (_, r) in enumerate(pairs)],
        *[F.col(c).alias(new) for c, new in columns.items()],
    )
    match = F.lit(True)
    for i, (l, _) in enumerate(pairs):
        match = match & (F.col(l) == F.col(f"__k{i}"))
    if condition is not None:
        match = match & condition
    return left.join(right, match, how).drop(*[f"__k{i}" for i in range(len(pairs))])


@dataclass(frozen=True)
class Dimension:
    """One side table of a star: key pairs, columns to bring, constant filter."""

    table: DataFrame
    on: Keys
    columns: Mapping[str, str] | Sequence[str]
    right_filter: Column | None = None
    how: str = field(default="left")


def star_denormalize(fact: DataFrame, dimensions: Sequence[Dimension]) -> DataFrame:
    """Left-join every side table in turn; one table may come in under several names."""
    for d in dimensions:
        fact = lookup(fact, d.table, d.on, d.columns, d.how, d.right_filter)
    return fact


def salted_lookup(
    left: DataFrame, right: DataFrame, on: Keys, columns=None, how: str = "left", salts: int = 16, heavy_rows: int = 100_000
) -> DataFrame:
    """``lookup`` for a left side with hot keys where adaptive skew handling cannot act.

    Keys with more than ``heavy_rows`` left rows are counted first, by a map-side combined aggregate. Their left rows
    spread over ``salts`` parts by a hash of their content (the same in every retry), and only their right rows are
    repeated, once per part. All other rows keep the first part.
    """
    if how not in ("left", "inner"):
        raise ValueError("a salted lookup is a left or inner join")
    pairs = _pairs(on)
    heavy = left.groupBy(*[F.col(l).alias(f"__h{i}") for i, (l, _) in enumerate(pairs)]).agg(F.count("*").alias("__rows"))
    heavy = heavy.filter(F.col("__rows") > heavy_rows).drop("__rows").withColumn("__heavy", F.lit(True))
    marks = [f"__h{i}" for i in range(len(pairs))]

    def marked(df: DataFrame, keys: Sequence[str]) -> DataFrame:
        match = reduce(lambda a, b: a & b, [F.col(k) == F.col(m) for k, m in zip(keys, marks)])
        return df.join(heavy, match, "left").drop(*marks)

    if columns is None:
        columns = [c for c in right.columns if c not in {r for _, r in pairs}]
    spread = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in left.columns]), F.lit(salts)).cast("int")
    left = marked(left, [l for l, _ in pairs]).withColumn("__salt", F.when(F.col("__heavy"), spread).otherwise(0)).drop("__heavy")
    parts = F.when(F.col("__heavy"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    right = marked(right, [r for _, r in pairs]).withColumn("__part", F.explode(parts)).drop("__heavy")
    return lookup(left, right, {**dict(pairs), "__salt": "__part"}, columns, how).drop("__salt")


#: A bin of one level is so many bins of the level below, and a range lies in the lowest level where it is about that many bins long.
#: More of them make narrow bins of long ranges, so that the points under many long ranges are shared by many tasks.
BINS_PER_RANGE = 64

#: Ranges of a bin meet a point as arrays of about so many, opened in the point's row; in a hash join, each range as a row of its own costs twice the time.
RANGES_PER_ARRAY = 512

#: A bin with more pairs than the square of this is cut into cells of at most so many ranges and about that square of pairs.
CELL_SIDE = 4096

#: Cells that a task has where there are many of them, and the most tasks for them.
CELLS_PER_TASK, MOST_TASKS = 4, 4000


def _plain(df: DataFrame) -> list[Column]:
    """The columns that can be hashed."""
    return [F.col(f"`{f.name}`") for f in df.schema if isinstance(f.dataType, T.AtomicType) and not isinstance(f.dataType, T.VariantType)]


def _same_keys(one: T.DataType, other: T.DataType) -> bool:
    """Whether a key equals one key of the other side at most, so that both sides see the same groups."""
    return one == other or isinstance(one, T.IntegralType) and isinstance(other, T.IntegralType)


def _number(df: DataFrame, name: str) -> Column:
    """A column as a number that keeps its order: days of a date, seconds of a timestamp."""
    kind, c = df.schema[name].dataType, F.col(f"`{name}`")
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("double")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(c.cast("timestamp")) / F.lit(1e6)
    return c.cast("double")


def range_lookup(
    left: DataFrame, right: DataFrame, on: Keys, point: str, low: str, high: str, columns: Mapping[str, str] | Sequence[str],
    width: float, how: str = "left",
) -> DataFrame:
    """Join on equal keys and ``low <= point <= high`` where there are few keys, or none, and many ranges.

    Ranges are cut into bins; key and bin are joined, and the exact test comes last, so a hot key is split by its bins. Bins of
    ``width`` hold short ranges, bins of the levels above are ``BINS_PER_RANGE`` times as wide each, and a range goes to the lowest level
    where it is at most so many bins long: a range of any length becomes at most two rows more. A point looks into one bin of each level
    that has ranges. The ranges of a bin come as arrays, so that a point is joined to few rows and its pairs are listed in place. A bin of
    many pairs is cut into cells, by its ranges and by its points, after both are counted; there are as few such bins as there are
    ``CELL_SIDE`` squared pairs.
    A null end leaves a range open on that side. A null point or key matches nothing; with ``how="left"`` its row stays,
    like every other row without a match. Whether a row has a match follows from its keys and point, so these are looked up once each
    to find the rows without one, up to their first range; the pairs are not listed a second time.
    """
    if how not in ("left", "inner"):
        raise ValueError("a range lookup is a left or inner join")
    pairs = _pairs(on)
    if not isinstance(columns, Mapping):
        columns = {c: c for c in columns}
    names = left.columns
    points = left.withColumn("__at", _number(left, point))
    # No range is cut into bins beyond the first and the last point.
    ends = points.agg(F.min("__at").alias("__least"), F.max("__at").alias("__greatest"))
    ranges = right.select(
        *[F.col(r).alias(f"__k{i}") for i, (_, r) in enumerate(pairs)], *[F.col(c).alias(new) for c, new in columns.items()],
        _number(right, low).alias("__low"), _number(right, high).alias("__high"),
    )
    for i in range(len(pairs)):
        ranges = ranges.filter(F.col(f"__k{i}").isNotNull())
    ranges = with_parameters(ranges, ends)
    start, stop = F.greatest(F.coalesce("__low", "__least"), "__least"), F.least(F.coalesce("__high", "__greatest"), "__greatest")
    ranges = ranges.withColumn("__start", start).withColumn("__stop", stop).filter("__start <= __stop")
    span = (F.col("__stop") - F.col("__start")) / F.lit(float(width * BINS_PER_RANGE))
    ranges = ranges.withColumn("__level", F.ceil(F.log(float(BINS_PER_RANGE), F.greatest(span, F.lit(1.0)))).cast("int"))

    def bin_of(value: str) -> Column:
        return F.floor(F.col(value) / (F.lit(float(width)) * F.pow(F.lit(float(BINS_PER_RANGE)), F.col("__level")))).cast("long")

    top = ranges.agg(F.coalesce(F.max("__level"), F.lit(0)).alias("__top"))
    ranges = ranges.withColumn("__bin", F.explode(F.sequence(bin_of("__start"), bin_of("__stop")))).drop("__start", "__stop", "__least", "__greatest")

    def looking(at: DataFrame) -> DataFrame:
        looks = with_parameters(at.filter(F.col("__at").isNotNull()), top)
        looks = looks.withColumn("__level", F.explode(F.sequence(F.lit(0), F.col("__top")))).withColumn("__bin", bin_of("__at"))
        return looks.withColumnsRenamed({"__level": "__l", "__bin": "__b"})

    match = (F.col("__l") == F.col("__level")) & (F.col("__b") == F.col("__bin"))
    for i, (key, _) in enumerate(pairs):
        match = match & (F.col(f"`{key}`") == F.col(f"__k{i}"))
    within = (F.col("__at") >= F.coalesce("__low", "__at")) & (F.col("__at") <= F.coalesce("__high", "__at"))

    place = [*[f"__k{i}" for i in range(len(pairs))], "__level", "__bin"]
    counts = ranges.groupBy(*place).agg(F.count("*").alias("__held"))
    looks = looking(points)
    if all(_same_keys(left.schema[l].dataType, right.schema[r].dataType) for l, r in pairs):
        spots = [*[F.col(f"`{key}`").alias(f"__k{i}") for i, (key, _) in enumerate(pairs)], F.col("__l").alias("__level"), F.col("__b").alias("__bin")]
        counts = counts.join(looks.groupBy(*spots).agg(F.count("*").alias("__points")), place, "left")
    else:
        counts = counts.withColumn("__points", F.lit(0))
    size = F.col("__held") * F.coalesce("__points", F.lit(0)).cast("double")
    lists, slices = F.ceil(F.col("__held") / RANGES_PER_ARRAY), F.when(size > CELL_SIDE**2, F.ceil(F.col("__held") / CELL_SIDE)).otherwise(1)
    crowded = counts.filter((F.col("__held") > RANGES_PER_ARRAY) | (size > CELL_SIDE**2))
    crowded = crowded.select(*place, lists.alias("__lists"), slices.alias("__slices"), F.greatest(F.ceil(size / slices / CELL_SIDE**2), F.lit(1)).alias("__parts"))
    crowded = measured(crowded)
    cells = crowded.filter("__slices * __parts > 1").drop("__lists")
    slices, parts = F.coalesce("__slices", F.lit(1)), F.coalesce("__parts", F.lit(1))
    looks = looks.join(cells, match, "left").drop(*place)
    looks = looks.withColumn("__s", F.explode(F.sequence(F.lit(0), slices - 1))).withColumn("__p", F.pmod(F.xxhash64(*_plain(left)), parts))
    entries = F.struct("__low", "__high", *[F.col(f"`{c}`") for c in columns.values()])
    lists = ranges.join(crowded, place, "left").withColumn("__list", F.pmod(F.xxhash64(*_plain(ranges.drop(*place))), F.coalesce("__lists", F.lit(1))))
    lists = lists.groupBy(*place, "__list", slices.alias("__slices"), parts.alias("__parts")).agg(F.collect_list(entries).alias("__ranges"))
    lists = lists.withColumn("__slice", F.pmod("__list", "__slices")).withColumn("__part", F.explode(F.sequence(F.lit(0), F.col("__parts") - 1)))
    if number := cells.agg(F.sum(F.col("__slices") * F.col("__parts"))).first()[0]:
        # Spark puts partitions together by their bytes, which say nothing about pairs.
        tasks = max(int(left.sparkSession.conf.get("spark.sql.shuffle.partitions")), min(number // CELLS_PER_TASK, MOST_TASKS))
        looks = looks.repartition(tasks, *[F.col(f"`{key}`") for key, _ in pairs], "__l", "__b", "__s", "__p")
        lists = lists.repartition(tasks, *place, "__slice", "__part")
    cell = match & (F.col("__s") == F.col("__slice")) & (F.col("__p") == F.col("__part"))
    met = looks.join(lists, cell, "inner").select(*[F.col(f"`{c}`") for c in names], "__at", F.inline("__ranges"))
    hits = met.filter(within).select(*[F.col(f"`{c}`") for c in names], *columns.values())
    if how == "inner":
        return hits
    known = [*dict.fromkeys([*(key for key, _ in pairs), point])]
    once = points.select(*[F.col(f"`{c}`") for c in known], "__at").distinct()
    found = looking(once).join(ranges, match & within, "left_semi")
    matched = found.select(*[F.col(f"`{c}`").alias(f"__m{i}") for i, c in enumerate(known)]).distinct()
    same = reduce(lambda a, b: a & b, [F.col(f"`{c}`").eqNullSafe(F.col(f"__m{i}")) for i, c in enumerate(known)])
    return hits.unionByName(left.join(matched, same, "left_anti"), allowMissingColumns=True)


def full_outer(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keep both sides; the key comes from whichever side has it."""
    return left.join(right, list(keys), "full")


def with_parameters(df: DataFrame, params: DataFrame) -> DataFrame:
    """Add the columns of a one-row parameter table to every row.

    Read once as a scalar subquery: no join, and an error when there is more than one row.
    """
    row = params.select(F.struct(*params.columns)).scalar()
    return df.withColumn("__p", row).select(*df.columns, *[F.col(f"__p.{c}") for c in params.columns])


def anti_join(left: DataFrame, right: DataFrame, on: Keys) -> DataFrame:
    """Left rows without a match."""
    pairs = _pairs(on)
    right = right.select([F.col(r).alias(l) for l, r in pairs]).dropna()
    return left.join(right, [l for l, _ in pairs], "left_anti")


def semi_join(left: DataFrame, right: DataFrame, on: Keys) -> DataFrame:
    """Left rows with a match."""
    pairs = _pairs(on)
    right = right.select([F.col(r).alias(l) for l, r in pairs])
    return left.join(right, [l for l, _ in pairs], "left_semi")


def apply_top1(
    left: DataFrame, right: DataFrame, on: Keys, order: Sequence[str], columns, right_filter: Column | None = None
) -> DataFrame:
    """For each left row the newest matching right row, nulls if there is none."""
    if right_filter is not None:
        right = right.filter(right_filter)
    right_keys = [r for _, r in _pairs(on)]
    wanted = list(columns)
    right = right.select(*dict.fromkeys([*right_keys, *order, *wanted]))
    return lookup(left, latest_per_key(right, right_keys, order), on, columns)


def latest_values(
    df: DataFrame, keys, order: Sequence[str], values: Mapping[str, tuple[Column, Column]], others: Mapping[str, Column] | None = None
) -> DataFrame:
    """Per key the newest value of several kinds, each ``name: (value, condition)``, and any ``others`` aggregates.

    Several ``apply_top1`` over one table in a single map-side combined aggregate.
    """
    names = [keys] if isinstance(keys, str) else list(keys)
    rank = F.struct(*order)
    newest = [F.max_by(F.when(hit, value), F.when(hit, rank)).alias(n) for n, (value, hit) in values.items()]
    return df.groupBy(*names).agg(*newest, *[e.alias(n) for n, e in (others or {}).items()])


def apply_any(left: DataFrame, right: DataFrame, on: Keys, flag: str, right_filter: Column | None = None) -> DataFrame:
    """Add 1 / 0: is there any matching right row."""
    if right_filter is not None:
        right = right.filter(right_filter)
    pairs = _pairs(on)
    known = right.select([F.col(r) for _, r in pairs]).distinct().withColumn("__hit", F.lit(1))
    joined = lookup(left, known, on, {"__hit": flag})
    return joined.withColumn(flag, F.coalesce(F.col(flag), F.lit(0)))


def apply_aggregate(
    left: DataFrame, right: DataFrame, on: Keys, aggregates: Mapping[str, Column], right_filter: Column | None = None
) -> DataFrame:
    """Aggregates of the matching right rows: aggregated per key first, then joined."""
    if right_filter is not None:
        right = right.filter(right_filter)
    keys = [r for _, r in _pairs(on)]
    summed = right.groupBy(*keys).agg(*[e.alias(n) for n, e in aggregates.items()])
    return lookup(left, summed, on, list(aggregates))


def latest_event(df: DataFrame, keys, of_type: Column, sequence: Sequence[str]) -> DataFrame:
    """Per key the newest event of one type."""
    return latest_per_key(df.filter(of_type), keys, sequence)


def first_last_state(df: DataFrame, keys, order: Sequence[str], state: Sequence[str]) -> DataFrame:
    """Per key the earliest and the latest state, as ``first_*`` and ``last_*``.

    One map-side combined aggregate for both ends.
    """
    names = [keys] if isinstance(keys, str) else list(keys)
    rank, value = F.struct(*order), F.struct(*state)
    ends = df.groupBy(*names).agg(F.min_by(value, rank).alias("__f"), F.max_by(value, rank).alias("__l"))
    return ends.select(
        *names,
        *[F.col(f"__f.{c}").alias(f"first_{c}") for c in state],
        *[F.col(f"__l.{c}").alias(f"last_{c}") for c in state],
    )


Overall = Mapping[str, tuple[Column, Callable[[Column], Column]]]


def _sums_at(rows: DataFrame, keys, day: str, sums: Mapping[str, Column], pick, overall: Overall | None = None) -> DataFrame:
    """Sum per key and day, then keep one day per key: two aggregates, no join, no window.

    ``overall`` adds aggregates over all days of a key in the same pass: each an aggregate per day and how days combine.
    """
    names = [keys] if isinstance(keys, str) else list(keys)
    overall = overall or {}
    per_day = rows.groupBy(*names, day).agg(*[e.alias(n) for n, e in sums.items()], *[e.alias(n) for n, (e, _) in overall.items()])
    days = [combine(F.col(n)).alias(n) for n, (_, combine) in overall.items()]
    chosen = per_day.groupBy(*names).agg(pick(F.struct(day, *sums), F.col(day)).alias("__day"), *days)
    return chosen.select(*names, "__day.*", *overall)


def first_due(schedule: DataFrame, keys, due: str, sums: Mapping[str, Column], overall: Overall | None = None) -> DataFrame:
    """Sums over the rows of each key's first due date."""
    return _sums_at(schedule, keys, due, sums, F.min_by, overall)


def last_paid(payments: DataFrame, keys, paid: str, sums: Mapping[str, Column], overall: Overall | None = None) -> DataFrame:
    """Sums over the rows of each key's last payment date."""
    return _sums_at(payments, keys, paid, sums, F.max_by, overall)


def event_pairs(df: DataFrame, key: str, original: Column, replacement: Column, totals: Mapping[str, Column]) -> DataFrame:
    """Original rows and every replacement of their key as rows of one table, told apart by ``side``, with totals over the
    key's replacements on each.

    Replacements of a key without an original are left out, originals without a replacement stay. The result has as many
    rows as both sides together, never their product. Totals are made per key, map-side first, before they are looked up.
    """
    side = F.when(original, "original").when(replacement, "replacement")
    rows = df.withColumn("side", side).filter(F.col("side").isNotNull())
    replaced = rows.filter("side = 'replacement'").groupBy(key).agg(*[e.alias(n) for n, e in totals.items()])
    known = rows.groupBy(key).agg(F.max(F.col("side") == "original").alias("__known"))
    per_key = lookup(known.filter("__known").select(key), replaced, key, list(totals))
    originals = lookup(rows.filter("side = 'original'"), replaced, key, list(totals))
    return originals.unionByName(lookup(rows.filter("side = 'replacement'"), per_key, key, list(totals), how="inner"))


def history_plus_online(history: DataFrame, online: DataFrame, transform) -> DataFrame:
    """The same transform over the history and today's rows, as one table."""
    return transform(history).unionByName(transform(online))
