"""Grouped aggregates. All of them combine on the map side before the shuffle."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.functions.numbers import money, sum_money


def group_sum(df: DataFrame, keys: Sequence[str | Column], sums: Mapping[str, Column]) -> DataFrame:
    """Exact sums of amounts per key."""
    return df.groupBy(*keys).agg(*[sum_money(c).alias(n) for n, c in sums.items()])


def group_min_max(df: DataFrame, keys: Sequence[str | Column], value: Column, low: str, high: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.min(value).alias(low), F.max(value).alias(high))


def conditional_sums(amount: Column, categories: Mapping[str, Column]) -> list[Column]:
    """One sum per category; rows of other categories add 0."""
    zero = F.lit(0).cast("decimal(18,2)")
    return [
        F.sum(F.when(hit, money(amount)).otherwise(zero)).cast("double").alias(name)
        for name, hit in categories.items()
    ]


def conditional_max_pivot(
    df: DataFrame, keys: Sequence[str], line: str, value: Column, lines: Mapping[object, str]
) -> DataFrame:
    """Numbered rows to columns: the greatest value of each listed line."""
    return df.groupBy(*keys).agg(
        *[F.max(F.when(F.col(line) == F.lit(n), value)).alias(name) for n, name in lines.items()]
    )


def sum_distinct(df: DataFrame, keys: Sequence[str], distinct: Mapping[str, Column], plain: Mapping[str, Column]) -> DataFrame:
    """Sums over distinct values beside plain sums."""
    return df.groupBy(*keys).agg(
        *[F.sum_distinct(money(c)).cast("double").alias(n) for n, c in distinct.items()],
        *[sum_money(c).alias(n) for n, c in plain.items()],
    )


def labelled_list(df: DataFrame, keys: Sequence[str], kind: str, value: Column, out: str, sep: str = ", ") -> DataFrame:
    """One text per key listing its kinds as ``kind-value`` in sorted order; ``value`` is an aggregate over the rows of a kind.

    Rows are reduced to one per (key, kind) first, so a list is never longer than the number of kinds, however many rows a key has.
    """
    kinds = df.groupBy(*keys, kind).agg(value.cast("string").alias("__value"))
    item = F.concat(F.col(kind), F.lit("-"), F.col("__value"))
    return kinds.groupBy(*keys).agg(F.array_join(F.sort_array(F.collect_list(item)), sep).alias(out))


def first_values(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Sequence[str], skip_nulls: bool = True
) -> DataFrame:
    """Per key the first value of each column, nulls skipped or kept.

    The order decides, not the partitioning.
    """
    rank = f"struct({', '.join(f'`{c}`' for c in order)})"

    def first(c: str) -> Column:
        if skip_nulls:
            return F.expr(f"min_by(`{c}`, {rank}) FILTER (WHERE `{c}` IS NOT NULL) AS `{c}`")
        return F.expr(f"min_by(struct(`{c}`), {rank}).`{c}` AS `{c}`")

    return df.groupBy(*keys).agg(*[first(c) for c in columns])


def group_as_distinct(df: DataFrame) -> DataFrame:
    return df.distinct()
