"""One row per key.

``row_number() = 1`` lets Spark put a WindowGroupLimit before the
shuffle, so each map task sends at most its own winner per key: a key holding a third of
all rows costs no more than the others.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

Order = str | Column


def _names(keys: str | Sequence[str]) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def _pick(df: DataFrame, keys, order: Sequence[Column]) -> DataFrame:
    w = Window.partitionBy(*_names(keys)).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).filter("__rn = 1").drop("__rn")


def latest_per_key(df: DataFrame, keys, order: Sequence[str]) -> DataFrame:
    """Row with the greatest order values; nulls count as oldest. End ``order`` with a
    column that is unique per key."""
    return _pick(df, keys, [F.col(c).desc_nulls_last() for c in order])


def first_per_key(df: DataFrame, keys, order: Sequence[str]) -> DataFrame:
    """Row with the smallest order values; nulls count as last."""
    return _pick(df, keys, [F.col(c).asc_nulls_last() for c in order])


def per_key(df: DataFrame, keys, order: Sequence[Column]) -> DataFrame:
    """First row per key in any given order."""
    return _pick(df, keys, order)


def any_per_key(df: DataFrame, keys, tie_breaker: Sequence[str]) -> DataFrame:
    """Some row per key; the tie-breaker makes it the same one in every run."""
    return first_per_key(df, keys, tie_breaker)


def dedupe_by_key(df: DataFrame, keys, order: Sequence[str]) -> DataFrame:
    """Drop duplicates of a key, keeping the newest row."""
    return latest_per_key(df, keys, order)


def _keep_extreme(df: DataFrame, keys, value: str, bound: Column) -> DataFrame:
    """Ties may be many, so no window: the bound is aggregated and joined as a key, and a
    hot key can be split among tasks."""
    names = _names(keys)
    bounds = df.groupBy(*names).agg(bound.alias(value))
    return df.join(bounds, [*names, value], "left_semi")


def keep_max_group(df: DataFrame, keys, value: str) -> DataFrame:
    """All rows that share the greatest value of their key (ties stay)."""
    return _keep_extreme(df, keys, value, F.max(value))


def keep_group_extremes(
    df: DataFrame, keys, maxima: Sequence[str] = (), minima: Sequence[str] = ()
) -> DataFrame:
    """Rows that hold every extreme of their key at once; a key may keep none."""
    names = _names(keys)
    bounds = df.groupBy(*names).agg(
        *[F.max(c).alias(f"__{c}") for c in maxima], *[F.min(c).alias(f"__{c}") for c in minima]
    )
    hold = [F.col(c) == F.col(f"__{c}") for c in (*maxima, *minima)]
    joined = df.join(bounds, names, "inner")
    for h in hold:
        joined = joined.filter(h)
    return joined.select(df.columns)


def keep_flagged_groups(df: DataFrame, keys, flag: Column, drop_flag_rows: bool = False) -> DataFrame:
    """Rows of keys in which some row is flagged, optionally without the flagged rows.

    The flagged keys are aggregated first and joined, instead of a window over the key.
    """
    names = _names(keys)
    marked = df.filter(flag).select(*names).distinct()
    kept = df.filter(~F.coalesce(flag, F.lit(False))) if drop_flag_rows else df
    return kept.join(marked, names, "left_semi")


def group_flag(df: DataFrame, keys, flag: Column, name: str) -> DataFrame:
    """Add 1 / 0: does any row of the key carry the flag."""
    names = _names(keys)
    marked = df.filter(flag).select(*names).distinct().withColumn(name, F.lit(1))
    return df.join(marked, names, "left").withColumn(name, F.coalesce(F.col(name), F.lit(0)))
