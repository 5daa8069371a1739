"""Checks on a table before it is loaded."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def require_non_empty(df: DataFrame, what: str = "table") -> DataFrame:
    if df.isEmpty():
        raise ValueError(f"{what} has no rows")
    return df


def skip_if_empty(df: DataFrame, load):
    """Run ``load(df)`` only when there are rows; None otherwise."""
    return None if df.isEmpty() else load(df)


def duplicate_keys(df: DataFrame, keys: Sequence[str], count: str = "copies") -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count("*").alias(count)).filter(F.col(count) > 1)


def require_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    if not duplicate_keys(df, keys).isEmpty():
        raise ValueError(f"key {list(keys)} is not unique")
    return df


def missing_columns(df: DataFrame, required: Sequence[str]) -> list[str]:
    return [c for c in required if c not in df.columns]


def require_columns(df: DataFrame, required: Sequence[str]) -> DataFrame:
    missing = missing_columns(df, required)
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df


def with_row_count(df: DataFrame, name: str = "rows") -> tuple[DataFrame, Observation]:
    """Count rows during the write itself, without a second pass over the data."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen
