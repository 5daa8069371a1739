"""Unions of tables and of branches of one table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.operators.latest import latest_per_key


def union_all(*tables: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), tables)


def union_constant_row(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Add one fixed member, such as the row for "unknown"."""
    row = df.sparkSession.range(1).select(
        [F.lit(values.get(f.name)).cast(f.dataType).alias(f.name) for f in df.schema.fields]
    )
    return df.unionByName(row)


def overlapping_branches(df: DataFrame, branches: Sequence[Column], keys, order: Sequence[str]) -> DataFrame:
    """Rows of any branch, once, newest per key: one pass instead of one scan per branch."""
    any_branch = reduce(lambda a, b: a | b, branches)
    return latest_per_key(df.filter(any_branch), keys, order)


def unpivot_columns(df: DataFrame, keys: Sequence[str], kinds: Mapping[str, str], kind: str, value: str) -> DataFrame:
    """Columns to rows with a kind label, without the null ones."""
    labelled = df.select(*keys, *[F.col(c).alias(label) for c, label in kinds.items()])
    return labelled.unpivot(list(keys), list(kinds.values()), kind, value).filter(F.col(value).isNotNull())
