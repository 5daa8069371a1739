"""Upserts and snapshots as table-to-table functions; the writing is in ``sinks``."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.functions.dates import yesterday
from tallyframe.functions.text import content_hash
from tallyframe.operators.latest import latest_per_key


def upsert_replace(target: DataFrame, staged: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows whose key is not staged, plus all staged rows."""
    kept = target.join(staged.select(*keys).dropna(), list(keys), "left_anti")
    return kept.select(target.columns).unionByName(staged.select(target.columns))


def upsert_update_insert(
    target: DataFrame, staged: DataFrame, keys: Sequence[str], update: Sequence[str], order: Sequence[str] = ()
) -> DataFrame:
    """Matched rows take the staged value of the ``update`` columns; unknown keys are added.

    Of staged rows of one key the last by ``order`` counts, then by all other columns; rows without a key are left
    out. So staged rows that repeat a key never multiply rows of the target.
    """
    ranked = [*order, *[c for c in staged.columns if c not in keys and c not in order]]
    staged = latest_per_key(staged.dropna("any", subset=list(keys)), keys, ranked)
    rest = [c for c in target.columns if c not in keys]
    new = staged.select(
        *keys, *[F.col(c).alias(f"__new_{c}") for c in rest], F.lit(True).alias("__staged")
    )
    old = target.select(*keys, *rest, F.lit(True).alias("__known"))
    both = old.join(new, list(keys), "full")

    def value(c: str) -> Column:
        if c in update:
            return F.when(F.col("__staged"), F.col(f"__new_{c}")).otherwise(F.col(c))
        return F.when(F.col("__known"), F.col(c)).otherwise(F.col(f"__new_{c}"))

    return both.select(*[c if c in keys else value(c).alias(c) for c in target.columns])


def with_content_hash(df: DataFrame, content: Sequence[str], out: str = "hash") -> DataFrame:
    return df.withColumn(out, content_hash(*[F.col(c) for c in content]))


def hash_validity_merge(
    target: DataFrame, staged: DataFrame, content: Sequence[str], hash_col: str = "hash",
    valid_from: str = "valid_from", valid_to: str = "valid_to",
) -> DataFrame:
    """History by content: known content only moves its ``valid_to``, new content is added.

    Content that is no longer delivered keeps its last ``valid_to``. A null and an empty text are the same content, as
    they are for the hash; of both, the empty text is kept, so a hash has one row. One union and one map-side combined
    aggregate, so repeated rows of one content cost nothing extra.
    """
    columns = [hash_col, *content, valid_from, valid_to]
    rows = target.select(columns).unionByName(staged.select(columns))
    return rows.groupBy(hash_col).agg(
        *[F.min(c).alias(c) for c in content], F.min(valid_from).alias(valid_from), F.max(valid_to).alias(valid_to)
    ).select(columns)


def stage_validity(df: DataFrame, content: Sequence[str], as_of: date | str) -> DataFrame:
    """Hash the content and open and close its validity on the day before the run."""
    day_before = F.lit(yesterday(as_of))
    return with_content_hash(df.select(*content), content).select(
        "hash", *content, day_before.alias("valid_from"), day_before.alias("valid_to")
    )


def restamp_snapshot(history: DataFrame, date_col: str, from_day: date, to_day: date) -> DataFrame:
    """The rows of one day, stamped with another."""
    rows = history.filter(F.col(date_col) == F.lit(from_day))
    return rows.withColumn(date_col, F.lit(to_day))


def snapshot_projection(df: DataFrame, keep: Column, as_of: date | str, date_col: str = "as_of") -> DataFrame:
    """Filtered rows stamped with the run date."""
    return df.filter(keep).withColumn(date_col, F.lit(as_of).cast("date"))


def fill_blank_date(df: DataFrame, col: str, as_of: date | str) -> DataFrame:
    """A null or blank date text becomes the day before the run."""
    blank = F.trim(F.coalesce(F.col(col), F.lit(""))) == ""
    filled = F.when(blank, F.lit(yesterday(as_of).isoformat())).otherwise(F.col(col))
    return df.withColumn(col, filled)
