"""Row filters. Date filters compare the raw column with literals, so they reach the scan."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.functions.dates import day, month_to_date_bounds, yesterday


def all_of(*conditions: Column) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def any_of(*conditions: Column) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def _start(d: date | str) -> Column:
    """Midnight as wall-clock time: a text literal, so no time zone takes part."""
    return F.lit(day(d).isoformat()).cast("timestamp_ntz")


def on_day(ts: str, d: date | str) -> Column:
    """The timestamp falls on that day, as a half-open range on the raw column."""
    return (F.col(ts) >= _start(d)) & (F.col(ts) < _start(day(d) + timedelta(days=1)))


def between_days(ts: str, first: date | str, last: date | str) -> Column:
    """The timestamp falls on a day from ``first`` to ``last``, both included."""
    return (F.col(ts) >= _start(first)) & (F.col(ts) < _start(day(last) + timedelta(days=1)))


def since_day(ts: str, first: date | str) -> Column:
    return F.col(ts) >= _start(first)


def before_day(ts: str, d: date | str) -> Column:
    return F.col(ts) < _start(d)


def filter_yesterday(df: DataFrame, ts: str, as_of: date | str) -> DataFrame:
    return df.filter(on_day(ts, yesterday(as_of)))


def filter_recent_days(df: DataFrame, ts: str, as_of: date | str, days: int) -> DataFrame:
    return df.filter(since_day(ts, day(as_of) - timedelta(days=days)))


def filter_month_to_date(df: DataFrame, ts: str, as_of: date | str) -> DataFrame:
    first, last = month_to_date_bounds(as_of)
    return df.filter(between_days(ts, first, last))


def _known(codes: Sequence) -> list:
    return [c for c in dict.fromkeys(codes) if c is not None]


def filter_in_list(df: DataFrame, col: str, codes: Sequence) -> DataFrame:
    """Rows whose code is listed. A null in the list stands for nothing; Spark looks codes up in a hash set."""
    return df.filter(F.col(col).isin(_known(codes)))


def filter_not_in_list(df: DataFrame, col: str, codes: Sequence) -> DataFrame:
    """Rows whose code is known and not listed. A null code passes neither way, a null in the list stands for nothing."""
    known = _known(codes)
    there = df.filter(F.col(col).isNotNull())
    return there.filter(~F.col(col).isin(known)) if known else there


def drop_null_key(df: DataFrame, *keys: str) -> DataFrame:
    return df.dropna("any", subset=list(keys))
