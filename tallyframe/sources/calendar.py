"""The calendar dimension with its business-day flag."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.functions.dates import yesterday

# Flags of the calendar dimension.
BUSINESS_DAY = "S"
NON_BUSINESS_DAY = "N"


def calendar_between(df: DataFrame, ts: str, closed_weekdays: Sequence[int] = (1,)) -> DataFrame:
    """One row per day between the first and last day of a table (1 = Sunday)."""
    span = df.agg(F.min(F.to_date(ts)).alias("lo"), F.max(F.to_date(ts)).alias("hi"))
    days = span.select(F.explode(F.sequence("lo", "hi")).alias("cal_date"))
    flag = F.when(F.dayofweek("cal_date").isin(*closed_weekdays), NON_BUSINESS_DAY).otherwise(BUSINESS_DAY)
    return days.select("cal_date", flag.alias("business_day"))


def business_flag(calendar: DataFrame, as_of: date | str) -> str | None:
    """Flag of the day before the run; None when the calendar does not hold it."""
    row = calendar.filter(F.col("cal_date") == F.lit(yesterday(as_of))).select("business_day").first()
    return row[0] if row else None
