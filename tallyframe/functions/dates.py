"""Dates relative to an explicit run date. No function here reads the clock."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

# Dates that stand for "no value" in the source systems.
SENTINEL_DATES = ("0001-01-01", "1753-01-01")


def day(value: date | str) -> date:
    return date.fromisoformat(value) if isinstance(value, str) else value


def run_date(as_of: date | str) -> Column:
    return F.lit(day(as_of))


def yesterday(as_of: date | str) -> date:
    return day(as_of) - timedelta(days=1)


def days_between(start: Column, end: Column) -> Column:
    return F.datediff(end, start)


def month_boundaries(start: Column, end: Column) -> Column:
    """Number of month ends crossed: 31 January to 1 February counts one."""
    return (F.year(end) - F.year(start)) * 12 + (F.month(end) - F.month(start))


def age_years(birth: Column, at: Column) -> Column:
    """Completed years; a 29 February birthday falls on 28 February in common years."""
    years = F.year(at) - F.year(birth)
    not_yet = F.add_months(birth, years * 12) > F.to_date(at)
    return years - F.when(not_yet, 1).otherwise(0)


def age_years_decimal(
    birth: Column, at: Column, low: float = 10, high: float = 100, default: float = 18
) -> Column:
    """Days / 365.25; values outside ``low..high`` become ``default``."""
    age = F.datediff(at, birth) / F.lit(365.25)
    return F.when((age < low) | (age > high), F.lit(float(default))).otherwise(age)


def month_end(c: Column) -> Column:
    return F.last_day(c)


def year_start(c: Column) -> Column:
    return F.trunc(c, "year")


def month_to_date_bounds(as_of: date | str) -> tuple[date, date]:
    """First day of yesterday's month to yesterday: on day 1 that is the whole last month."""
    last = yesterday(as_of)
    return last.replace(day=1), last


def sentinel_to_null(c: Column, sentinels: Sequence[str] = SENTINEL_DATES) -> Column:
    """Null for sentinel dates. Works on dates, timestamps and ISO texts."""
    return F.when(~F.substring(c.cast("string"), 1, 10).isin(*sentinels), c)


def default_date(c: Column, as_of: date | str) -> Column:
    return F.coalesce(c, F.lit(yesterday(as_of)))


def parse_date(c: Column, fmt: str = "yyyy-MM-dd") -> Column:
    """Null instead of an error for text that does not parse."""
    return F.to_date(F.try_to_timestamp(c, F.lit(fmt)))


def parse_timestamp(c: Column, fmt: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    return F.try_to_timestamp(c, F.lit(fmt))


def guarded_parse_date(c: Column, pattern: str, fmt: str) -> Column:
    """Parse only texts that match ``pattern``."""
    return F.when(c.rlike(pattern), parse_date(c, fmt))


def clock_digits(c: Column) -> Column:
    """Six HHMMSS digits; anything of another length becomes ``000000``."""
    digits = F.regexp_replace(c, "[^0-9]", "")
    return F.when(F.length(digits) == 6, digits).otherwise(F.lit("000000"))


def assemble_timestamp(day_col: Column, clock: Column, default_day: str = "1900-01-01") -> Column:
    """A timestamp from a date and HHMMSS text; null when the digits are no time of day.

    The digits are checked before parsing, so bad clocks cost no exception per row.
    """
    digits = clock_digits(clock)
    stamp = F.concat(
        F.date_format(F.coalesce(day_col.cast("date"), F.lit(day(default_day))), "yyyy-MM-dd"), digits
    )
    parsed = F.try_to_timestamp(stamp, F.lit("yyyy-MM-ddHHmmss"))
    return F.when(digits.rlike("^([01][0-9]|2[0-3])[0-5][0-9][0-5][0-9]$"), parsed)


def format_date(c: Column, fmt: str = "yyyyMMdd") -> Column:
    return F.date_format(c, fmt)


def prorated_remaining(start: Column, end: Column, as_of: date | str) -> Column:
    """Months of the term still ahead at ``as_of``, rounded half up; 0 when expired.

    remaining days * term months / term days in whole numbers, so no rounding noise.
    """
    today = run_date(as_of)
    left = F.datediff(end, today).cast("long")
    term = F.datediff(end, start).cast("long")
    months = month_boundaries(start, end).cast("long")
    rounded = F.call_function("div", 2 * left * months + term, 2 * term)
    return F.when(today >= F.to_date(end), F.lit(0).cast("long")).when(term > 0, rounded)
