"""Numeric conversion and null handling. Money is decimal, so sums do not depend on order."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"


def money(c: Column) -> Column:
    return c.cast(MONEY)


def sum_money(c: Column) -> Column:
    """Exact sum of amounts, given back as double."""
    return F.sum(money(c)).cast("double")


def null_default(c: Column, value) -> Column:
    return F.coalesce(c, F.lit(value) if not isinstance(value, Column) else value)


def fallback_if_zero(c: Column, other: Column) -> Column:
    """``other`` where ``c`` is null or zero."""
    return F.when(c.isNull() | (c == 0), other).otherwise(c)


def sign_by(amount: Column, negative: Column) -> Column:
    """Flip the sign of rows where ``negative`` holds."""
    return F.when(negative, -amount).otherwise(amount)


def null_safe_sum(cols: Sequence[Column]) -> Column:
    """a + b + ... with nulls as 0."""
    return reduce(lambda a, b: a + b, [F.coalesce(c, F.lit(0)) for c in cols])


def scaled_decimal(c: Column, divisor: int = 10000, dtype: str = "decimal(10,2)") -> Column:
    """Text holding a scaled whole number to a decimal; null when it is no number."""
    return (c.try_cast("decimal(28,6)") / F.lit(divisor)).cast(dtype)


def integer_division(c: Column, divisor: int) -> Column:
    """Whole-number division that drops the remainder."""
    return F.call_function("div", c, F.lit(divisor))


def nan_to_null(c: Column) -> Column:
    """Text to double; ``NaN`` and anything that is no number become null."""
    value = c.try_cast("double")
    return F.when(~F.isnan(value), value)


def concat_numeric_code(*cols: Column) -> Column:
    """Numbers written one after the other, as one whole number."""
    return F.concat(*[c.cast("string") for c in cols]).try_cast("long")
