"""Null-safe parsing and arithmetic (ANSI mode stays on)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Exact sums: amounts are parsed to this decimal, summed exactly (Spark widens
# the sum by 10 digits) and only the final ratio is computed in double.  It holds
# 20 digits before the point and 8 behind it: more digits behind are rounded half
# up, an amount of 10^20 or more counts as unparsable (null).
AMOUNT = "decimal(28,8)"


def parse_amount(c: Column) -> Column:
    """String (or number) -> decimal amount; unparsable -> null."""
    return c.cast("string").try_cast(AMOUNT)


def parse_double(c: Column) -> Column:
    return c.cast("string").try_cast("double")


def parse_day(c: Column) -> Column:
    """``yyyy-MM-dd``, optionally followed by a blank and anything -> DATE; otherwise null.

    A cast to a date would also take shorter forms, signs and a ``T`` suffix: both
    hyphens in place, a digit in tenth place and the end or a blank behind it
    leave only the full form, without the cost of a pattern formatter a row.
    """
    text = c.cast("string")
    last = F.substring(text, 10, 1)
    shape = (
        (F.substring(text, 5, 1) == "-")
        & (F.substring(text, 8, 1) == "-")
        & (last >= "0")
        & (last <= "9")
        & F.substring(text, 11, 1).isin("", " ")
    )
    return F.when(shape, F.substring(text, 1, 10).try_cast("date"))


def ratio(num: Column, den: Column) -> Column:
    """num / den in double; null when either is null or den is zero."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def change_pct(current: Column, previous: Column) -> Column:
    """Period-over-period change in percent: (cur - prev) * 100 / prev."""
    return F.try_divide((current - previous) * F.lit(100.0), previous)
