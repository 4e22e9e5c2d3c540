"""Column expressions whose meaning Spark's own functions don't have."""

from __future__ import annotations

from pyspark.sql import Column, Window, WindowSpec
from pyspark.sql import functions as F


def is_bot(login: Column) -> Column:
    """Whether the login says so itself; null for a null login, which is then neither bot nor human."""
    return login.contains("[bot]")


def lenient_long(text: Column) -> Column:
    """A whole number from text; decimals and exponents are rounded, half away from zero; anything else is null.

    Hexadecimal and underscored numbers are null.
    """
    rounded = F.round(text.try_cast("double"))
    return F.coalesce(text.try_cast("bigint"), rounded.try_cast("bigint"))


def lenient_int(text: Column) -> Column:
    return lenient_long(text).try_cast("int")


def minutes_between(start: Column, end: Column) -> Column:
    """Minute boundaries passed, not whole minutes elapsed: 00:00:59 to 00:01:00 is 1."""
    minute = lambda c: F.date_trunc("minute", c)
    return F.timestamp_diff("MINUTE", minute(start), minute(end))


def hours_between(start: Column, end: Column) -> Column:
    return minutes_between(start, end) / F.lit(60.0)


def hour_of(ts: Column) -> Column:
    return F.date_trunc("hour", ts).cast("timestamp_ntz")


def day_number(day: Column) -> Column:
    return F.datediff(day, F.lit("1970-01-01").cast("date"))


def trailing_days(days: int, day: Column, *keys: str) -> WindowSpec:
    """The `days` calendar days before a row's own, which it leaves out; days without rows are no rows."""
    return Window.partitionBy(*keys).orderBy(day_number(day)).rangeBetween(-days, -1)


def safe_ratio(a: Column, b: Column) -> Column:
    """a / b, null where b is 0 or null."""
    return F.when(b != 0, a.cast("double") / b.cast("double"))
