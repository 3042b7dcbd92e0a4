"""Column expressions shared by the operators. All are built-in functions, so they stay in generated code."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, functions as F

# Fixed values.
HIGH_DATE = "9999-12-31 00:00:00"  # valid_to of a current version
EPOCH = "1900-01-01 00:00:00"  # watermark of a table that was never loaded
LABEL_WIDTH = 9  # day and month names are blank-padded to this width


def instant(ts: datetime | str) -> Column:
    """A zone-less timestamp literal. One batch uses one value, so replays give the same rows."""
    text = ts if isinstance(ts, str) else ts.isoformat(sep=" ")
    return F.lit(text).cast("timestamp_ntz")


def high_date() -> Column:
    return instant(HIGH_DATE)


def changed(old: Column, new: Column, null_safe: bool) -> Column:
    """Change test. The plain test gives NULL when a side is NULL, which counts as not changed."""
    if null_safe:
        return ~old.eqNullSafe(new)
    return F.coalesce(old != new, F.lit(False))


def availability(status: Column) -> Column:
    """True for 'available' in any case; every other text and NULL give False."""
    return F.when(F.lower(status) == "available", True).otherwise(False)


def day_label(day: Column) -> Column:
    return F.rpad(F.date_format(day, "EEEE"), LABEL_WIDTH, " ")


def month_label(month: Column) -> Column:
    return F.rpad(F.date_format(F.make_date(F.lit(2000), month, F.lit(1)), "MMMM"), LABEL_WIDTH, " ")


def date_key(day: Column) -> Column:
    """Calendar key yyyymmdd: stable over reloads, and its first six digits name the month."""
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def whole_days(start: Column, end: Column) -> Column:
    return F.datediff(end, start)


def money(amount: Column) -> Column:
    """Result type of every money total: wide enough for sums over a whole warehouse."""
    return amount.cast("decimal(24,2)")


def rounded_mean(total: Column, n: Column, scale: int) -> Column:
    """Mean from a sum and a count, rounded half away from zero without passing through a double."""
    return F.round(total.cast("decimal(24,2)") / n.cast("decimal(14,0)"), scale)
