"""Column expressions shared by the operators. All stay inside generated code."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

SECONDS_PER_DAY = 86_400


def column(value) -> Column:
    return value if isinstance(value, Column) else F.col(value)


def instant(unix) -> Column:
    """Timestamp of unix seconds. Out-of-range seconds saturate instead of failing the job."""
    return column(unix).cast("timestamp")


def utc_day(unix) -> Column:
    return F.to_date(instant(unix))


def elapsed(later, earlier) -> Column:
    """Whole seconds between two values, each unix seconds or timestamp."""
    return column(later).cast("long") - column(earlier).cast("long")


def within(later, earlier, seconds: int) -> Column:
    """``0 <= later - earlier <= seconds``: both ends count, and time never runs back."""
    return elapsed(later, earlier).between(0, seconds)


def ratio(part, whole, scale: float = 1.0) -> Column:
    """``part / whole * scale``; NULL when there is nothing to divide by."""
    quotient = F.try_divide(column(part).cast("double"), column(whole).cast("double"))
    return quotient if scale == 1.0 else quotient * F.lit(scale)


def only_if(condition: Column, value) -> Column:
    return F.when(condition, column(value))


def flag(condition: Column) -> Column:
    """1 when the condition holds, else 0 (also for NULL)."""
    return F.when(condition, 1).otherwise(0).cast("int")


def iso_utc(unix) -> Column:
    """ISO-8601 text with a UTC offset, as producers send it."""
    return F.date_format(instant(unix), "yyyy-MM-dd'T'HH:mm:ss'+00:00'")


def day(value) -> Column:
    """A date column from a ``date``, an ISO string or a column."""
    return value if isinstance(value, Column) else F.lit(str(value)).cast("date")


def trailing_days(date_column, as_of, days: int) -> Column:
    """``[as_of - days, as_of)``, written on the bare column so partitions prune."""
    end = day(as_of)
    return (column(date_column) >= F.date_sub(end, days)) & (column(date_column) < end)


def as_utc(moment: datetime) -> datetime:
    """A time without a zone is taken as UTC, whatever zone the machine is in."""
    return moment if moment.tzinfo else moment.replace(tzinfo=timezone.utc)


def clock(now: datetime | None) -> Column:
    """The given time, or the time of the query."""
    return F.current_timestamp() if now is None else F.lit(as_utc(now))
