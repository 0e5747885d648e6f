"""Time expressions. All of them assume the session zone pinned to UTC."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

ISO_MILLIS = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"


def from_ms(column: Column | str) -> Column:
    return F.timestamp_millis(F.col(column) if isinstance(column, str) else column)


def to_ms(column: Column | str) -> Column:
    return F.unix_millis(F.col(column) if isinstance(column, str) else column)


def from_iso(column: Column | str) -> Column:
    """ISO-8601 text to timestamp, NULL when it does not parse."""
    return F.try_to_timestamp(F.col(column) if isinstance(column, str) else column)


def iso(column: Column) -> Column:
    return F.date_format(column, ISO_MILLIS)


def now_iso() -> Column:
    return iso(F.current_timestamp())


def day_start_ms(date: Column) -> Column:
    """Epoch milliseconds at which a UTC date begins."""
    return F.unix_millis(date.cast("timestamp"))


def hour_label(ts: Column | str) -> Column:
    return F.date_format(ts, "HH")


def utc(as_of: datetime) -> datetime:
    """The instant in UTC; one without a zone is taken as UTC."""
    return as_of.astimezone(timezone.utc) if as_of.tzinfo else as_of.replace(tzinfo=timezone.utc)


def instant(as_of: datetime) -> Column:
    return F.lit(utc(as_of)).cast("timestamp")


def newer_than(ts: str, as_of: datetime, minutes: int) -> Column:
    """``ts > as_of - minutes``."""
    return F.col(ts) > instant(utc(as_of) - timedelta(minutes=minutes))
