"""Expiry by age."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions.times import instant, utc


def alive(as_of: datetime, time: str = "trade_time", days: int = 7) -> Column:
    """A row lives while its time, cut to whole seconds, plus ``days`` is after ``as_of``.

    Solved for the time, so that the bare column is compared with a constant and
    the filter can be pushed into the scan.
    """
    first = (as_of - timedelta(days=days)).replace(microsecond=0) + timedelta(seconds=1)
    return F.col(time) >= instant(first)


def unexpired(
    rows: DataFrame,
    as_of: datetime,
    time: str = "trade_time",
    days: int = 7,
    date_column: str | None = None,
) -> DataFrame:
    """Rows that have not expired; ``date_column`` is a partition to prune by."""
    kept = rows.where(alive(as_of, time, days))
    if date_column is not None:
        kept = kept.where(F.col(date_column) >= F.lit(oldest_date(as_of, days)))
    return kept


def oldest_date(as_of: datetime, days: int = 7) -> date:
    """The earliest date that can still hold an unexpired row."""
    return (utc(as_of) - timedelta(days=days)).date()
