"""Dashboard and report queries over the state tables.

``as_of`` stands for "now", so that a result can be reproduced. When the frame
has a ``dt`` partition column the time bound is repeated on it, as a bound on
the timestamp alone prunes no folders.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.functions.times import newer_than, utc
from tickloom.operators import latest, ohlcv


def recent(rows: DataFrame, time: str, as_of: datetime, minutes: int) -> DataFrame:
    found = rows.where(newer_than(time, as_of, minutes))
    if "dt" in rows.columns:
        found = found.where(F.col("dt") >= F.lit((utc(as_of) - timedelta(minutes=minutes)).date()))
    return found


def latest_price(states: DataFrame) -> DataFrame:
    return latest.prices(states).orderBy("symbol")


def panel_latest_price(states: DataFrame) -> DataFrame:
    return latest_price(states).select("symbol", "price")


def ohlcv_recent(states: DataFrame, as_of: datetime, minutes: int = 30) -> DataFrame:
    return (
        ohlcv.bars(recent(states, "bucket_ts", as_of, minutes))
        .select("bucket_ts", "symbol", "open", "high", "low", "close", "volume")
        .orderBy("symbol", "bucket_ts")
    )


def panel_close(states: DataFrame, as_of: datetime, minutes: int = 30) -> DataFrame:
    return (
        recent(states, "bucket_ts", as_of, minutes)
        .groupBy(F.col("bucket_ts").alias("time"), "symbol")
        .agg(F.max_by("close_price", "close_key").alias("close"))
        .orderBy("time", "symbol")
    )


def panel_volume(states: DataFrame, as_of: datetime, minutes: int = 30) -> DataFrame:
    return (
        recent(states, "bucket_ts", as_of, minutes)
        .groupBy(F.col("bucket_ts").alias("time"), "symbol")
        .agg(F.sum("volume").cast("double").alias("volume"))
        .orderBy("time", "symbol")
    )


def panel_trade_count(hot: DataFrame, as_of: datetime, minutes: int = 15) -> DataFrame:
    """Distinct trades per symbol; a redelivered trade keeps its trade time, so
    the time bound can come first."""
    return (
        recent(hot, "trade_time", as_of, minutes)
        .select("symbol", "trade_id")
        .distinct()
        .groupBy("symbol")
        .agg(F.count(F.lit(1)).alias("trades"))
        .orderBy("symbol")
    )
