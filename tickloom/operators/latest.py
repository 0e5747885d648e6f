"""Latest price per symbol, through mergeable states."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.operators.ohlcv import trade_order


def partial(trades: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    return trades.groupBy("symbol", *extra).agg(
        F.max_by("price", trade_order()).alias("price"),
        F.max(trade_order()).alias("price_key"),
        F.max("trade_time").alias("updated"),
    )


def merge_states(states: DataFrame) -> DataFrame:
    return states.groupBy("symbol").agg(
        F.max_by("price", "price_key").alias("price"),
        F.max("price_key").alias("price_key"),
        F.max("updated").alias("updated"),
    )


def prices(states: DataFrame) -> DataFrame:
    return merge_states(states).select("symbol", "price", "updated")


def last_not_null(rows: DataFrame, value: str, by: str, keys: Sequence[str] = ()) -> DataFrame:
    """The most recent non-null value per key, for a single-number panel."""
    return (
        rows.where(F.col(value).isNotNull())
        .groupBy(*keys)
        .agg(F.max_by(value, by).alias(value))
    )
