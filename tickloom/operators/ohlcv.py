"""Open/high/low/close/volume bars, directly and through mergeable states.

Open and close are ordered by ``(trade_time, trade_id)``. A state row carries
that key next to the price and keeps both volumes as DECIMAL, so merging states
is associative and gives the same bars as one pass over the trades.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions.numbers import exact_sum

STATE_VALUES = [
    "open_price",
    "open_key",
    "close_price",
    "close_key",
    "high",
    "low",
    "volume",
    "quote_volume",
    "trade_count",
]


def trade_order() -> Column:
    return F.struct("trade_time", "trade_id")


def _totals(qty: str, quote: str) -> list[Column]:
    return [
        exact_sum(qty).alias("volume"),
        exact_sum(quote).alias("quote_volume"),
        F.count(F.lit(1)).alias("trade_count"),
    ]


def rollup(
    trades: DataFrame,
    unit: str = "hour",
    bucket: str = "bucket_hour",
    qty: str = "quantity",
    quote: str = "quote_quantity",
) -> DataFrame:
    """Bars per symbol and time unit, from deduplicated trades.

    One aggregation with map-side combine: each task sends one row per symbol
    and bucket, whatever the share of the busiest symbol is.
    """
    return (
        trades.groupBy("symbol", F.date_trunc(unit, "trade_time").alias(bucket))
        .agg(
            F.min_by("price", trade_order()).alias("open"),
            F.max("price").alias("high"),
            F.min("price").alias("low"),
            F.max_by("price", trade_order()).alias("close"),
            *_totals(qty, quote),
        )
        .withColumns({c: F.col(c).cast("double") for c in ("volume", "quote_volume")})
    )


def partial(
    trades: DataFrame,
    unit: str = "minute",
    bucket: str = "bucket_ts",
    extra: Sequence[str] = (),
    qty: str = "qty",
    quote: str = "quote_qty",
) -> DataFrame:
    """State rows for one block of trades; ``extra`` names further group columns."""
    placed = trades.withColumn(bucket, F.date_trunc(unit, "trade_time"))
    return partial_of(placed, bucket, extra, qty, quote)


def partial_of(
    placed: DataFrame,
    bucket: str = "bucket_ts",
    extra: Sequence[str] = (),
    qty: str = "qty",
    quote: str = "quote_qty",
) -> DataFrame:
    """State rows for trades that already have their bucket, whatever its width."""
    return placed.groupBy("symbol", bucket, *extra).agg(
        F.min_by("price", trade_order()).alias("open_price"),
        F.min(trade_order()).alias("open_key"),
        F.max_by("price", trade_order()).alias("close_price"),
        F.max(trade_order()).alias("close_key"),
        F.max("price").alias("high"),
        F.min("price").alias("low"),
        *_totals(qty, quote),
    )


def merge_states(states: DataFrame, unit: str | None = None, bucket: str = "bucket_ts") -> DataFrame:
    """States with the same symbol and bucket become one; ``unit`` coarsens the bucket."""
    slot = F.col(bucket) if unit is None else F.date_trunc(unit, bucket)
    return states.groupBy("symbol", slot.alias(bucket)).agg(
        F.min_by("open_price", "open_key").alias("open_price"),
        F.min("open_key").alias("open_key"),
        F.max_by("close_price", "close_key").alias("close_price"),
        F.max("close_key").alias("close_key"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        _whole_sum("volume").alias("volume"),
        _whole_sum("quote_volume").alias("quote_volume"),
        F.sum("trade_count").alias("trade_count"),
    )


def _whole_sum(total: str) -> Column:
    """The sum of partial totals; NULL, as in ``exact_sum``, if one of them has no value."""
    known = F.count(total) == F.count(F.lit(1))
    return F.when(known, F.try_sum(total)).try_cast("decimal(38,8)")


def bars(states: DataFrame, unit: str | None = None, bucket: str = "bucket_ts") -> DataFrame:
    """Finished bars from states; unused columns are pruned down to the state scan."""
    return merge_states(states, unit, bucket).select(
        "symbol",
        bucket,
        F.col("open_price").alias("open"),
        "high",
        "low",
        F.col("close_price").alias("close"),
        F.col("volume").cast("double").alias("volume"),
        F.col("quote_volume").cast("double").alias("quote_volume"),
        "trade_count",
    )


def edge_trade(trades: DataFrame, unit: str = "hour", last: bool = False) -> DataFrame:
    """The first (or last) trade of every symbol and bucket, as a whole row."""
    from tickloom.operators.dedup import latest

    way = (lambda c: F.col(c).desc()) if last else (lambda c: F.col(c).asc())
    return latest(
        trades.withColumn("bucket", F.date_trunc(unit, "trade_time")),
        keys=("symbol", "bucket"),
        order=[way("trade_time"), way("trade_id")],
    )
