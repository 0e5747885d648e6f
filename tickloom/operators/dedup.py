"""Removing redelivered records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TRADE_KEY = ("symbol", "trade_id")


def newest_first() -> list[Column]:
    """Later log time wins; offset and partition settle equal times."""
    return [
        F.col("kafka_timestamp").desc(),
        F.col("kafka_offset").desc(),
        F.col("kafka_partition").desc(),
    ]


def latest(
    rows: DataFrame,
    keys: Sequence[str] = TRADE_KEY,
    order: Sequence[Column] | None = None,
) -> DataFrame:
    """The newest version of every key.

    Catalyst plans ``row_number() = 1`` with a group limit on both sides of the
    shuffle, so at most one row per key and input task travels, also for a key
    that holds a large share of the table.
    """
    window = Window.partitionBy(*keys).orderBy(*(order or newest_first()))
    return rows.withColumn("_rn", F.row_number().over(window)).where("_rn = 1").drop("_rn")


def first_seen(
    stream: DataFrame,
    delay: str,
    keys: Sequence[str] = TRADE_KEY,
) -> DataFrame:
    """Streaming dedup with bounded state: the first version of a key wins.

    Equal to ``latest`` for exact redelivery inside ``delay``; a copy that
    arrives later passes through and is removed by the batch layers. The delay
    runs on the arrival clock, so no row is ever too late and none is lost.
    """
    arrived = stream.withColumn("_arrived", F.current_timestamp())
    unique = arrived.withWatermark("_arrived", delay).dropDuplicatesWithinWatermark(list(keys))
    return unique.drop("_arrived")


def unseen(rows: DataFrame, stored: DataFrame, keys: Sequence[str] = TRADE_KEY) -> DataFrame:
    """The rows whose key is not stored yet, however long ago it came."""
    return rows.join(stored.select(*keys), list(keys), "left_anti")
