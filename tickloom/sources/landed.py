"""REST answers landed as files, one whole answer per file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def kline_responses(spark: SparkSession, path: str) -> DataFrame:
    """Files below ``symbol=S/dt=D/``: columns ``symbol``, ``dt``, ``body``.

    An answer holds at most one page of candles, so a whole file is a small row.
    """
    return spark.read.text(path, wholetext=True).select("symbol", "dt", F.col("value").alias("body"))


def market_objects(spark: SparkSession, path: str) -> DataFrame:
    """Files below ``dt=D/hour=HH/``, each an array of coins: one row per coin object.

    A snapshot keeps its own instant, which the file name holds (``20240101T051500``); without one it
    is that of the folder. A file that is no array is one row with its whole text.
    """
    answers = spark.read.text(path, wholetext=True)
    hour = F.make_dt_interval(hours=F.col("hour").cast("int"))
    name = F.regexp_extract(F.col("_metadata.file_name"), r"(\d{8}T\d{6})", 1)
    own = F.try_to_timestamp(name, F.lit("yyyyMMdd'T'HHmmss"))
    items = F.from_json("value", "array<string>")
    return answers.where(items.isNull() | (F.size(items) > 0)).select(
        F.explode(F.coalesce(items, F.array("value"))).alias("value"),
        F.coalesce(own, F.col("dt").cast("date").cast("timestamp") + hour).alias("snapshot_ts"),
    )
