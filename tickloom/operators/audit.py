"""Profiles, reconciliation, log coverage and health of the tables."""

from __future__ import annotations

from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def row_count(rows: DataFrame) -> DataFrame:
    return rows.agg(F.count(F.lit(1)).alias("n"))


def profile(bronze: DataFrame) -> DataFrame:
    return (
        bronze.groupBy("symbol")
        .agg(
            F.count(F.lit(1)).alias("trades"),
            F.round(F.min("price"), 4).alias("lo_price"),
            F.round(F.max("price"), 4).alias("hi_price"),
            F.min("kafka_timestamp").alias("first_seen"),
            F.max("kafka_timestamp").alias("last_seen"),
        )
        .orderBy("symbol")
    )


def reconcile(bronze: DataFrame) -> DataFrame:
    """Rows per symbol, and how many are left when redelivered ones are removed.

    Counting needs no whole rows: one row per trade goes on, then one per symbol.
    """
    trades = bronze.groupBy("symbol", "trade_id").agg(F.count(F.lit(1)).alias("n"))
    counted = trades.groupBy("symbol").agg(
        F.sum("n").alias("bronze_rows"), F.count(F.lit(1)).alias("silver_rows")
    )
    return counted.withColumn("removed", F.col("bronze_rows") - F.col("silver_rows"))


def offset_coverage(bronze: DataFrame) -> DataFrame:
    """First, last and next offset per log partition, and how many are missing.

    Offsets are made distinct on (partition, offset), which spreads a busy log
    partition over all tasks; the second step is a plain combine.
    """
    offsets = bronze.groupBy("kafka_partition", "kafka_offset").agg(F.count(F.lit(1)).alias("n"))
    return (
        offsets.groupBy("kafka_partition")
        .agg(
            F.min("kafka_offset").alias("first_offset"),
            F.max("kafka_offset").alias("last_offset"),
            F.sum("n").alias("records"),
            F.count(F.lit(1)).alias("_distinct"),
        )
        .withColumns(
            {
                "next_offset": F.col("last_offset") + 1,
                "missing": F.col("last_offset") - F.col("first_offset") + 1 - F.col("_distinct"),
            }
        )
        .drop("_distinct")
    )


def offset_gaps(bronze: DataFrame) -> DataFrame:
    """Where each run of missing offsets begins.

    Every offset names its successor, the last one of a log partition itself (it ends no gap). A
    successor that nobody is begins a gap. Keys are spread evenly, where a window per log partition
    would sort it in one task.
    """
    offsets = bronze.select("kafka_partition", "kafka_offset")
    last = offsets.groupBy("kafka_partition").agg(F.max("kafka_offset").alias("last"))
    named = offsets.select(
        "kafka_partition", F.explode(F.array(F.lit(0), F.lit(1))).alias("next"), "kafka_offset"
    ).select("kafka_partition", (F.col("kafka_offset") + F.col("next")).alias("kafka_offset"), "next")
    seen = named.groupBy("kafka_partition", "kafka_offset").agg(F.min("next").alias("next"))
    ends = last.select("kafka_partition", (F.col("last") + 1).alias("kafka_offset"))
    return (
        seen.where("next = 1")
        .join(ends, ["kafka_partition", "kafka_offset"], "left_anti")
        .select("kafka_partition", F.col("kafka_offset").alias("gap_start"))
    )


def health(spark: SparkSession, tables: dict[str, Callable[[], DataFrame]]) -> DataFrame:
    """One row per table: pass with rows, warn when empty, fail (and 0) when unreadable.

    Every table is counted by itself when this is called, so a corrupt file fails its own row only.
    """
    found = []
    for name, read in tables.items():
        try:
            count = read().count()
            found.append((name, count, "pass" if count else "warn"))
        except (PySparkException, Py4JJavaError):
            found.append((name, 0, "fail"))
    return spark.createDataFrame(found, "table_name string, row_count bigint, status string")


def commit_history(commits: DataFrame) -> DataFrame:
    """Snapshots in commit order, with the number of rows each one added."""
    return commits.select(
        "committed_at",
        "snapshot_id",
        "operation",
        F.col("summary")["added-records"].alias("added"),
    ).orderBy("committed_at")
