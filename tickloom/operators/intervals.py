"""Sets of log offsets as sorted disjoint ranges, per log partition.

Ranges are cut at blocks of BLOCK offsets, so sets are built, merged and asked block by block, and a busy log
partition is spread over all tasks. A set says which offsets are missing without the records.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 1 << 20
COLUMNS = ["kafka_partition", "block", "first", "last"]


def of(rows: DataFrame, *by: str) -> DataFrame:
    """The offsets of log records; ``by`` names columns that have sets of their own."""
    single = rows.select(
        *by,
        "kafka_partition",
        F.expr(f"kafka_offset div {BLOCK}L").alias("block"),
        F.col("kafka_offset").alias("first"),
        F.col("kafka_offset").alias("last"),
    )
    return merged(single.distinct(), *by)


def merged(ranges: DataFrame, *by: str) -> DataFrame:
    """Ranges that overlap or touch inside their block become one."""
    inside = Window.partitionBy(*by, "kafka_partition", "block").orderBy("first", "last")
    before = inside.rowsBetween(Window.unboundedPreceding, -1)
    starts = F.coalesce(F.col("first") > F.max("last").over(before) + 1, F.lit(True))
    numbered = ranges.withColumn("_start", starts.cast("int"))
    numbered = numbered.withColumn("_run", F.sum("_start").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    runs = numbered.groupBy(*by, "kafka_partition", "block", "_run")
    return runs.agg(F.min("first").alias("first"), F.max("last").alias("last")).drop("_run")


def gaps(ranges: DataFrame) -> DataFrame:
    """Where each run of missing offsets begins and ends, from merged ranges.

    Ranges look inside their block, then blocks at the next one that has any: one row per block.
    """
    inside = Window.partitionBy("kafka_partition", "block").orderBy("first")
    ahead = ranges.withColumn("_next", F.lead("first").over(inside))
    blocks = ranges.groupBy("kafka_partition", "block").agg(F.min("first").alias("first"), F.max("last").alias("last"))
    beyond = Window.partitionBy("kafka_partition").orderBy("block")
    blocks = blocks.withColumn("_next", F.lead("first").over(beyond))
    edges = ahead.where("_next IS NOT NULL").select("kafka_partition", "last", "_next")
    edges = edges.unionByName(blocks.where("_next IS NOT NULL").select("kafka_partition", "last", "_next"))
    return edges.where("_next > last + 1").select(
        "kafka_partition", (F.col("last") + 1).alias("gap_start"), (F.col("_next") - 1).alias("gap_end")
    )
