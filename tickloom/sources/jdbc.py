"""Reading a JDBC table in parallel."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read(
    spark: SparkSession,
    url: str,
    table: str,
    column: str,
    lower: int | str,
    upper: int | str,
    partitions: int,
    **options: str,
) -> DataFrame:
    """Each task reads one range of ``column``; the bounds only set the stride,
    rows outside them are still read."""
    return (
        spark.read.format("jdbc")
        .option("url", url)
        .option("dbtable", table)
        .option("partitionColumn", column)
        .option("lowerBound", str(lower))
        .option("upperBound", str(upper))
        .option("numPartitions", str(partitions))
        .options(**options)
        .load()
    )
