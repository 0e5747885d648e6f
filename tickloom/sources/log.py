"""The message log and the raw feed, as batch or streaming frames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tickloom.schema import LOG


def kafka_log(
    spark: SparkSession,
    servers: str,
    topic: str,
    starting: str = "earliest",
    streaming: bool = True,
    **options: str,
) -> DataFrame:
    """Log records from Kafka; needs the connector on the classpath (untested here).

    Lost offsets do not stop the query; ``audit.offset_coverage`` shows them.
    """
    reader = spark.readStream if streaming else spark.read
    return (
        reader.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
        .option("failOnDataLoss", "false")
        .options(**options)
        .load()
    )


def file_log(spark: SparkSession, path: str, streaming: bool = True, **options: str) -> DataFrame:
    """The same columns from JSON-lines files that keep arriving in a folder."""
    reader = spark.readStream if streaming else spark.read
    return reader.schema(LOG).options(**options).json(path)


def feed(spark: SparkSession, path: str, streaming: bool = True, **options: str) -> DataFrame:
    """Raw exchange lines (one column, ``value``)."""
    reader = spark.readStream if streaming else spark.read
    return reader.options(**options).text(path)
