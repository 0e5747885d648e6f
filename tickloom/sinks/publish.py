"""Sinks outside the lake: keyed messages and JDBC tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Delivery settings of the message producer.
PRODUCER = {
    "kafka.acks": "all",
    "kafka.enable.idempotence": "true",
    "kafka.compression.type": "gzip",
    "kafka.linger.ms": "50",
}
JDBC_BATCH = 2000


def to_kafka(messages: DataFrame, servers: str, topic: str) -> None:
    """Key and value to a Kafka topic; needs the connector (untested here)."""
    (
        messages.write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .options(**PRODUCER)
        .save()
    )


def to_files(messages: DataFrame, path: str, mode: str = "append") -> None:
    messages.select("key", "value").write.mode(mode).json(path)


def to_jdbc(rows: DataFrame, url: str, table: str, **options: str) -> None:
    """Plain append, at least once: readers keep the latest version per key."""
    (
        rows.write.format("jdbc")
        .option("url", url)
        .option("dbtable", table)
        .option("batchsize", str(JDBC_BATCH))
        .option("isolationLevel", "NONE")
        .options(**options)
        .mode("append")
        .save()
    )


def jdbc_row(hot: DataFrame) -> DataFrame:
    """The hot row as the serving store types it: the flag becomes 0 or 1."""
    return hot.withColumn("is_buyer_maker", F.col("is_buyer_maker").cast("int"))
