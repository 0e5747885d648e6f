"""Where a stream stands in its log, and what the log no longer had when the stream went on.

A consumer that is away for longer than the log keeps its records comes back to a log that begins behind its
place, and the source by itself goes on without a word. Here each batch is held against the position that the
batches before it left, per log partition, before anything of it is written: the log itself is not read for
it, only the smallest and largest offset of the batch. By policy a loss ends the query, which then stops at the same batch
again until it is told to go on, or it is recorded.

Positions and losses lie beside the table, in folders that carry the batch id, so a replay meets the position
its first run met and rewrites its own record.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.sinks import storage, tables

#: What a loss does: end the query before the batch is written, or leave a record of it.
FAIL, RECORD = "fail", "record"
LOSS = "kafka_partition int, kind string, first_lost bigint, last_lost bigint, batch_id bigint"
_NAMED = 5


class LogLoss(RuntimeError):
    """The log no longer has records that the stream was still to read."""


def ends(rows: DataFrame) -> DataFrame:
    """The smallest and the largest offset per log partition."""
    return rows.groupBy("kafka_partition").agg(
        F.min("kafka_offset").alias("first"), F.max("kafka_offset").alias("last")
    )


def losses(found: DataFrame, before: DataFrame, from_start: bool = True) -> DataFrame:
    """(kafka_partition, kind, first_lost, last_lost) of a batch's ``ends`` against the offsets that come next.

    ``gone``: the batch begins behind the position; the offsets between are lost. A log partition that has no position yet
    should begin at 0, unless the stream did not start from the beginning. ``rewound``: all of the batch lies
    before the position, so the log was made anew; the offsets that were not reached again are named.
    Offsets that miss in the middle of a batch are not what retention leaves; ``intervals.gaps`` shows those.
    """
    due = F.coalesce("next_offset", F.lit(0).cast("bigint") if from_start else F.col("first"))
    judged = found.join(before.select("kafka_partition", "next_offset"), "kafka_partition", "left").withColumn("due", due)
    gone = F.struct(F.lit("gone").alias("kind"), F.col("due").alias("first_lost"), (F.col("first") - 1).alias("last_lost"))
    rewound = F.struct(
        F.lit("rewound").alias("kind"), (F.col("last") + 1).alias("first_lost"), (F.col("due") - 1).alias("last_lost")
    )
    lost = F.when(F.col("first") > F.col("due"), gone).when(F.col("last") < F.col("due") - 1, rewound)
    return judged.withColumn("lost", lost).where("lost IS NOT NULL").select("kafka_partition", "lost.*")


def before_batch(spark: SparkSession, path: str, batch_id: int) -> DataFrame | None:
    """(kafka_partition, next_offset) as the batches before left it; None before the first."""
    batches = [b for b in map(int, storage.values(spark, f"{path}-position", "batch_id")) if b < batch_id]
    return storage.read_versions(spark, f"{path}-position", [f"batch_id={max(batches)}"] if batches else [])


def check(rows: DataFrame, path: str, batch_id: int, on_loss: str, from_start: bool = True) -> None:
    """Hold a batch against the position; raise ``LogLoss`` or record what is lost below ``path``-losses."""
    before = before_batch(rows.sparkSession, path, batch_id)
    if before is None:
        return
    lost = losses(ends(rows), before, from_start).withColumn("batch_id", F.lit(batch_id).cast("bigint"))
    if on_loss == RECORD:
        tables.overwrite_partitions(lost, f"{path}-losses", ["batch_id"])
        return
    named = lost.orderBy("kafka_partition").take(_NAMED)
    if named:
        what = ", ".join(f"{r.kind} {r.first_lost} to {r.last_lost} of partition {r.kafka_partition}" for r in named)
        raise LogLoss(f"the log is shorter than the checkpoint: {what}")


def advance(rows: DataFrame, path: str, batch_id: int) -> None:
    """Write the position after a batch: one row per log partition, also of those the batch did not touch."""
    spark = rows.sparkSession
    own = ends(rows).select("kafka_partition", (F.col("last") + 1).alias("next_offset"))
    before = before_batch(spark, path, batch_id)
    if before is not None:
        idle = before.select("kafka_partition", "next_offset").join(own, "kafka_partition", "left_anti")
        own = own.unionByName(idle)
    tables.overwrite_partitions(own.withColumn("batch_id", F.lit(batch_id).cast("bigint")), f"{path}-position", ["batch_id"])
    storage.drop_versions(spark, f"{path}-position")


def recorded(spark: SparkSession, path: str) -> DataFrame:
    """All losses on record; no rows if there is no record."""
    if not storage.values(spark, f"{path}-losses", "batch_id"):
        return spark.createDataFrame([], LOSS)
    return spark.read.schema(LOSS).parquet(f"{path}-losses")
