"""Upkeep of stored tables: states, file sizes, expiry, incremental Silver."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.operators import dedup, ohlcv
from tickloom.operators.retention import oldest_date
from tickloom.plans import layers
from tickloom.sinks import storage, tables, tiers

TARGET_FILE_BYTES = 128 * 1024 * 1024


def compact_states(spark: SparkSession, path: str, day: date) -> None:
    """Merge all state rows of one day, from whatever batches, into one row per symbol and minute.

    For tables whose batches hold parts of a day, in tiers or not; without tiers the day must be closed to
    writers.
    """
    folder = f"{path}/dt={day.isoformat()}"
    if tiers.is_tiered(spark, folder):
        tiers.merge_all(spark, path, day.isoformat(), None, ohlcv.merge_states, ["symbol", "bucket_ts"])
        return
    merged = ohlcv.merge_states(spark.read.parquet(folder))
    _swap_folder(merged.withColumn("batch_id", F.lit(-1).cast("bigint")), folder, ["batch_id"])


def compact_files(
    spark: SparkSession, folder: str, sort_by: list[str] | None = None, target: int = TARGET_FILE_BYTES
) -> int:
    """Rewrite one folder of a table into files of about ``target`` bytes.

    The folder must be closed to writers. A day level below it stays; a batch level becomes the
    single batch -1, so that all folders of the table keep one layout. A day in tiers is not for this
    function, as its folders count only if the manifest lists them: ``tiers.merge_all`` rewrites it.
    """
    inner = [folder, *(f"{folder}/dt={day}" for day in storage.values(spark, folder, "dt"))]
    if any(tiers.is_tiered(spark, f) for f in inner):
        raise ValueError(f"{folder} is kept in tiers")
    rows = spark.read.parquet(folder)
    levels = [c for c in ("dt", "batch_id") if c in rows.columns]
    if "batch_id" in levels:
        rows = rows.withColumn("batch_id", F.lit(-1).cast("bigint"))
    files = max(1, -(-folder_bytes(spark, folder) // target))
    order = [*levels, *(sort_by or [])]
    if order:
        rows = rows.repartitionByRange(files, *order).sortWithinPartitions(*order)
    else:
        rows = rows.repartition(files)
    _swap_folder(rows, folder, levels)
    return files


def folder_bytes(spark: SparkSession, folder: str) -> int:
    """Size of the data files below a folder, from the file source's metadata."""
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    return listing.agg(F.sum("length").alias("bytes")).first()["bytes"] or 0


def expire_folders(spark: SparkSession, path: str, as_of: datetime, days: int = 7) -> list[str]:
    """Delete the ``dt`` folders below a path in which every row has expired, with all batches in
    them; returns the days that are gone."""
    limit = oldest_date(as_of, days).isoformat()
    old = sorted(day for day in storage.values(spark, path, "dt") if day < limit)
    for day in old:
        storage.delete(spark, f"{path}/dt={day}")
    left = set(storage.values(spark, path, "dt"))
    return [day for day in old if day not in left]


def expire_partitions(spark: SparkSession, table: str, as_of: datetime, days: int = 7) -> list[str]:
    """Drop the partitions of a catalog table in which every row has expired, and their folders.

    Partitions may have further levels below or above ``dt``. Returns the days that are gone.
    """
    limit = oldest_date(as_of, days).isoformat()

    def expired() -> list[dict[str, str]]:
        listed = [r.partition for r in spark.sql(f"SHOW PARTITIONS {table}").collect()]
        specs = [dict(level.split("=", 1) for level in p.split("/")) for p in listed]
        return [spec for spec in specs if spec["dt"] < limit]

    before = expired()
    for spec in before:
        named = ", ".join(f"{column} = '{value}'" for column, value in spec.items())
        described = spark.sql(f"DESCRIBE FORMATTED {table} PARTITION ({named})").collect()
        # The partition's own location comes before that of the table.
        folder, whole = [r.data_type for r in described if r.col_name == "Location"][:2]
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({named})")
        if folder != whole and f"dt={spec['dt']}" in folder:
            storage.delete(spark, folder)
    left = {spec["dt"] for spec in expired()}
    return sorted({spec["dt"] for spec in before} - left)


def merge_silver(spark: SparkSession, path: str, new_bronze: DataFrame) -> None:
    """Bring new Bronze rows into a Silver folder laid out by ``symbol`` and ``dt``.

    The stored rows carry their log position, so a key keeps the version that a full rebuild would
    keep, in whatever order blocks come. Only folders that receive rows are read and replaced. ``dt`` is
    the trade date, which a redelivered trade keeps, so a key never changes folder.
    """
    fresh = layers.silver(new_bronze, positions=True).withColumn("dt", F.to_date("trade_time"))
    touched = fresh.select("symbol", "dt").distinct()
    days = [r.dt for r in touched.select("dt").distinct().collect()]
    if not days:
        return
    # The dates prune folders when the query is planned, the join the rest.
    stored = (
        spark.read.schema(fresh.schema)
        .parquet(path)
        .where(F.col("dt").isin(days))
        .join(touched, ["symbol", "dt"], "left_semi")
    )
    tables.overwrite_partitions(dedup.latest(stored.unionByName(fresh)), path, ["symbol", "dt"])


def rebuild_states(silver: DataFrame, path: str, day: date) -> None:
    """Minute states of one day computed again from Silver.

    Repairs volumes after copies that came later than the stream's dedup delay.
    """
    start = F.lit(day).cast("timestamp")
    inside = (F.col("trade_time") >= start) & (F.col("trade_time") < start + F.make_dt_interval(F.lit(1)))
    states = ohlcv.partial(silver.where(inside))
    states = states.withColumn("batch_id", F.lit(-1).cast("bigint"))
    _swap_folder(states, f"{path}/dt={day.isoformat()}", ["batch_id"])


def read_evolving(spark: SparkSession, path: str) -> DataFrame:
    """A folder whose files gained columns over time, read with the union of them."""
    return spark.read.option("mergeSchema", "true").parquet(path)


def _swap_folder(rows: DataFrame, folder: str, partition_by: list[str] | None = None) -> None:
    """Put new contents in a folder's place.

    They are complete beside it, under a name that readers skip, before two renames; the old ones are
    deleted last. A crash in between leaves both; ``recover_folder`` puts back what is missing.
    """
    spark = rows.sparkSession
    parent, _, name = folder.rstrip("/").rpartition("/")
    staged, old = f"{parent}/_new-{name}", f"{parent}/_old-{name}"
    writer = rows.write.mode("overwrite").option("compression", tables.CODEC)
    writer.option("partitionOverwriteMode", "static").partitionBy(*(partition_by or [])).parquet(staged)
    storage.delete(spark, old)
    storage.rename(spark, folder, old)
    storage.rename(spark, staged, folder)
    storage.delete(spark, old)


def recover_folder(spark: SparkSession, folder: str) -> None:
    """After a crash between the two renames of a rewrite: put the old contents back."""
    parent, _, name = folder.rstrip("/").rpartition("/")
    if not storage.exists(spark, folder) and storage.exists(spark, f"{parent}/_old-{name}"):
        storage.rename(spark, f"{parent}/_old-{name}", folder)
