"""Catalog tables: create, append, replace, overwrite partitions, commit log.

Everything runs on Parquet tables of the session catalog. With an Iceberg
catalog configured, ``iceberg=True`` uses the format's own replace instead; that
path needs a jar this repository does not ship and is untested.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tickloom.schema import ddl
from tickloom.sinks import storage

CODEC = "zstd"


def ensure_database(spark: SparkSession, table: str, root: str) -> None:
    database = table.rpartition(".")[0]
    if database:
        location = f"{root.rstrip('/')}/{database.replace('.', '/')}"
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{location}'")


def ensure(
    spark: SparkSession,
    name: str,
    schema: StructType,
    root: str,
    partition_by: Sequence[str] = (),
) -> DataFrame:
    """Create database and table when missing; an existing table is left alone."""
    ensure_database(spark, name, root)
    parts = f"PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({ddl(schema)}) USING parquet {parts} "
        f"LOCATION '{_version(root, name)}' TBLPROPERTIES ('parquet.compression' = '{CODEC}')"
    )
    return spark.table(name)


def replace(
    spark: SparkSession,
    name: str,
    rows: DataFrame,
    root: str,
    partition_by: Sequence[str] = (),
    iceberg: bool = False,
) -> None:
    """Replace the whole table.

    A replaced table is a view of its newest version. The new version is written beside the old one and
    the view is pointed at it in one catalog call, so readers always meet a whole table, a failed
    write leaves it as it was, and the rows may be computed from the table itself. The version before
    stays for queries that still read it; older ones are deleted.
    """
    if iceberg:
        writer = rows.writeTo(name).using("iceberg").tableProperty("format-version", "2")
        writer = writer.tableProperty("write.parquet.compression-codec", CODEC)
        if partition_by:
            writer = writer.partitionedBy(*(F.col(c) for c in partition_by))
        writer.createOrReplace()
        return
    path = _version(root, name)
    write(rows, path, partition_by, mode="errorifexists")
    ensure_database(spark, name, root)
    if spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType != "VIEW":
        spark.sql(f"DROP TABLE {name}")  # once, when a table that was filled otherwise becomes a replaced one
    columns = ", ".join(f"`{c}`" for c in rows.columns)
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT {columns} FROM parquet.`{path}`")
    parent = path.rpartition("/")[0]
    for version in storage.folders(spark, parent)[:-2]:
        storage.delete(spark, f"{parent}/{version}")


def write(
    rows: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    mode: str = "append",
    sort_by: Sequence[str] = (),
) -> None:
    """Parquet with one partition folder per value combination.

    ``sort_by`` clusters rows inside the files for row-group pruning.
    """
    _laid_out(rows, partition_by, sort_by).write.mode(mode).option(
        "compression", CODEC
    ).partitionBy(*partition_by).parquet(path)


def append(spark: SparkSession, name: str, rows: DataFrame) -> None:
    """Append to an existing table, matching columns by name, few files per partition."""
    parts = [c.name for c in spark.catalog.listColumns(name) if c.isPartition]
    _laid_out(rows.select(*spark.table(name).columns), parts, ()).write.insertInto(name)


def overwrite_partitions(
    rows: DataFrame, path: str, partition_by: Sequence[str], sort_by: Sequence[str] = ()
) -> None:
    """Replace only the partition folders that ``rows`` has values for, so that a
    repeated run for the same day or batch leaves one copy."""
    (
        _laid_out(rows, partition_by, sort_by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", CODEC)
        .partitionBy(*partition_by)
        .parquet(path)
    )


def write_bucketed(
    rows: DataFrame, name: str, root: str, by: str, buckets: int = 16, sort_by: Sequence[str] = ()
) -> None:
    """Replace a catalog table whose files are dealt by the hash of a column, each file sorted. Aggregations, windows
    and joins on that column, or on it and others, then need no exchange. All rows of a value lie in one bucket, so
    the column must have many values of like size; ``bucket_sizes`` measures that."""
    spark = rows.sparkSession
    ensure_database(spark, name, root)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    # One task per bucket writes one file per bucket.
    writer = rows.repartition(buckets, by).write.format("parquet").mode("errorifexists")
    writer = writer.bucketBy(buckets, by).sortBy(*(sort_by or [by])).option("compression", CODEC)
    writer.option("path", _version(root, name)).saveAsTable(name)


def bucket_sizes(spark: SparkSession, name: str, by: str) -> DataFrame:
    """Rows and values per bucket file, to see whether some values hold too much of a table."""
    rows = spark.table(name).groupBy(F.col("_metadata.file_name").alias("file"), by).agg(F.count(F.lit(1)).alias("n"))
    return rows.groupBy("file").agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("values"), F.max("n").alias("largest"))


def upsert(rows: DataFrame, path: str, key: str, batch_id: int, buckets: int = 64) -> None:
    """Put rows in place of stored ones with the same key. Keys lie in buckets; only buckets that receive rows are
    read and written, each as a new version below its batch id. A replay starts from earlier versions."""
    spark, own = rows.sparkSession, F.lit(batch_id).cast("bigint")
    placed = rows.withColumn("bucket", F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")).persist()
    try:
        touched = [r["bucket"] for r in placed.select("bucket").distinct().collect()]
        stored = storage.read_versions(spark, path, _newest(spark, path, touched, batch_id))
        if stored is not None:
            placed = stored.select(*placed.columns).join(placed.select(key), key, "left_anti").unionByName(placed)
        if touched:
            overwrite_partitions(placed.withColumn("batch_id", own), path, ["bucket", "batch_id"])
    finally:
        placed.unpersist()
    for bucket in touched:
        storage.drop_versions(spark, f"{path}/bucket={bucket}")


def upserted(spark: SparkSession, path: str) -> DataFrame | None:
    """The rows as they are now: the newest version of every bucket."""
    buckets = [int(b) for b in storage.values(spark, path, "bucket")]
    found = storage.read_versions(spark, path, _newest(spark, path, buckets))
    return None if found is None else found.drop("bucket", "batch_id")


def _newest(spark: SparkSession, path: str, buckets: Sequence[int], before: int | None = None) -> list[str]:
    picked = []
    for bucket in buckets:
        batches = [int(b) for b in storage.values(spark, f"{path}/bucket={bucket}", "batch_id")]
        batches = [b for b in batches if before is None or b < before]
        if batches:
            picked.append(f"bucket={bucket}/batch_id={max(batches)}")
    return picked


def _laid_out(rows: DataFrame, partition_by: Sequence[str], sort_by: Sequence[str]) -> DataFrame:
    """Rebalanced by the partition columns: few files per folder, and adaptive
    execution splits a folder that holds much of the data over several tasks."""
    if partition_by:
        rows = rows.hint("rebalance", *(F.col(c) for c in partition_by))
    if sort_by:
        rows = rows.sortWithinPartitions(*partition_by, *sort_by)
    return rows


def partition_layout(rows: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Which partition folders exist, and how many files and rows each holds.

    One small row per task, folder and file is exchanged, none per trade.
    """
    files = rows.groupBy(*partition_by, F.col("_metadata.file_path").alias("file")).agg(F.count(F.lit(1)).alias("n"))
    return files.groupBy(*partition_by).agg(F.count(F.lit(1)).alias("files"), F.sum("n").alias("rows"))


def databases(spark: SparkSession) -> DataFrame:
    return spark.sql("SHOW DATABASES")


def record_commit(spark: SparkSession, path: str, snapshot_id: int, operation: str, added: int) -> None:
    """One row per committed batch; writing the same snapshot again replaces it."""
    row = spark.range(1).select(
        F.current_timestamp().alias("committed_at"),
        F.lit(snapshot_id).cast("bigint").alias("snapshot_id"),
        F.lit(operation).alias("operation"),
        F.create_map(F.lit("added-records"), F.lit(str(added))).alias("summary"),
        F.lit(snapshot_id).cast("bigint").alias("commit"),
    )
    overwrite_partitions(row, path, ["commit"])


def _version(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name.replace('.', '/')}/version-{uuid.uuid4().hex}"
