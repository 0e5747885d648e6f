"""Folders of a table as the storage lists them, through Hadoop's own file systems."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

_THREADS = 8


def _path(spark: SparkSession, path: str):
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()), found


def together(works: Iterable[Callable[[], object]]) -> None:
    """Run small pieces of work that wait for the storage or for jobs side by side; the first error is raised."""
    with ThreadPoolExecutor(_THREADS) as pool:
        for done in [pool.submit(work) for work in works]:
            done.result()


def exists(spark: SparkSession, path: str) -> bool:
    files, found = _path(spark, path)
    return files.exists(found)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly below, oldest first; none if the path is missing."""
    files, found = _path(spark, path)
    if not files.exists(found):
        return []
    listed = [s for s in files.listStatus(found) if s.isDirectory()]
    listed.sort(key=lambda s: (s.getModificationTime(), s.getPath().getName()))
    return [s.getPath().getName() for s in listed if s.getPath().getName()[0] not in "._"]


def files(spark: SparkSession, path: str) -> list[str]:
    """Names of the files directly below; none if the path is missing."""
    system, found = _path(spark, path)
    return [s.getPath().getName() for s in system.listStatus(found) if s.isFile()] if system.exists(found) else []


def write_text(spark: SparkSession, path: str, text: str) -> None:
    system, found = _path(spark, path)
    out = system.create(found, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str:
    system, found = _path(spark, path)
    source = system.open(found)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
    finally:
        source.close()


def delete(spark: SparkSession, path: str) -> None:
    files, found = _path(spark, path)
    files.delete(found, True)


def rename(spark: SparkSession, source: str, target: str) -> None:
    files, found = _path(spark, source)
    if not files.rename(found, _path(spark, target)[1]):
        raise OSError(f"{source} could not be renamed to {target}")


def values(spark: SparkSession, path: str, column: str) -> list[str]:
    """The values of the partition column whose folders lie directly below."""
    return [n.partition("=")[2] for n in folders(spark, path) if n.startswith(f"{column}=")]


def read_versions(
    spark: SparkSession, path: str, picked: list[str], schema: StructType | None = None, **options: str
) -> DataFrame | None:
    """The folders ``picked`` below a table's path, all read with ``schema`` if there is one; None without any."""
    if not picked:
        return None
    reader = spark.read.option("basePath", path).options(**options)
    reader = reader if schema is None else reader.schema(schema)
    return reader.parquet(*(f"{path}/{p}" for p in picked))


def drop_versions(spark: SparkSession, path: str, keep: int = 2) -> None:
    """Delete all but the last ``keep`` batches below a folder; readers may still be in the one before."""
    batches = sorted(int(b) for b in values(spark, path, "batch_id"))
    for batch in batches[:-keep]:
        delete(spark, f"{path}/batch_id={batch}")
