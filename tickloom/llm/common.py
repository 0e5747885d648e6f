"""What the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_type

from tickloom.session import scratch
from tickloom.sinks import storage

#: Bytes of text that one step of a vectorised operator takes at a time.
STEP_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@contextmanager
def swept(spark: SparkSession) -> Iterator[None]:
    """What is run inside has its shuffled data deleted as soon as it is done, not with the driver's next garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def written(frame: DataFrame, name: str, **options: str) -> DataFrame:
    """Cut the lineage: write to the shared folder and read again."""
    path = scratch(frame.sparkSession, name)
    with swept(frame.sparkSession):
        frame.write.options(**options).parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def forget(*frames: DataFrame) -> None:
    """Delete written tables whose rows nothing that is still to run reads."""
    for frame in frames:
        for folder in {file.rsplit("/", 1)[0] for file in frame.inputFiles()}:
            storage.delete(frame.sparkSession, folder)


def fresh(frame: DataFrame, *wanted: str) -> list[str]:
    """Names for working columns that no column of the frame has, whatever its case."""
    taken = {c.lower() for c in frame.columns}
    names = []
    for name in wanted:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        names.append(name)
    return names


def held_out(doc_id: Column) -> Column:
    """The fold that no model learns from; a null id is not in it."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def steps(texts: pa.Array, limit: int = STEP_BYTES) -> Iterator[list]:
    """Cut a batch into lists of about `limit` bytes; a longer text stands alone."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(texts), 0), dtype=np.int64)
    start, total = 0, 0
    for i, size in enumerate(sizes):
        if i > start and total + size > limit:
            yield texts[start:i].to_pylist()
            start, total = i, 0
        total += int(size)
    if start < len(texts):
        yield texts[start:].to_pylist()


def on_texts(
    work: Callable[[list], pa.Array], kind: pa.DataType, limit: int = STEP_BYTES
) -> Callable[[Column], Column]:
    """A column function from texts (as UTF-8 bytes, or None) to what `work` makes of a list of them.

    It counts as nondeterministic only so that the optimizer never runs it twice.
    """

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            parts = [work(part) for part in steps(batch, limit)]
            yield pa.concat_arrays(parts) if parts else pa.array([], type=kind)

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}

    def apply(text: Column) -> Column:
        function = F.arrow_udf(run, returnType=from_arrow_type(kind)).asNondeterministic()
        return function(text.cast("binary"))

    return apply


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def ragged(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For groups of these sizes laid end to end: each element's group, and its place there."""
    owner = np.repeat(np.arange(len(counts)), counts)
    starts = np.cumsum(counts) - counts
    return owner, np.arange(len(owner)) - starts[owner]


def numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """Rows with group `key`, plus `place` (from 0 in the order given) and `n` (rows of the group).

    The rows must be read from a written table: what tells equal rows apart is their place in it.
    """
    names = rows.columns
    told = rows.withColumn("_row", F.monotonically_increasing_id())
    spread = written(told, "rows").repartitionByRange("key", *order, "_row")
    inside = spread.sortWithinPartitions("key", *order, "_row").drop("_row")
    placed = written(inside.withColumn("_at", F.monotonically_increasing_id()), "sorted")
    placed = placed.withColumn("_part", F.shiftright("_at", 33))
    parts = placed.groupBy("key", "_part").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    # At most one row per group and partition.
    whole = Window.partitionBy("key")
    before = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumns(
        {"n": F.sum("_rows").over(whole), "_before": F.coalesce(F.sum("_rows").over(before), F.lit(0))}
    )
    place = F.col("_before") + F.col("_at") - F.col("_first")
    return placed.join(parts.drop("_rows"), ["key", "_part"]).select(*names, place.alias("place"), "n")
