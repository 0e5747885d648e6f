"""A table that a stream writes batch by batch, kept in few folders while it runs.

Below each day lie folders ``tier=T/batch_id=N``. A batch adds one of tier 0; when a tier of a day has FAN
folders, they are merged into one of the next tier, named by the last batch in it. So a day has at most
FAN - 1 folders a tier, a number that grows with the logarithm of its batches, and a row is rewritten once
per tier. What merging means is the caller's: rows are put together, partial states combined.

Readers follow the day's manifest, the list of folders that count, which is switched by renaming a complete
file to the next version. Folders of the version before stay for readers that still use them.

One stream writes a table. A batch that is run again writes its own folder again and finds itself listed.
Merging leaves the folders of the running batch alone, so a replay reads what its first run read. A crash
before a switch leaves a folder that no manifest lists; it is written over, or swept with a later merge.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tickloom.sinks import storage, tables

FAN = 4
_MANIFEST = "_manifest"


def _versions(spark: SparkSession, path: str, day: str) -> list[str]:
    return sorted(n for n in storage.files(spark, f"{path}/dt={day}/{_MANIFEST}") if n.startswith("v"))


def _listed(spark: SparkSession, path: str, day: str, version: str) -> list[str]:
    return storage.read_text(spark, f"{path}/dt={day}/{_MANIFEST}/{version}").split()


def _batch(name: str) -> int:
    return int(name.rpartition("=")[2])


def _tier(name: str) -> int:
    return int(name.partition("/")[0].partition("=")[2])


def folders(spark: SparkSession, path: str, day: str, before: int | None = None) -> list[str]:
    """The folders of a day that count, oldest batch first; only those of batches below ``before``."""
    versions = _versions(spark, path, day)
    listed = _listed(spark, path, day, versions[-1]) if versions else []
    return sorted((n for n in listed if before is None or _batch(n) < before), key=_batch)


def _switch(spark: SparkSession, path: str, day: str, names: list[str]) -> None:
    """From the listed folders to these, in one rename; only the version before is kept."""
    versions, folder = _versions(spark, path, day), f"{path}/dt={day}/{_MANIFEST}"
    number = int(versions[-1][1:]) + 1 if versions else 0
    storage.write_text(spark, f"{folder}/_next", "\n".join(names))
    storage.rename(spark, f"{folder}/_next", f"{folder}/v{number:012d}")
    for old in versions[:-1]:
        storage.delete(spark, f"{folder}/{old}")


def days(spark: SparkSession, path: str) -> list[str]:
    return storage.values(spark, path, "dt")


def is_tiered(spark: SparkSession, day_folder: str) -> bool:
    return storage.exists(spark, f"{day_folder}/{_MANIFEST}")


def read(
    spark: SparkSession,
    path: str,
    only: Sequence[str] | None = None,
    before: int | None = None,
    schema: StructType | None = None,
) -> DataFrame | None:
    """The rows of all days, or of some; ``batch_id`` is the last batch a row's folder holds. None without any.

    ``schema`` gives the columns when the files have not all the same ones.
    """
    picked = [
        f"dt={day}/{name}"
        for day in (days(spark, path) if only is None else only)
        for name in folders(spark, path, day, before)
    ]
    found = storage.read_versions(spark, path, picked, schema)
    return None if found is None else found.drop("tier")


def append(
    rows: DataFrame, path: str, batch_id: int, touched: Sequence[str], sort_by: Sequence[str] = ()
) -> None:
    """Add the rows of one batch, by their column ``dt``; ``touched`` names the days they have."""
    spark = rows.sparkSession
    placed = rows.withColumns({"tier": F.lit(0), "batch_id": F.lit(batch_id).cast("bigint")})
    tables.overwrite_partitions(placed, path, ["dt", "tier", "batch_id"], sort_by)
    own = f"tier=0/batch_id={batch_id}"

    def list_in(day: str) -> None:
        names = folders(spark, path, day)
        if own not in names:
            _switch(spark, path, day, [*names, own])

    storage.together([partial(list_in, day) for day in touched])


def merge(
    spark: SparkSession,
    path: str,
    day: str,
    before: int | None = None,
    combine: Callable[[DataFrame], DataFrame] | None = None,
    sort_by: Sequence[str] = (),
    fan: int = FAN,
) -> None:
    """Merge tiers of a day that have ``fan`` folders of batches below ``before``, from the lowest up."""
    while True:
        tiers: dict[int, list[str]] = {}
        for name in folders(spark, path, day, before):
            tiers.setdefault(_tier(name), []).append(name)
        full = sorted(t for t, names in tiers.items() if len(names) >= fan)
        if not full:
            return
        _merged(spark, path, day, tiers[full[0]], full[0] + 1, combine, sort_by)


def merge_all(
    spark: SparkSession,
    path: str,
    day: str,
    before: int | None = None,
    combine: Callable[[DataFrame], DataFrame] | None = None,
    sort_by: Sequence[str] = (),
) -> None:
    """All folders of a day as one."""
    names = folders(spark, path, day, before)
    if len(names) > 1:
        _merged(spark, path, day, names, max(map(_tier, names)) + 1, combine, sort_by)


def merge_days(
    spark: SparkSession,
    path: str,
    combine: Callable[[DataFrame], DataFrame] | None = None,
    sort_by: Sequence[str] = (),
) -> None:
    """``merge_all`` for every day. Days whose merged folders have the same name are one job, as a job for each would
    leave a cluster idle; so ``combine`` gets rows of several days, and keeps their ``dt``."""
    alike: dict[tuple[int, int], dict[str, list[str]]] = {}
    for day in days(spark, path):
        names = folders(spark, path, day)
        if len(names) > 1:
            target = max(map(_tier, names)) + 1, max(map(_batch, names))
            alike.setdefault(target, {})[day] = names
    for (tier, batch), picked in alike.items():
        found = [f"dt={day}/{n}" for day, names in picked.items() for n in names]
        rows = storage.read_versions(spark, path, found, mergeSchema="true").drop("tier", "batch_id")
        rows = rows if combine is None else combine(rows)
        placed = rows.withColumns({"tier": F.lit(tier), "batch_id": F.lit(batch).cast("bigint")})
        tables.overwrite_partitions(placed, path, ["dt", "tier", "batch_id"], sort_by)
        storage.together([partial(_replace, spark, path, day, names, tier, batch) for day, names in picked.items()])


def _replace(spark: SparkSession, path: str, day: str, picked: list[str], tier: int, batch: int) -> None:
    """List the merged folder in place of those picked; whatever was added meanwhile stays listed."""
    rest = [n for n in folders(spark, path, day) if n not in picked]
    _switch(spark, path, day, [*rest, f"tier={tier}/batch_id={batch}"])
    sweep(spark, path, day)


def rewrite(
    spark: SparkSession, path: str, day: str, change: Callable[[DataFrame], DataFrame], sort_by: Sequence[str] = ()
) -> None:
    """What ``change`` makes of a day's rows, as one folder; a day without folders is left alone."""
    names = folders(spark, path, day)
    if names:
        _merged(spark, path, day, names, max(map(_tier, names)) + 1, change, sort_by)


def _merged(
    spark: SparkSession,
    path: str,
    day: str,
    picked: list[str],
    tier: int,
    combine: Callable[[DataFrame], DataFrame] | None,
    sort_by: Sequence[str],
) -> None:
    batch = max(map(_batch, picked))
    target = f"tier={tier}/batch_id={batch}"
    # Folders of before and after a change of the schema may meet here: the union of their columns goes on.
    rows = storage.read_versions(spark, path, [f"dt={day}/{n}" for n in picked], mergeSchema="true")
    rows = rows.drop("dt", "tier", "batch_id")
    rows = rows if combine is None else combine(rows)
    rows = rows.hint("rebalance")
    rows = rows.sortWithinPartitions(*sort_by) if sort_by else rows
    rows.write.mode("overwrite").option("compression", tables.CODEC).parquet(f"{path}/dt={day}/{target}")
    _replace(spark, path, day, picked, tier, batch)


def sweep(spark: SparkSession, path: str, day: str) -> None:
    """Delete the folders that neither the manifest nor the one before lists."""
    kept = {n for version in _versions(spark, path, day)[-2:] for n in _listed(spark, path, day, version)}
    for tier in storage.values(spark, f"{path}/dt={day}", "tier"):
        for batch in storage.values(spark, f"{path}/dt={day}/tier={tier}", "batch_id"):
            if f"tier={tier}/batch_id={batch}" not in kept:
                storage.delete(spark, f"{path}/dt={day}/tier={tier}/batch_id={batch}")
