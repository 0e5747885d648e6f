"""Comparing two layers by content, in any order of rows, without joining what is equal."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SUMS = ["rows", "low", "high", "mixed"]


def fingerprints(rows: DataFrame, by: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """A hash of the multiset of rows per group: their number, the sums of both halves of their hashes, and
    their exclusive or. Those of blocks are merged by ``merge``; order and block borders do not matter."""
    # A null and a missing value must not look alike, so each value comes with a flag.
    parts = [part for c in columns for part in (F.col(c).isNull(), F.col(c))]
    h, again = F.xxhash64(*parts), F.xxhash64(F.lit(1), *parts)
    hashed = rows.select(*by, h.alias("h"), again.alias("again"))
    return hashed.groupBy(*by).agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(F.col("h").bitwiseAND(F.lit(0xFFFFFFFF))).alias("low"),
        F.sum(F.shiftrightunsigned("h", 32)).alias("high"),
        F.bit_xor("again").alias("mixed"),
    )


def merge(found: DataFrame, by: Sequence[str]) -> DataFrame:
    sums = [F.sum(c).alias(c) for c in _SUMS[:3]]
    return found.groupBy(*by).agg(*sums, F.bit_xor("mixed").alias("mixed"))


def differing(left: DataFrame, right: DataFrame, by: Sequence[str]) -> DataFrame:
    """The groups whose fingerprints differ, or that only one side has."""
    sides = left.withColumn("_side", F.lit(1)).unionByName(right.withColumn("_side", F.lit(2)))
    grouped = sides.groupBy(*by).agg(
        F.count(F.lit(1)).alias("_n"), *(F.count_distinct(c).alias(f"_{c}") for c in _SUMS)
    )
    same = F.col("_n") == 2
    for c in _SUMS:
        same = same & (F.col(f"_{c}") == 1)
    return grouped.where(~same).select(*by)


def differences(
    left: DataFrame, right: DataFrame, by: Sequence[str], key: Sequence[str], columns: Sequence[str]
) -> DataFrame:
    """(by, key, column, left_value, right_value) for each value that differs, and one row with the column
    ``row`` for a key that one side lacks. Only groups whose fingerprints differ are opened.

    The key must be unique on each side; ``by`` is part of it.
    """
    wanted = differing(fingerprints(left, by, [*key, *columns]), fingerprints(right, by, [*key, *columns]), by)

    def opened(rows: DataFrame, side: str) -> DataFrame:
        values = F.struct(*(F.col(c).cast("string").alias(c) for c in columns)).alias(side)
        return rows.join(wanted, list(by), "left_semi").select(*by, *key, values)

    both = opened(left, "l").join(opened(right, "r"), [*by, *key], "full_outer")

    def change(name: str, a: Column, b: Column) -> Column:
        return F.when(~a.eqNullSafe(b), F.struct(F.lit(name).alias("column"), a.alias("left_value"), b.alias("right_value")))

    def side(name: str) -> Column:
        return F.when(F.col(name).isNotNull(), F.lit("present"))

    lacking = F.col("l").isNull() | F.col("r").isNull()
    whole = F.array(change("row", side("l"), side("r")))
    values = F.array(*(change(c, F.col("l")[c], F.col("r")[c]) for c in columns))
    found = both.select(*by, *key, F.explode(F.array_compact(F.when(lacking, whole).otherwise(values))).alias("d"))
    return found.select(*by, *key, "d.*")
