"""Data tests: each gives the offending rows, so an empty result is a pass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def duplicates(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once."""
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def nulls(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Number of NULLs per column, for the columns that have any."""
    counted = rows.agg(*(F.count_if(F.col(c).isNull()).alias(c) for c in columns))
    return counted.unpivot([], list(columns), "column_name", "n").where("n > 0")


def orphans(rows: DataFrame, column: str, parents: DataFrame, parent_column: str) -> DataFrame:
    """Values of ``column`` without a parent row, and how many rows carry them.

    Child values are counted before the join, so a frequent value is one row.
    """
    values = (
        rows.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return values.join(
        parents.select(F.col(parent_column).alias("value")).distinct(), "value", "left_anti"
    )
