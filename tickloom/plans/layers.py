"""The batch layers, composed: Bronze -> Silver -> staging -> Gold."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tickloom.operators import dedup, normalize, ohlcv
from tickloom.sinks import tables


def bronze(records: DataFrame) -> DataFrame:
    """Log records to the Bronze rows; malformed ones are left to the quarantine."""
    return normalize.valid(normalize.decode_log(records))


def silver(bronze_rows: DataFrame, positions: bool = False) -> DataFrame:
    return normalize.to_silver(dedup.latest(bronze_rows), positions)


def staging(silver_rows: DataFrame) -> DataFrame:
    return normalize.to_staging(silver_rows)


def fact_trades_1h(staged: DataFrame) -> DataFrame:
    return ohlcv.rollup(staged, "hour")


def refresh(spark: SparkSession, root: str, prefix: str = "") -> dict[str, str]:
    """Rebuild Silver, the staging view and the Gold table from the Bronze table.

    ``prefix`` lets several sets of layers live in one catalog.
    """
    names = {
        layer: f"{prefix}{database}.{table}"
        for layer, database, table in (
            ("bronze", "bronze", "trades"),
            ("silver", "silver", "trades"),
            ("gold", "gold", "fact_trades_1h"),
        )
    }
    tables.replace(spark, names["silver"], silver(spark.table(names["bronze"])), root, ["symbol"])
    view = f"{prefix}stg_trades"
    staging(spark.table(names["silver"])).createOrReplaceTempView(view)
    tables.replace(spark, names["gold"], fact_trades_1h(spark.table(view)), root)
    return {**names, "staging": view}
