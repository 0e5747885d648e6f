"""``python -m tickloom NAME FOLDER`` shows one query over a folder of tables."""

from __future__ import annotations

import sys

from pyspark.sql import SparkSession

from tickloom.registry import QUERIES


def main(arguments: list[str]) -> int:
    if len(arguments) != 2 or arguments[0] not in QUERIES:
        print("usage: python -m tickloom NAME FOLDER\n" + "\n".join(sorted(QUERIES)))
        return 2
    spark = SparkSession.builder.appName(f"tickloom {arguments[0]}").getOrCreate()
    QUERIES[arguments[0]](spark, arguments[1]).show(truncate=False)
    spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
