"""Every registered query against its SQL twin on the small tables."""

import math

import duckdb
import pandas as pd
import pytest

from __spark_entry__ import entry, oracle_sql, queries

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
TYPES = {
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "timestamp_ntz": "TIMESTAMP",
    "date": "DATE",
    "int": "INTEGER",
    "boolean": "BOOLEAN",
}


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def canonical(frame: pd.DataFrame) -> list[tuple]:
    def one(value):
        if value is None or value is pd.NaT or (isinstance(value, float) and math.isnan(value)):
            return ""
        if isinstance(value, float):
            return repr(float(value))
        return pd.Timestamp(value).isoformat() if hasattr(value, "isoformat") else str(value)

    return sorted(tuple(one(v) for v in row) for row in frame.itertuples(index=False))


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_matches_sql(spark, sf_dir, duck, name):
    ours = queries()[name](spark, sf_dir)
    columns = sorted(ours.columns)
    result = duck.execute(oracle_sql()[name])
    kinds = {c[0]: str(c[1]) for c in result.description}
    theirs = result.df()
    assert columns == sorted(kinds)
    assert {c: TYPES[t] for c, t in ours.dtypes} == kinds
    assert canonical(ours.select(*columns).toPandas()) == canonical(theirs[columns])


@pytest.mark.parametrize("name", sorted(set(queries()) - set(oracle_sql())))
def test_rows_only(spark, sf_dir, name):
    assert queries()[name](spark, sf_dir).count() > 0


def test_entry(spark):
    result = entry(spark)
    assert result.columns[:2] == ["symbol", "bucket_hour"]
    assert result.count() > 0
