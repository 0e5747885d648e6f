"""Records that gain members while a table grows.

Members that the record type does not know are rescued at decode, as a map from name to text. A declared change
names some of them with a type and makes them columns: in new batches, and at reading also in files written
before, from what was rescued there. Text that is not of the declared type stays in the map, so nothing of
a record is lost by a change. Old files are read with the schema that is asked for; no file is opened to find out which
columns it has.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, StringType, StructField, StructType

RESCUED = "rescued"
_MAP = MapType(StringType(), StringType())


def rescued(value: Column, known: Sequence[str]) -> Column:
    """The members of a JSON object that are not ``known``; NULL if there are none or it is no object.

    Texts come without quotes, anything else as its JSON text, and a null member as a null.
    """
    return _or_null(F.map_filter(F.from_json(value, _MAP), lambda name, _: ~name.isin(list(known))))


def _or_null(members: Column) -> Column:
    return F.when(F.size(members) > 0, members)


def widen(rows: DataFrame, added: StructType) -> DataFrame:
    """Rescued members that ``added`` declares as columns of their type; ``rescued`` keeps the rest.

    A column that is there already keeps its values and takes the member where it is NULL.
    """
    if not added.fields:
        return rows
    columns, taken = {}, []
    for field in added.fields:
        typed = F.try_element_at(RESCUED, F.lit(field.name)).try_cast(field.dataType)
        here = F.col(f"_{field.name}")
        columns[field.name] = F.coalesce(here, typed)
        taken.append((field, here))

    def is_taken(name: Column, text: Column) -> Column:
        return reduce(
            or_,
            (
                (name == field.name) & (text.isNull() | (here.isNull() & text.try_cast(field.dataType).isNotNull()))
                for field, here in taken
            ),
        )

    left = F.map_filter(RESCUED, lambda name, text: ~is_taken(name, text))
    columns[RESCUED] = _or_null(left)
    # Under names of their own, as a name inside a lambda function would mean the new column.
    had = [
        (F.col(f.name) if f.name in rows.columns else F.lit(None).cast(f.dataType)).alias(f"_{f.name}") for f in added
    ]
    kept = [columns.pop(name).alias(name) if name in columns else F.col(name) for name in rows.columns]
    return rows.select("*", *had).select(*kept, *(column.alias(name) for name, column in columns.items()))


def evolved(schema: StructType, added: StructType) -> StructType:
    """The stored schema after a declared change; a name that is taken is an error."""
    taken = {name.lower() for name in [*schema.fieldNames(), RESCUED]}
    clashes = [name for name in added.fieldNames() if name.lower() in taken]
    if clashes:
        raise ValueError(f"declared already: {', '.join(clashes)}")
    return StructType([*schema.fields, *added.fields, StructField(RESCUED, _MAP)])


def read(spark: SparkSession, path: str, schema: StructType, added: StructType) -> DataFrame:
    """A folder whose files were written before, between and after changes, with the columns of the last one.

    A member keeps the type it was first declared with.
    """
    wanted = evolved(schema, added)
    return widen(spark.read.schema(wanted).parquet(path), added).select(*wanted.fieldNames())
