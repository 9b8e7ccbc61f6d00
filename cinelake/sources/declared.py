"""Warehouse tables as their database declares them, and the way back.

The lake keeps tags as a comma list, ids as long numbers and the API's dates as text; the declared
tables have text arrays, plain integers and dates. Mapped frames have exactly the declared types,
so a load can keep a table's definition and its keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cinelake import constants as K
from cinelake.functions import split_tags
from cinelake.schemas import DATE, DOUBLE, INT, LONG, TEXT, TEXTS, WAREHOUSE, assert_schema, struct

# Columns of the declared tables, in order, with the types a database shows for them.
DECLARED = {
    "movies_infor": struct(id=INT, title=TEXT, overview=TEXT, release_date=DATE, runtime=INT, genres=TEXTS),
    "movies_rating": struct(id=INT, vote_average=DOUBLE, vote_count=INT),
    "movies_genres": struct(id=INT, genre=TEXTS),
    "favorite_track": struct(
        id=INT, title=TEXT, adult=TEXT, popularity=DOUBLE, overview=TEXT, release_date=DATE, vote_average=DOUBLE,
        vote_count=INT, genres=TEXTS),
    "recommendations": struct(id=LONG, cosine_similarity=DOUBLE),
}
# Declared names of columns that the lake names otherwise.
RENAMED = {"movies_genres": {"genres": "genre"}}


def _declared_name(table: str, column: str) -> str:
    return RENAMED.get(table, {}).get(column, column)


def to_declared(df: DataFrame, table: str) -> DataFrame:
    """A published frame in its declared form.

    A number or a date text that does not fit its declared type is an error; blank date text is
    null. The marker for missing tags becomes an empty array.
    """
    rows = assert_schema(df, WAREHOUSE[table])
    return rows.select(*(
        _cast(F.col(f.name), f.dataType, DECLARED[table][_declared_name(table, f.name)].dataType).alias(_declared_name(table, f.name))
        for f in rows.schema))


def _cast(value: Column, found, wanted) -> Column:
    if found == wanted:
        return value
    if found == TEXT and wanted == TEXTS:
        return split_tags(value)
    if found == TEXT and wanted == DATE:
        return F.when(F.trim(value) != "", value).cast("date")
    return value.cast(wanted)


def from_declared(df: DataFrame, table: str) -> DataFrame:
    """A declared table in the form the models read; the reverse of ``to_declared``."""
    schema: StructType = WAREHOUSE[table]

    def column(field):
        name = _declared_name(table, field.name)
        value, found = F.col(name), df.schema[name].dataType
        if found == TEXTS and field.dataType == TEXT:
            none = F.when(F.size(value) == 0, F.lit(K.MISSING_TEXT))
            value = F.when(value.isNotNull(), F.coalesce(none, F.array_join(value, ",")))
        return value.cast(field.dataType).alias(field.name)

    return df.select(*(column(f) for f in schema))


def declared_types(df: DataFrame, table: str) -> DataFrame:
    """``(table_name, column_name, data_type, filled)`` of a frame: its types and how many values are not null."""
    counts = df.agg(*(F.count(c).alias(c) for c in df.columns))
    return counts.select(F.inline(F.array(*(
        F.struct(
            F.lit(table).alias("table_name"), F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("data_type"), F.col(f.name).alias("filled"))
        for f in df.schema))))
