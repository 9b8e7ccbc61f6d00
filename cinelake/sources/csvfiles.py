"""CSV files whose columns bind by position."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DoubleType, IntegerType, LongType, StringType, StructType,
)

from cinelake.operators.dedupe import first_per_key

PLACE = "_place"


def _fill_blanks(df: DataFrame) -> DataFrame:
    """Blank text becomes ``''`` and a blank number 0; a blank date stays null."""
    numbers = [f.name for f in df.schema
               if isinstance(f.dataType, (IntegerType, LongType, DoubleType))]
    texts = [f.name for f in df.schema if isinstance(f.dataType, StringType)]
    return df.fillna(0, numbers).fillna("", texts)


def read_positional_csv(
    spark: SparkSession,
    path: str,
    schema: StructType,
    key: str | None = None,
    multi_line: bool = False,
    mode: str = "FAILFAST",
    line_separator: str | None = None,
    blanks_as_defaults: bool = False,
    escape: str = '"',
    null_text: str | None = None,
) -> DataFrame:
    """Read comma-separated files with one header row, naming columns by position.

    ``key`` makes that column a primary key: rows without it are dropped and the first row of
    each value, in file order, wins.

    ``multi_line`` allows line breaks inside quoted fields. Spark then reads each file in one task;
    without it files are split, and every line is a record. A record that does not fit the schema
    is an error; ``mode="PERMISSIVE"`` keeps it with nulls instead.

    The loader of a relational server reads a blank field as ``blanks_as_defaults`` does, takes a
    backslash as ``escape``, and reads ``\\N`` as null (``null_text``).
    """
    reader = (
        spark.read.schema(schema).option("quote", '"').option("escape", escape)
        .option("header", True).option("enforceSchema", True)
        .option("multiLine", multi_line).option("mode", mode))
    if line_separator is not None:
        reader = reader.option("lineSep", line_separator)
    if null_text is not None:
        reader = reader.option("nullValue", null_text)
    rows = reader.csv(path)
    if key:
        place = F.struct(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("line"))
        rows = rows.select("*", place.alias(PLACE)).where(F.col(key).isNotNull())
        rows = first_per_key(rows, [key], [PLACE]).drop(PLACE)
    return _fill_blanks(rows) if blanks_as_defaults else rows
