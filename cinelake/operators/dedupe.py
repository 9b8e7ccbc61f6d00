"""First row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Where a row of a frame just read from parquet stands: ends an order that would leave rows tied, which
#: otherwise follow the order in which tasks deliver them.
FILE_ORDER = ("_metadata.file_path", "_metadata.row_index")


def first_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[str | Column],
) -> DataFrame:
    """Keep the first row of every key in ``order``.

    Spark turns a row number cut at 1 into a group limit that already runs before the shuffle,
    so each task sends one row per key however many copies it holds. Which of several rows that
    ``order`` leaves tied is kept is open.
    """
    place = "_row"
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(place, F.row_number().over(window)).where(F.col(place) == 1).drop(place)
