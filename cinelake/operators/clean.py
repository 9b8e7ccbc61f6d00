"""Cleaning of the raw catalogue."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinelake import constants as K
from cinelake.functions import calendar_year
from cinelake.schemas import YEAR_COLUMN

#: Bounds of what is broadcast per year: the last year a date can show, and bytes.
LAST_CALENDAR_YEAR = 9999
BROADCAST_BYTES = 8 << 20


def drop_unused(df: DataFrame) -> DataFrame:
    return df.drop(*K.UNUSED_COLUMNS)


def with_key(df: DataFrame, key: str = "id") -> DataFrame:
    return df.where(F.col(key).isNotNull())


def with_year(df: DataFrame) -> DataFrame:
    """Add the release year unless the frame was read from a yearly dataset."""
    if YEAR_COLUMN in df.columns:
        return df
    return df.withColumn(YEAR_COLUMN, calendar_year("release_date"))


def per_year(stats: DataFrame, by: str, width: int = 1) -> DataFrame:
    """Statistics of groups, ready to be joined to their rows.

    Calendar years have four digits, so by year there are 10,000 rows at most. They are broadcast if
    so many of ``width`` doubles fit ``BROADCAST_BYTES``: rows then stay where they are, however many
    share a year. Other statistics are left to Spark, which measures them while the query runs.
    """
    if by != YEAR_COLUMN or LAST_CALENDAR_YEAR * 8 * width > BROADCAST_BYTES:
        return stats
    return F.broadcast(stats.where(F.col(by).between(0, LAST_CALENDAR_YEAR)))


def impute_mean(df: DataFrame, column: str = "popularity", by: str = YEAR_COLUMN) -> DataFrame:
    """Replace missing values of ``column`` by the mean of their ``by`` group.

    The means come from a narrow aggregate that combines on the map side, and no film is grouped by
    year. NaN counts as missing. A group without any value keeps its nulls.
    """
    value = F.nanvl(F.col(column), F.lit(None).cast("double"))
    means = df.groupBy(by).agg(F.avg(value).alias("_mean")).where(F.col("_mean").isNotNull())
    filled = df.join(per_year(means, by), by, "left")
    return filled.withColumn(column, F.coalesce(value, "_mean")).select(*df.columns)


def fill_constants(df: DataFrame) -> DataFrame:
    return df.fillna(K.FILLS)


def clean_movies(df: DataFrame) -> DataFrame:
    """Raw films to cleaned films, with their release year, for all years in one job."""
    return fill_constants(impute_mean(with_year(with_key(drop_unused(df)))))
