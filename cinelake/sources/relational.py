"""Extracts from relational tables, over JDBC or from any frame with the same columns.

Year filters are half-open date ranges on the bare column, so they reach a parquet scan or the
database as they are and an index on the date stays usable.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, timedelta
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cinelake import constants as K
from cinelake.functions import binary_to_text


def _released(first: int, last: int, column: str) -> Column:
    day = F.col(column)
    return (
        day.isNotNull()
        & (day >= F.lit(date(first, 1, 1)))
        & (day < F.lit(date(last + 1, 1, 1)))
    )


def extract_year(df: DataFrame, year: int, column: str = "release_date") -> DataFrame:
    """Rows released in one year."""
    return df.where(_released(year, year, column))


def extract_years(
    df: DataFrame, last: int, first: int = K.FIRST_YEAR, column: str = "release_date",
) -> DataFrame:
    """Rows of the whole partition domain ``first`` to ``last``, both included."""
    return df.where(_released(first, last, column))


def jdbc_options(
    url: str, user: str | None = None, password: str | None = None, driver: str | None = None,
    fetch_size: int = 10_000,
) -> dict[str, str]:
    options = {"url": url, "fetchsize": str(fetch_size)}
    for name, value in (("user", user), ("password", password), ("driver", driver)):
        if value is not None:
            options[name] = value
    return options


def year_predicates(
    first: int, last: int, column: str = "release_date", splits: int = 1,
) -> list[str]:
    """Conditions that together cover every year once; each becomes one task of a JDBC read.

    A year is one condition, or up to ``splits`` date ranges of about equal length. All are plain
    ranges on the date, so an index serves them and no row is looked at twice.
    """
    conditions = []
    for year in range(first, last + 1):
        start, end = date(year, 1, 1), date(year + 1, 1, 1)
        days = (end - start).days
        cuts = sorted({start + timedelta(days * part // splits) for part in range(splits)})
        for low, high in zip(cuts, [*cuts[1:], end]):
            conditions.append(f"{column} >= '{low.isoformat()}' AND {column} < '{high.isoformat()}'")
    return conditions


def key_range_options(key: str, low: int, high: int, tasks: int) -> dict[str, str]:
    """Settings that split a JDBC read into ``tasks`` ranges of a numeric key.

    The bounds only place the cuts: keys outside them, and rows without key, are read by the
    outermost tasks.
    """
    return {
        "partitionColumn": key, "lowerBound": str(low), "upperBound": str(high),
        "numPartitions": str(tasks)}


def _literal(value) -> str:
    """A key value as SQL text."""
    if isinstance(value, (int, float, Decimal)):
        return str(value)
    return "'" + str(value).replace("'", "''") + "'"


def cut_points_query(source: str, key: str, tasks: int) -> str:
    """A statement, for the database to run, with the smallest key of each of ``tasks`` equal shares of the rows.

    Shares are counted in rows, so keys may be as uneven as they like.
    """
    shares = f"SELECT {key} AS k, NTILE({tasks}) OVER (ORDER BY {key}) AS share FROM {source} WHERE {key} IS NOT NULL"
    return f"SELECT MIN(k) AS k FROM ({shares}) shares GROUP BY share ORDER BY 1"


def cut_points(df: DataFrame, key: str, tasks: int) -> list:
    """The same for a frame, from one pass of mergeable sketches; numeric keys."""
    wanted = [part / tasks for part in range(1, tasks)]
    found = df.agg(F.percentile_approx(key, wanted).alias("cuts")).first().cuts if wanted else None
    return found or []


def cut_predicates(key: str, cuts: Iterable) -> list[str]:
    """Conditions that cover every row once, rows without key included; each becomes one task of a JDBC read.

    A key that fills several shares is one condition: equal keys cannot be parted.
    """
    cuts = sorted(set(cuts))
    if not cuts:
        return ["1 = 1"]
    bounds = [_literal(c) for c in cuts]
    first = f"{key} < {bounds[0]} OR {key} IS NULL"
    between = [f"{key} >= {low} AND {key} < {high}" for low, high in zip(bounds, bounds[1:])]
    return [first, *between, f"{key} >= {bounds[-1]}"]


def read_split(
    spark: SparkSession, options: dict[str, str], source: str, key: str, tasks: int,
) -> DataFrame:
    """A table, or a statement given as ``(SELECT ...) name``, read by ``tasks`` tasks of about equal rows.

    The database finds the cuts, so no bounds need to be known; the frame has the rows that match
    one of the conditions, and every row matches exactly one.
    """
    cuts = read_query(spark, options, cut_points_query(source, key, tasks)).collect()  # one row per task at most
    properties = {k: v for k, v in options.items() if k != "url"}
    return binary_to_text(spark.read.jdbc(
        options["url"], source, predicates=cut_predicates(key, [row.k for row in cuts][1:]), properties=properties))


def read_table(
    spark: SparkSession, options: dict[str, str], table: str, split: dict[str, str] | None = None,
) -> DataFrame:
    """A whole table, binary columns decoded; in one task, or as ``key_range_options`` splits it."""
    reader = spark.read.format("jdbc").options(**options).options(**(split or {}))
    return binary_to_text(reader.option("dbtable", table).load())


def read_query(spark: SparkSession, options: dict[str, str], sql: str) -> DataFrame:
    """The result of a statement that the database itself runs, binary columns decoded, in one task.

    ``read_split`` reads a large result by several.
    """
    return binary_to_text(
        spark.read.format("jdbc").options(**options).option("query", sql).load())


def read_years(
    spark: SparkSession, options: dict[str, str], table: str, last: int,
    first: int = K.FIRST_YEAR, column: str = "release_date", splits: int = 1,
) -> DataFrame:
    """All years of a table in one job, with ``splits`` tasks per year."""
    properties = {k: v for k, v in options.items() if k != "url"}
    return binary_to_text(spark.read.jdbc(
        options["url"], table, predicates=year_predicates(first, last, column, splits),
        properties=properties))
