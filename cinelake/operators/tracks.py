"""Favourite films with their genre names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from cinelake.schemas import FAVOURITE_TRACK

FILM_COLUMNS = tuple(c for c in FAVOURITE_TRACK.fieldNames() if c != "genres")


def explode_genres(favourites: DataFrame) -> DataFrame:
    """One row per film and genre id; films without any genre id disappear."""
    return favourites.withColumn("genre_id", F.explode("genre_ids")).drop("genre_ids")


def with_genre_names(films: DataFrame, genre_track: DataFrame) -> DataFrame:
    """Look genre names up; ids that have no name are dropped.

    There is no broadcast hint: Spark broadcasts the lookup as long as it measures small.
    """
    name = F.col("genre_name")
    if isinstance(genre_track.schema["genre_name"].dataType, BinaryType):
        name = F.decode(name, "UTF-8")
    lookup = genre_track.select(
        F.col("id").cast("bigint").alias("genre_id"), name.alias("genre_name"),
    ).where(F.col("genre_name").isNotNull())
    return films.join(lookup, "genre_id")


def collect_genres(named: DataFrame) -> DataFrame:
    """One row per film with the sorted list of its genre names.

    Films that agree in every column are one film, and their lists join up, repeats included.
    The wide columns are shuffled once; lists are put together on the map side before that. A
    list is no longer than the one its film has in the result.
    """
    names = F.array_sort(F.collect_list("genre_name"))
    return named.groupBy(*FILM_COLUMNS).agg(names.alias("genres"))


def favourite_track(favourites: DataFrame, genre_track: DataFrame) -> DataFrame:
    named = with_genre_names(explode_genres(favourites), genre_track)
    return collect_genres(named).select(*FILM_COLUMNS, "genres")
