"""Gold projections, serving models and the catalogue search."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinelake import constants as K
from cinelake import schemas
from cinelake.functions import calendar_year, month_label, rating_floor, rating_label, split_tags
from cinelake.operators.recommend import top_films, top_joined


def movies_infor(cleaned: DataFrame) -> DataFrame:
    return cleaned.select(*schemas.MOVIES_INFOR.fieldNames())


def movies_rating(cleaned: DataFrame) -> DataFrame:
    return cleaned.select(*schemas.MOVIES_RATING.fieldNames())


def movies_genres(cleaned: DataFrame) -> DataFrame:
    return cleaned.select(*schemas.MOVIES_GENRES.fieldNames())


def infor_rating(infor: DataFrame, rating: DataFrame) -> DataFrame:
    """Film information with its rating."""
    return _model(infor.join(rating.select("id", "vote_average"), "id"))


def _model(joined: DataFrame) -> DataFrame:
    return joined.withColumn(schemas.YEAR_COLUMN, calendar_year("release_date")).select(
        *schemas.INFOR_RATING.fieldNames())


def recommendations(
    infor_rating_model: DataFrame, scores: DataFrame, k: int = K.TOP_FILMS, rank: str | None = None,
) -> DataFrame:
    """The best scored films of the stored model, best first."""
    return top_films(infor_rating_model, scores, k, rank)


def recommendations_from(
    infor: DataFrame, rating: DataFrame, scores: DataFrame, k: int = K.TOP_FILMS,
) -> DataFrame:
    """The same ranking without a stored model: both tables are cut to the best ids, then joined."""
    best = top_joined([rating.select("id", "vote_average"), infor], scores, k)
    return _model(best)


def voting_distribution(infor_rating_model: DataFrame) -> DataFrame:
    """Films per release year and whole rating."""
    label = rating_label(F.col("_floor"))
    return (
        infor_rating_model.where(F.col("vote_average").isNotNull())
        .select("release_year", rating_floor("vote_average").alias("_floor"))
        .groupBy("release_year", label.alias("rating_bin_label"))
        .agg(F.count(F.lit(1)).alias("movie_count"))
        .orderBy("rating_bin_label", "release_year"))


def monthly_release_movies(infor: DataFrame) -> DataFrame:
    """Films per release month."""
    return (
        infor.where(F.col("release_date").isNotNull())
        .groupBy(month_label("release_date").alias("release_month"))
        .agg(F.count(F.lit(1)).alias("movie_count"))
        .orderBy("release_month"))


def search_films(
    films: DataFrame,
    rating: tuple[float, float] | None = None,
    years: tuple[int, int] | None = None,
    genres: Sequence[str] = (),
    limit: int | None = None,
) -> DataFrame:
    """Films within a rating range and a year range that carry every given genre, best first.

    ``films`` has ``vote_average``, ``release_year`` and the comma list ``genres``; bounds are
    inclusive and every filter is optional.
    """
    if rating:
        films = films.where(F.col("vote_average").between(*rating))
    if years:
        films = films.where(F.col("release_year").between(*years))
    tags = split_tags("genres", trim=True)
    for genre in genres:
        films = films.where(F.array_contains(tags, genre))
    found = films.orderBy(F.col("vote_average").desc(), "id")
    return found if limit is None else found.limit(limit)
