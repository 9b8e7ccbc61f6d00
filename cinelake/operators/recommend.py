"""Scoring films against a user's profile and ranking them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cinelake import constants as K
from cinelake.functions import cosine, unit
from cinelake.operators.features import DEFAULT

SCORE = "cosine_similarity"


def score_films(
    vectors: DataFrame, user: DataFrame, exclude: DataFrame | None = None, as_double: bool = False,
) -> DataFrame:
    """``(id, cosine_similarity)`` of every film.

    The profile is brought to unit length once and enters as a scalar subquery, so no join takes
    place, and a profile of more than one row is an error. Without a profile nothing is scored. ``exclude`` holds films,
    such as the favourites themselves, that are left out. A film vector of another length than
    the profile is an error. Scores are single precision unless ``as_double`` is set.
    """
    if exclude is not None:
        vectors = vectors.join(exclude.select("id").distinct(), "id", "left_anti")
    direction = user.select(unit(F.col("user_vector"))).scalar()
    score = cosine(F.col("movie_vector"), F.col("_direction"), DEFAULT.width)
    return (
        vectors.select("id", "movie_vector", direction.alias("_direction"))
        .where(F.col("_direction").isNotNull())
        .select("id", score.cast("double" if as_double else "float").alias(SCORE)))


def _first(rows: DataFrame, k: int) -> DataFrame:
    return rows.orderBy(F.col(SCORE).desc(), "id").limit(k)


def top_joined(
    tables: Sequence[DataFrame], scores: DataFrame, k: int = K.TOP_FILMS, rank: str | None = None,
) -> DataFrame:
    """The ``k`` best scored rows of ``tables`` joined on ``id``, best first, ties by id.

    Only ids and scores are shuffled: the best ``k`` scores among ids that every table has are
    found first. They then pick up the columns of one table after the other, cut to ``k`` rows each
    time, which is what bounds the broadcasts: ``k`` rows, whatever the data. Rows outside the best
    ``k`` cannot enter the result, since a repeated id only adds rows of the same score. The score
    is left out; ``rank`` names a column that counts the rows from 1. A ``k`` of many millions
    would not fit the one task that ends a limit.
    """
    best = scores
    for table in tables:
        best = best.join(table.select("id"), "id", "left_semi")
    best = _first(best, k)
    for table in tables:
        best = _first(table.join(F.broadcast(best), "id"), k)
    if rank:
        place = F.row_number().over(Window.orderBy(F.col(SCORE).desc(), "id"))
        return best.withColumn(rank, place).orderBy(rank).drop(SCORE)
    return best.drop(SCORE)


def top_films(
    films: DataFrame, scores: DataFrame, k: int = K.TOP_FILMS, rank: str | None = None,
) -> DataFrame:
    """The ``k`` best scored rows of ``films``; see ``top_joined``."""
    kept = [*films.columns, *([rank] if rank else [])]
    return top_joined([films], scores, k, rank).select(*kept)
