"""One explicit schema per dataset, and the check every write goes through."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType, BinaryType, BooleanType, DataType, DateType, DecimalType, DoubleType, FloatType, IntegerType, LongType,
    StringType, StructType, TimestampType,
)

LONG, INT, DOUBLE, TEXT, DATE = LongType(), IntegerType(), DoubleType(), StringType(), DateType()
TEXTS, DOUBLES = ArrayType(TEXT), ArrayType(DOUBLE)


def struct(**columns: DataType) -> StructType:
    schema = StructType()
    for name, data_type in columns.items():
        schema.add(name, data_type)
    return schema


MOVIES = struct(
    id=LONG, title=TEXT, vote_average=DOUBLE, vote_count=LONG, release_date=DATE, revenue=LONG,
    runtime=INT, adult=TEXT, backdrop_path=TEXT, budget=LONG, original_language=TEXT,
    original_title=TEXT, overview=TEXT, popularity=DOUBLE, poster_path=TEXT, genres=TEXT,
    production_companies=TEXT, production_countries=TEXT, spoken_languages=TEXT, keywords=TEXT)
MOVIE_YEARS = struct(id=LONG)
GENRE_TRACK = struct(id=INT, genre_name=TEXT)
FAVOURITES = struct(
    adult=BooleanType(), genre_ids=ArrayType(LONG), id=LONG, overview=TEXT, popularity=DOUBLE,
    release_date=TEXT, title=TEXT, vote_average=DOUBLE, vote_count=LONG)
API_PAGE = struct(page=INT, results=ArrayType(FAVOURITES))
MOVIES_CLEANED = struct(
    id=LONG, title=TEXT, vote_average=DOUBLE, vote_count=LONG, release_date=DATE, revenue=LONG,
    runtime=INT, adult=TEXT, budget=LONG, original_language=TEXT, original_title=TEXT,
    overview=TEXT, popularity=DOUBLE, genres=TEXT, production_companies=TEXT,
    production_countries=TEXT, keywords=TEXT)
MOVIES_FEATURES = struct(
    id=LONG, popularity=DOUBLE, release_date=DATE, vote_average=DOUBLE, vote_count=LONG,
    genres=TEXTS)
FAVOURITE_TRACK = struct(
    id=LONG, title=TEXT, adult=BooleanType(), popularity=DOUBLE, overview=TEXT,
    release_date=TEXT, vote_average=DOUBLE, vote_count=LONG, genres=TEXTS)
MY_FEATURES = struct(
    id=LONG, popularity=DOUBLE, release_date=TEXT, vote_average=DOUBLE, vote_count=LONG,
    genres=TEXTS)
MOVIES_INFOR = struct(
    id=LONG, title=TEXT, overview=TEXT, release_date=DATE, runtime=INT, genres=TEXT)
MOVIES_RATING = struct(id=LONG, vote_average=DOUBLE, vote_count=LONG)
MOVIES_GENRES = struct(id=LONG, genres=TEXT)
MOVIE_VECTORS = struct(id=LONG, movie_vector=DOUBLES)
USER_VECTOR = struct(user_vector=DOUBLES)
VECTOR_STATISTICS = struct(dim=INT, n=LONG, mean=DOUBLE, m2=DOUBLE, low=DOUBLE, high=DOUBLE)
SCORES = struct(id=LONG, cosine_similarity=FloatType())
INFOR_RATING = struct(
    id=LONG, title=TEXT, overview=TEXT, release_year=INT, runtime=INT, genres=TEXT,
    vote_average=DOUBLE)

RANKING = struct(**{f.name: f.dataType for f in INFOR_RATING}, rank=INT)
QUALITY = struct(checked=TEXT, rule=TEXT, column=TEXT, violations=LONG)

YEAR_COLUMN = "release_year"


@dataclass(frozen=True)
class Dataset:
    """Where a dataset lives in the lake and what it holds.

    ``keeps_last`` says that an empty result leaves the previous one in place. ``clustered`` names
    columns that readers filter by, with the range their values mostly lie in.
    """

    layer: str
    table: str
    schema: StructType
    by_year: bool = False
    keeps_last: bool = True
    clustered: dict[str, tuple[float, float]] | None = None

    @property
    def stored_schema(self) -> StructType:
        stored = StructType(list(self.schema.fields))
        return stored.add(YEAR_COLUMN, INT) if self.by_year else stored


DATASETS = {
    f"{d.layer}.{d.table}": d
    for d in (
        Dataset("bronze", "movies", MOVIES, by_year=True),
        Dataset("bronze", "movie_years", MOVIE_YEARS, by_year=True),
        Dataset("bronze", "genre_track", GENRE_TRACK),
        Dataset("bronze", "favorite_movies", FAVOURITES),
        Dataset("silver", "movies_cleaned", MOVIES_CLEANED, by_year=True),
        Dataset("silver", "movies_vectors", MOVIES_FEATURES, by_year=True),
        Dataset("silver", "favorite_track", FAVOURITE_TRACK),
        Dataset("silver", "my_vector", MY_FEATURES),
        Dataset("gold", "movies_infor", MOVIES_INFOR),
        Dataset("gold", "movies_rating", MOVIES_RATING),
        Dataset("gold", "movies_genres", MOVIES_GENRES),
        Dataset("gold", "my_vector", USER_VECTOR),
        Dataset("gold", "movies_vector", MOVIE_VECTORS, by_year=True),
        Dataset("gold", "vector_statistics", VECTOR_STATISTICS, by_year=True),
        Dataset("gold", "recommendations", SCORES),
        Dataset(
            "marts", "infor_rating", INFOR_RATING, keeps_last=False,
            clustered={"release_year": (1900, 2050), "vote_average": (0, 10)}),
        Dataset("marts", "recommendations", RANKING, keeps_last=False),
        Dataset("marts", "quality_report", QUALITY, keeps_last=False),
    )
}

WAREHOUSE = {
    "movies_infor": MOVIES_INFOR,
    "movies_rating": MOVIES_RATING,
    "movies_genres": MOVIES_GENRES,
    "favorite_track": FAVOURITE_TRACK,
    "recommendations": SCORES,
}


class SchemaMismatch(ValueError):
    """A frame does not have the columns or types its dataset declares."""


#: Casts that lose nothing a dataset wants to keep; a relational server's types arrive as these.
WIDENED = {
    ("float", "double"), ("tinyint", "int"), ("smallint", "int"), ("tinyint", "bigint"),
    ("smallint", "bigint"), ("int", "bigint"), ("timestamp_ntz", "date"),
}


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Give columns that arrive in a server's own types the types of ``schema``.

    A timestamp becomes the day it shows in UTC, whatever zone the session has; a reader that leaves
    zones out (``timestamp_ntz``) keeps the server's day. Other differences stay, for
    ``assert_schema`` to name.
    """
    wanted = {f.name: f.dataType for f in schema}

    def column(field):
        target = wanted.get(field.name)
        if target is None:
            return F.col(field.name)
        if isinstance(field.dataType, BinaryType) and target == TEXT:
            return F.decode(field.name, "UTF-8").alias(field.name)
        if isinstance(field.dataType, TimestampType) and target == DATE:
            zoned = F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.col(field.name).cast("timestamp_ntz"))
            return zoned.cast("date").alias(field.name)
        if isinstance(field.dataType, DecimalType) and (target == DOUBLE or (target in (LONG, INT) and field.dataType.scale == 0)):
            return F.col(field.name).cast(target).alias(field.name)
        if (field.dataType.simpleString(), target.simpleString()) in WIDENED:
            return F.col(field.name).cast(target).alias(field.name)
        return F.col(field.name)

    return df.select(*(column(f) for f in df.schema))


def assert_schema(df: DataFrame, schema: StructType) -> DataFrame:
    """Return ``df`` with its columns in declared order, or raise on any other difference."""
    found = {f.name: f.dataType.simpleString() for f in df.schema}
    wanted = {f.name: f.dataType.simpleString() for f in schema}
    if found != wanted:
        missing = sorted(wanted.keys() - found.keys())
        extra = sorted(found.keys() - wanted.keys())
        retyped = sorted(
            f"{n}: {found[n]} instead of {wanted[n]}"
            for n in found.keys() & wanted.keys() if found[n] != wanted[n])
        raise SchemaMismatch(f"missing {missing}, unexpected {extra}, wrong type {retyped}")
    return df.select(*schema.fieldNames())
