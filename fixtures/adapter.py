"""Catalogue, favourites and genre lookup derived from the test tables (see FIXTURES.md)."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cinelake import constants as K
from cinelake import schemas
from cinelake.operators.clean import clean_movies
from cinelake.operators.features import favourite_features, film_features, user_profile
from cinelake.operators.tracks import favourite_track
from cinelake.session import scratch_folder

# Genre code and hash slot (20 slots) of each tag in the test catalogue. LARGE has
# a code but no name in the lookup.
TAG_CODES = {
    "ECONOMY": 28, "SMALL": 12, "MEDIUM": 16, "PROMO": 35, "STANDARD": 80, "LARGE": 99,
}
TAG_SLOTS = {
    "ECONOMY": 11, "SMALL": 12, "MEDIUM": 0, "PROMO": 10, "STANDARD": 19, "LARGE": 18,
}
# The same for 2,000 slots.
TAG_SLOTS_WIDE = {
    "ECONOMY": 791, "SMALL": 492, "MEDIUM": 1780, "PROMO": 910, "STANDARD": 379, "LARGE": 618,
}
REWORKED_YEAR = 1997
UNNAMED_TAG = "LARGE"
FAVOURITE_SEGMENT = "BUILDING"
LAST_YEAR = 2001


def _null_every(key: Column, step: int, value: Column) -> Column:
    return F.when(key % step != 0, value)


@dataclass(frozen=True)
class Inputs:
    """All inputs of the registered queries for one data folder."""

    spark: SparkSession
    folder: str
    catalogue: str | None = None

    def stored(self) -> Inputs:
        """The same inputs over the raw catalogue written once, for queries that go through it several times."""
        catalogue = scratch_folder(self.spark, "catalogue")
        self.movies_raw.write.parquet(catalogue)
        return Inputs(self.spark, self.folder, catalogue)

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def movies_raw(self) -> DataFrame:
        """The 20-column catalogue: one film per order, rated by its line items."""
        if self.catalogue:
            return self.spark.read.schema(schemas.MOVIES).parquet(self.catalogue)
        items = self.table("lineitem").join(
            self.table("part"), F.col("l_partkey") == F.col("p_partkey"))
        votes = items.groupBy("l_orderkey").agg(
            (F.avg("l_quantity") / 5).alias("vote_average"),
            F.count(F.lit(1)).alias("vote_count"),
            F.array_join(F.array_sort(F.collect_set("p_type")), ",").alias("genres"))
        films = self.table("orders").join(
            votes, F.col("o_orderkey") == F.col("l_orderkey"), "left")
        k = F.col("o_orderkey")
        nothing = F.lit(None).cast("string")
        columns = {
            "id": _null_every(k, 101, k),
            "title": F.concat(F.lit("Title "), k.cast("string")),
            "vote_average": F.col("vote_average"),
            "vote_count": F.col("vote_count"),
            "release_date": F.col("o_orderdate").cast("date"),
            "revenue": _null_every(k, 7, F.col("o_custkey") * 1000),
            "runtime": (60 + k % 120).cast("int"),
            "adult": F.when(k % 17 != 0, F.when(k % 5 == 0, "TRUE").otherwise("FALSE")),
            "backdrop_path": nothing,
            "budget": _null_every(k, 9, k * 10),
            "original_language": _null_every(k, 19, F.lit("fr")),
            "original_title": _null_every(k, 23, F.col("o_orderstatus")),
            "overview": _null_every(k, 11, F.col("o_orderpriority")),
            "popularity": _null_every(k, 13, F.col("o_totalprice") / 1000),
            "poster_path": nothing,
            "genres": F.col("genres"),
            "production_companies": _null_every(k, 29, F.col("o_orderstatus")),
            "production_countries": _null_every(k, 31, F.lit("US")),
            "spoken_languages": nothing,
            "keywords": _null_every(k, 37, F.col("o_orderpriority")),
        }
        return films.select(*(c.alias(n) for n, c in columns.items()))

    @cached_property
    def movies_cleaned(self) -> DataFrame:
        return clean_movies(self.movies_raw)

    @cached_property
    def genre_track(self) -> DataFrame:
        named = [(c, t) for t, c in TAG_CODES.items() if t != UNNAMED_TAG]
        return self.spark.createDataFrame(named, schemas.GENRE_TRACK)

    def favourites_of(self, cleaned: DataFrame) -> DataFrame:
        """Complete films ordered by customers of one market segment, as the API returns them."""
        buyers = self.table("customer").where(F.col("c_mktsegment") == FAVOURITE_SEGMENT)
        chosen = self.table("orders").join(
            buyers, F.col("o_custkey") == F.col("c_custkey"), "left_semi")
        films = cleaned.where(
            F.col("vote_average").isNotNull() & F.col("popularity").isNotNull()
        ).join(chosen, F.col("id") == F.col("o_orderkey"), "left_semi")
        codes = F.create_map(*(F.lit(x) for pair in TAG_CODES.items() for x in pair))
        columns = {
            "adult": F.col("adult") == "TRUE",
            "genre_ids": F.transform(F.split("genres", ","), lambda t: codes[t].cast("bigint")),
            "release_date": F.date_format("release_date", "yyyy-MM-dd"),
        }
        return films.select(*(columns.get(n, F.col(n)).alias(n) for n in K.PAGE_FIELDS))

    @cached_property
    def favourites(self) -> DataFrame:
        return self.favourites_of(self.movies_cleaned)

    @cached_property
    def favorite_track(self) -> DataFrame:
        return favourite_track(self.favourites, self.genre_track)

    @cached_property
    def film_features(self) -> DataFrame:
        return film_features(self.movies_cleaned)

    @cached_property
    def my_features(self) -> DataFrame:
        return favourite_features(self.favorite_track)

    @cached_property
    def user_vector(self) -> DataFrame:
        return user_profile(self.my_features)
