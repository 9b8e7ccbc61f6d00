"""The lakehouse from sources to serving models.

One method per dataset. Each reads its inputs from the lake and overwrites its output, so any of
them can be run again on its own; the yearly ones take ``years`` to rework only those.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cinelake import constants as K
from cinelake import schemas
from cinelake.operators import clean, features, quality, recommend, sparse, tracks
from cinelake.operators.features import DEFAULT, VectorSpec
from cinelake.plans import marts
from cinelake.plans.views import publish_views
from cinelake.sources import Lake, Profile, Warehouse, as_view, extract_years, publish

Years = Iterable[int] | None


class Lakehouse:
    def __init__(
        self, spark: SparkSession, root: str, warehouse: Warehouse, last_year: int,
        first_year: int = K.FIRST_YEAR, spec: VectorSpec = DEFAULT, trim_tags: bool = False,
        fit_by_year: bool = True, shared_space: bool = False, exclude_seen: bool = False,
        dashboards: str | None = None,
    ) -> None:
        """``fit_by_year=False`` fits all years together, ``shared_space`` gives the profile the
        statistics of the whole catalogue, and ``exclude_seen`` leaves favourites unscored.
        ``dashboards`` names a catalogue database whose views outlive the session."""
        self.spark = spark
        self.lake = Lake(spark, root)
        self.warehouse = warehouse
        self.first_year, self.last_year = first_year, last_year
        self.spec = spec
        self.trim_tags = trim_tags
        self.fit_by_year = fit_by_year
        self.shared_space = shared_space
        self.exclude_seen = exclude_seen
        self.dashboards = dashboards

    # Bronze: sources as they are.

    def bronze_movies(self, movies: DataFrame, years: Years = None) -> Profile:
        first, last = self.first_year, self.last_year
        if years is not None:
            years = [y for y in years if first <= y <= last]
            first, last = min(years, default=first), max(years, default=first)
        movies = schemas.conform(movies, schemas.MOVIES)
        films = clean.with_year(extract_years(movies, last, first))
        if years is not None:
            films = films.where(F.col(schemas.YEAR_COLUMN).isin(years))
        return self.lake.write(films, "bronze.movies")

    def bronze_movies_moved(self, movies: DataFrame, years: Iterable[int]) -> tuple[Profile, list[int]]:
        """Load ``years`` and take their films out of the years they were in before.

        A film whose year was corrected arrives in its new year, while a load of that year alone
        leaves the old copy where it is. The stored index of ids and years names the older
        partitions that hold such copies; only those are read and written again. Returns the
        profile of the load and every year whose later datasets need to be reworked.
        """
        stored = self.lake.years("bronze.movies")
        profile = self.bronze_movies(movies, years)
        loaded = sorted(set(years) & set(self.lake.years("bronze.movies")))
        arrived = self.lake.read("bronze.movies", loaded).where("id IS NOT NULL").select("id").distinct()
        known = self._film_years(sorted(set(stored) - set(loaded)))
        # One row per year at most.
        older = sorted(r[0] for r in known.join(arrived, "id", "left_semi").select(schemas.YEAR_COLUMN).distinct().collect())
        if older:
            kept = self.lake.read("bronze.movies", older).join(arrived, "id", "left_anti")
            left = {r[0] for r in kept.select(schemas.YEAR_COLUMN).distinct().collect()}
            self.lake.write(kept, "bronze.movies")
            self.lake.drop_years("bronze.movies", set(older) - left)
        self.bronze_movie_years(sorted({*loaded, *older}))
        return profile, sorted({*loaded, *older})

    def _film_years(self, years: list[int]) -> DataFrame:
        """The index of ``years``, first worked out for those that were loaded without it."""
        missing = sorted(set(years) - set(self.lake.years("bronze.movie_years")))
        if missing:
            self.bronze_movie_years(missing)
        return self.lake.read("bronze.movie_years", years)

    def bronze_movie_years(self, years: Iterable[int]) -> Profile:
        """The index of ids, yearly like the films: two narrow columns of them."""
        present = set(self.lake.years("bronze.movies"))
        self.lake.drop_years("bronze.movie_years", set(years) - present)
        films = self.lake.read("bronze.movies", sorted(set(years) & present))
        return self.lake.write(films.select("id", schemas.YEAR_COLUMN), "bronze.movie_years", arrives_by_year=True)

    def bronze_genre_track(self, genre_track: DataFrame) -> Profile:
        return self.lake.write(schemas.conform(genre_track, schemas.GENRE_TRACK), "bronze.genre_track")

    def bronze_favorite_movies(self, favourites: DataFrame) -> Profile:
        return self.lake.write(favourites, "bronze.favorite_movies")

    # Silver: cleaned films, favourites with genre names, feature columns of both.

    def silver_movies_cleaned(self, years: Years = None) -> Profile:
        films = clean.clean_movies(self.lake.read("bronze.movies", years))
        return self.lake.write(films, "silver.movies_cleaned", arrives_by_year=True)

    def silver_movies_vectors(self, years: Years = None) -> Profile:
        films = self.lake.read("silver.movies_cleaned", years)
        return self.lake.write(
            features.film_features(films, self.trim_tags), "silver.movies_vectors",
            arrives_by_year=True)

    def silver_favorite_track(self) -> Profile:
        track = tracks.favourite_track(
            self.lake.read("bronze.favorite_movies"), self.lake.read("bronze.genre_track"))
        return self.lake.write(track, "silver.favorite_track")

    def silver_my_vector(self) -> Profile:
        track = self.lake.read("silver.favorite_track")
        return self.lake.write(features.favourite_features(track), "silver.my_vector")

    # Gold: projections, vectors and scores.

    def gold_movies_infor(self) -> Profile:
        return self._project(marts.movies_infor, "gold.movies_infor")

    def gold_movies_rating(self) -> Profile:
        return self._project(marts.movies_rating, "gold.movies_rating")

    def gold_movies_genres(self) -> Profile:
        return self._project(marts.movies_genres, "gold.movies_genres")

    def _project(self, projection, name: str) -> Profile:
        return self.lake.write(projection(self.lake.read("silver.movies_cleaned")), name)

    def gold_my_vector(self) -> Profile:
        mine = self.lake.read("silver.my_vector")
        if self.shared_space:
            catalogue = self.lake.read("silver.movies_vectors")
            profile = features.profile_in_catalogue_space(mine, catalogue, self.spec)
        else:
            profile = features.user_profile(mine, self.spec)
        return self.lake.write(profile, "gold.my_vector")

    def gold_vector_statistics(self, years: Years = None) -> Profile:
        """Mergeable statistics of each year, from its films alone."""
        films = self.lake.read("silver.movies_vectors", years)
        return self.lake.write(sparse.statistics(sparse.sparse_inputs(films, self.spec)), "gold.vector_statistics")

    def gold_movies_vector(self, years: Years = None) -> Profile:
        """Vectors of all films, or of ``years``.

        Fitted over all years, a changed year changes every vector: only the statistics of
        ``years`` are worked out again, merged with the stored ones, and all films take the result.
        """
        if self.fit_by_year:
            films = self.lake.read("silver.movies_vectors", years)
            vectors = features.fit_vectors(films, schemas.YEAR_COLUMN, self.spec)
        else:
            self.gold_vector_statistics(years)
            stats = sparse.merged(self.lake.read("gold.vector_statistics"))
            fitted = sparse.factor_array(sparse.factors(stats, self.spec, None), self.spec)
            hashed = features.hashed_features(self.lake.read("silver.movies_vectors"), self.spec)
            vectors = features.transform(hashed, fitted, None)
        return self.lake.write(vectors, "gold.movies_vector", arrives_by_year=True)

    def gold_recommendations(self) -> Profile:
        seen = self.lake.read("silver.favorite_track") if self.exclude_seen else None
        scores = recommend.score_films(
            self.lake.read("gold.movies_vector"), self.lake.read("gold.my_vector"), exclude=seen)
        return self.lake.write(scores, "gold.recommendations")

    # Warehouse and models.

    def publish(self, table: str, enforce_keys: bool = False) -> DataFrame:
        source = "silver.favorite_track" if table == "favorite_track" else f"gold.{table}"
        return publish(self.lake.read(source), table, self.warehouse, enforce_keys)

    def _table(self, name: str) -> DataFrame:
        return self.warehouse.load(self.spark, name)

    def marts_infor_rating(self) -> Profile:
        """The joined model as a table, so that its readers do not join again."""
        model = marts.infor_rating(self._table("movies_infor"), self._table("movies_rating"))
        return self.lake.write(model, "marts.infor_rating")

    def marts_recommendations(self, k: int = K.TOP_FILMS) -> Profile:
        ranking = marts.recommendations(
            self.infor_rating(), self._table("recommendations"), k, rank="rank")
        return self.lake.write(ranking, "marts.recommendations")

    def dashboard_views(self) -> None:
        as_view(self.voting_distribution(), "voting_distribution")
        as_view(self.monthly_release_movies(), "monthly_release_movies")
        if self.dashboards:
            publish_views(self.lake, self.dashboards)

    def infor_rating(self) -> DataFrame:
        return self.lake.read("marts.infor_rating")

    def recommendations(self) -> DataFrame:
        """The stored ranking, best first."""
        return self.lake.read("marts.recommendations").orderBy("rank").drop("rank")

    def marts_quality_report(self, key_checks: dict[str, DataFrame]) -> Profile:
        """Key checks of the published tables, rules of the models, and films without a vector."""
        parts = dict(key_checks)
        for model, rules in quality.MODEL_RULES.items():
            parts[f"marts.{model}"] = quality.check(self.lake.read(f"marts.{model}"), rules)
        films = features.incomplete_films(self.lake.read("silver.movies_vectors"), self.spec)
        parts["silver.movies_vectors"] = films.agg(
            F.coalesce(F.sum("incomplete"), F.lit(0)).alias("violations")).select(
            F.lit("complete").alias("rule"), F.lit("movie_vector").alias("column"), "violations")
        lines = [part.select(F.lit(name).alias("checked"), "*") for name, part in parts.items()]
        return self.lake.write(reduce(DataFrame.unionByName, lines), "marts.quality_report")

    def quality_report(self) -> DataFrame:
        """``(checked, rule, column, violations)`` of the last run."""
        return self.lake.read("marts.quality_report")

    def voting_distribution(self) -> DataFrame:
        return marts.voting_distribution(self.infor_rating())

    def monthly_release_movies(self) -> DataFrame:
        return marts.monthly_release_movies(self._table("movies_infor"))

    def search(self, **filters) -> DataFrame:
        return marts.search_films(self.infor_rating(), **filters)

    def run(
        self, movies: DataFrame, genre_track: DataFrame,
        favourites: DataFrame | Callable[[DataFrame], DataFrame],
    ) -> list[Profile]:
        """Build every dataset, warehouse table and model; returns the write profiles.

        Favourites that are chosen from the catalogue are given as a function of its cleaned films:
        it gets the stored ones, so that the sources are gone through once.
        """
        profiles = [self.bronze_movies(movies), self.silver_movies_cleaned()]
        if not isinstance(favourites, DataFrame):
            favourites = favourites(self.lake.read("silver.movies_cleaned"))
        profiles += [
            self.bronze_genre_track(genre_track),
            self.bronze_favorite_movies(favourites),
            self.silver_movies_vectors(),
            self.silver_favorite_track(),
            self.silver_my_vector(),
            self.gold_movies_infor(),
            self.gold_movies_rating(),
            self.gold_movies_genres(),
            self.gold_my_vector(),
            self.gold_movies_vector(),
            self.gold_recommendations(),
        ]
        checks = {table: self.publish(table) for table in schemas.WAREHOUSE}
        profiles += [self.marts_infor_rating(), self.marts_recommendations()]
        profiles.append(self.marts_quality_report(checks))
        self.dashboard_views()
        return profiles
