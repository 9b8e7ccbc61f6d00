import datetime as dt

import numpy as np
import pytest
from pyspark.ml.feature import HashingTF
from pyspark.sql import functions as F

from cinelake.operators import features as ft
from fixtures.adapter import TAG_SLOTS, Inputs
from tests.conftest import plan
from tests.numpy_oracle import vectors_of

WEIGHTS = (1.0, 0.5, 1.2, 0.8)
SCHEMA = (
    "id bigint, popularity double, release_date date, vote_average double, vote_count bigint, "
    "genres array<string>")


def film(i, year=1999, popularity=1.0, rating=5.0, votes=10, genres=("Drama",)):
    return i, popularity, dt.date(year, 1, 1), rating, votes, list(genres)


def vectors(df, column="movie_vector"):
    return {r["id"]: np.array(r[column]) for r in df.collect()}


@pytest.fixture(scope="module")
def catalogue(spark, sf_dir):
    return Inputs(spark, sf_dir).film_features.cache()


@pytest.fixture(scope="module")
def expected(catalogue):
    complete = catalogue.where("vote_average IS NOT NULL AND popularity IS NOT NULL").cache()
    years = [r[0] for r in complete.select("release_year").distinct().collect()]
    found = {}
    for year in years:
        found.update(vectors_of(complete.where(F.col("release_year") == year)))
    return found


@pytest.mark.parametrize("parts", [1, 2, 3, 5, 8, 16])
def test_one_job_equals_a_fit_per_year(catalogue, expected, parts):
    found = vectors(ft.fit_vectors(catalogue.repartition(parts)))
    assert found.keys() == expected.keys()
    for i, vector in found.items():
        np.testing.assert_allclose(vector, expected[i], rtol=0, atol=1e-11)
        assert vector[1] == 0.0  # the year is constant within a year


def test_global_fit_equals_numpy(catalogue):
    complete = catalogue.where("vote_average IS NOT NULL AND popularity IS NOT NULL")
    found, wanted = vectors(ft.fit_vectors(catalogue, by=None)), vectors_of(complete)
    assert found.keys() == wanted.keys()
    for i, vector in found.items():
        np.testing.assert_allclose(vector, wanted[i], rtol=1e-11, atol=1e-11)


@pytest.mark.parametrize("parts", [1, 2, 3, 5, 8, 16])
def test_a_constant_number_scales_to_exactly_zero(spark, parts):
    rows = [film(i, popularity=0.1 * i, rating=7.3) for i in range(200)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    for vector in vectors(ft.fit_vectors(df)).values():
        assert vector[1] == 0.0 and vector[2] == 0.0 and vector[3] == 0.0


def test_one_film_in_its_group_is_the_zero_vector(spark):
    df = spark.createDataFrame([film(1), film(2, year=2000), film(3, year=2000, votes=3)], SCHEMA)
    found = vectors(ft.fit_vectors(df))
    assert not found[1].any()
    assert found[2].any()


def test_a_hot_year_gives_the_same_vectors(spark):
    """Two thirds of all films in one year; brute force in numpy."""
    rng = np.random.default_rng(3)
    tags = ["Drama", "Action", "Comedy", "War"]
    rows = [
        film(i, year=2000 if i % 3 else 1990 + i % 7, popularity=float(rng.random()),
             rating=float(rng.integers(0, 100)) / 10, votes=int(rng.integers(1, 50)),
             genres=rng.choice(tags, size=rng.integers(0, 4)).tolist())
        for i in range(1500)
    ]
    df = spark.createDataFrame(rows, SCHEMA).repartition(6)
    slot = {
        t: r.indices[0] for t, r in zip(tags, [
            x.tf for x in HashingTF(numFeatures=20, inputCol="g", outputCol="tf").transform(
                spark.createDataFrame([([t],) for t in tags], "g array<string>")).collect()],
            strict=True)}
    found = vectors(ft.fit_vectors(df))
    for year in {r[2].year for r in rows}:
        group = [r for r in rows if r[2].year == year]
        numbers = np.array([[r[1], 0.5 * year, 1.2 * r[3], 0.8 * r[4]] for r in group])
        spread = numbers.std(axis=0, ddof=1)
        scaled = np.divide(numbers, spread, out=np.zeros_like(numbers), where=spread > 1e-9)
        counts = np.zeros((len(group), 20))
        for k, r in enumerate(group):
            for t in r[5]:
                counts[k, slot[t]] += 1
        idf = np.log((len(group) + 1) / ((counts > 0).sum(axis=0) + 1))
        wanted = np.hstack([scaled, counts * idf])
        for k, r in enumerate(group):
            np.testing.assert_allclose(found[r[0]], wanted[k], rtol=1e-9, atol=1e-9)


def test_incomplete_films_are_left_out_and_counted(spark):
    rows = [
        film(1), film(2, popularity=None), film(3, rating=None), film(4, votes=None),
        (5, 1.0, dt.date(1999, 1, 1), 1.0, 1, None), film(6, popularity=float("nan")),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    assert vectors(ft.fit_vectors(df)).keys() == {1}
    assert [tuple(r) for r in ft.incomplete_films(df).collect()] == [(1999, 6, 5)]


def test_no_films_give_no_rows(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert ft.fit_vectors(empty).isEmpty()
    assert ft.fit_vectors(empty, by=None).isEmpty()
    assert ft.user_profile(empty).isEmpty()


def test_slot_table(spark):
    df = spark.createDataFrame([film(i, genres=[t]) for i, t in enumerate(TAG_SLOTS)], SCHEMA)
    counts = vectors(ft.hashed_features(df), ft.INPUTS)
    for i, slot in enumerate(TAG_SLOTS.values()):
        assert np.flatnonzero(counts[i][4:]).tolist() == [slot]


def test_profile_is_the_mean_of_the_vectors(spark, sf_dir):
    mine = Inputs(spark, sf_dir).my_features.cache()
    profile = np.array(ft.user_profile(mine).first()[0])
    fitted = ft.fit_vectors(mine, by=None)
    mean = np.array(ft.mean_vector(fitted, "movie_vector", 24).first()[0])
    dated = mine.withColumn("release_year", F.year(F.col("release_date").cast("date")))
    wanted = np.mean(list(vectors_of(dated).values()), axis=0)
    np.testing.assert_allclose(profile, mean, rtol=1e-12)
    np.testing.assert_allclose(profile, wanted, rtol=1e-11)


def test_weights_cancel_unless_applied_after_scaling(catalogue):
    plain = ft.VectorSpec(weights={n: 1.0 for n in ft.DEFAULT.weights})
    after = ft.VectorSpec(weights_after_scaling=True)
    default = vectors(ft.fit_vectors(catalogue))
    unweighted = vectors(ft.fit_vectors(catalogue, spec=plain))
    weighted = vectors(ft.fit_vectors(catalogue, spec=after))
    factors = np.array([*WEIGHTS, *[1.0] * 20])
    for i, vector in default.items():
        np.testing.assert_allclose(vector, unweighted[i], atol=1e-11)
        np.testing.assert_allclose(vector * factors, weighted[i], atol=1e-11)


def test_more_slots_separate_tags(spark):
    rows = [film(1, genres=["Comedy"]), film(2, genres=["Crime"]), film(3, genres=[])]
    df = spark.createDataFrame(rows, SCHEMA)
    few = vectors(ft.fit_vectors(df))
    many = vectors(ft.fit_vectors(df, spec=ft.VectorSpec(slots=997)))
    assert np.flatnonzero(few[1]).tolist() == np.flatnonzero(few[2]).tolist()
    assert np.flatnonzero(many[1]).tolist() != np.flatnonzero(many[2]).tolist()
    assert len(many[1]) == 1001


def test_films_are_not_shuffled(catalogue, spark, sf_dir):
    stored = spark.createDataFrame([film(1)], SCHEMA).repartition(3)
    text = plan(ft.fit_vectors(stored))
    # The one exchange is of statistics, combined before it; the films meet them by a broadcast.
    assert text.count("Exchange hashpartitioning") == 1 and "SortMergeJoin" not in text
    assert "partial_" in text.split("Exchange hashpartitioning")[1]
    assert "BroadcastHashJoin" in text
    assert "CartesianProduct" not in text and "NestedLoop" not in text
    assert "NestedLoop" not in plan(ft.fit_vectors(stored, by=None))
