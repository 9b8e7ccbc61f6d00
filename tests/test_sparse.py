"""Sparse vectors against the dense ones, and fits merged from statistics of years."""

import datetime as dt

import numpy as np
import pytest
from pyspark.ml.feature import HashingTF
from pyspark.sql import functions as F

from cinelake.operators import features as ft
from cinelake.operators import recommend, sparse
from cinelake.plans.lakehouse import Lakehouse
from cinelake.sources import ParquetWarehouse
from fixtures.adapter import TAG_SLOTS_WIDE, Inputs
from tests.conftest import plan
from tests.test_features import SCHEMA, film


@pytest.fixture(scope="module")
def catalogue(spark, sf_dir):
    return Inputs(spark, sf_dir).film_features.cache()


def dense(df, width):
    found = {}
    for r in df.collect():
        vector = np.zeros(width)
        vector[r["indices"]] = r["values"]
        assert r["indices"] == sorted(set(r["indices"])) and all(r["values"])
        found[r["id"]] = vector
    return found


def test_slot_table(spark):
    assert {t: HashingTF(numFeatures=2000).indexOf(t) for t in TAG_SLOTS_WIDE} == TAG_SLOTS_WIDE


@pytest.mark.parametrize("by", ["release_year", None])
@pytest.mark.parametrize("spec", [ft.DEFAULT, ft.VectorSpec(slots=53, weights_after_scaling=True)])
def test_sparse_equals_dense(catalogue, by, spec):
    wanted = {r["id"]: np.array(r["movie_vector"]) for r in ft.fit_vectors(catalogue, by, spec).collect()}
    found = dense(sparse.fit_vectors(catalogue, by, spec), spec.width)
    assert found.keys() == wanted.keys()
    for i, vector in found.items():
        np.testing.assert_allclose(vector, wanted[i], rtol=1e-10, atol=1e-11)


def test_scores_equal_the_dense_ones(catalogue, spark, sf_dir):
    mine = Inputs(spark, sf_dir).my_features
    wanted = {r["id"]: r["cosine_similarity"] for r in recommend.score_films(
        ft.fit_vectors(catalogue), ft.user_profile(mine), as_double=True).collect()}
    found = {r["id"]: r["cosine_similarity"] for r in sparse.score_films(
        sparse.fit_vectors(catalogue), sparse.user_profile(mine), as_double=True).collect()}
    assert found.keys() == wanted.keys()
    assert all(abs(found[i] - wanted[i]) < 1e-11 for i in found)


def test_rows_that_share_an_id_and_films_without_tags_keep_a_vector_each(spark):
    rows = [film(1, genres=["a", "a", "b"]), film(1, genres=["a"], votes=7), film(1, genres=["a"], votes=7), film(2, genres=[], popularity=3.0)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    wanted = sorted((r["id"], [round(x, 9) + 0.0 for x in r["movie_vector"]]) for r in ft.fit_vectors(df).collect())
    found = []
    for r in sparse.fit_vectors(df).collect():
        vector = np.zeros(ft.DEFAULT.width)
        vector[r["indices"]] = r["values"]
        found.append((r["id"], [round(x, 9) + 0.0 for x in vector.tolist()]))
    assert sorted(found) == wanted


def test_no_films_and_one_film(spark):
    empty = spark.createDataFrame([], SCHEMA)
    for by in ("release_year", None):
        assert sparse.fit_vectors(empty, by).isEmpty()
        one = sparse.fit_vectors(spark.createDataFrame([film(1)], SCHEMA), by).collect()
        assert [(r["id"], r["indices"], r["values"]) for r in one] == [(1, [], [])]
    assert sparse.user_profile(empty).isEmpty()
    profile = sparse.user_profile(spark.createDataFrame([film(1)], SCHEMA))
    scored = sparse.score_films(sparse.fit_vectors(spark.createDataFrame([film(1)], SCHEMA)), profile)
    assert [tuple(r) for r in scored.collect()] == [(1, 0.0)]
    assert sparse.score_films(sparse.fit_vectors(spark.createDataFrame([film(1)], SCHEMA)), sparse.user_profile(empty)).isEmpty()


def test_merged_statistics_equal_those_of_all_films(spark):
    draw = np.random.default_rng(8)
    rows = [(i, float(draw.normal(1e6, 1.0)), dt.date(int(1950 + i % 40), 1, 1), float(draw.normal()), int(draw.integers(1, 9)),
             draw.choice(["a", "b", "c", "d"], draw.integers(0, 4)).tolist()) for i in range(2000)]
    inputs = sparse.sparse_inputs(spark.createDataFrame(rows, SCHEMA))
    whole = {r["dim"]: r for r in sparse.statistics(inputs.withColumn("release_year", F.lit(1))).collect()}
    merged = {r["dim"]: r for r in sparse.merged(sparse.statistics(inputs)).collect()}
    assert merged.keys() == whole.keys()
    for dim, row in merged.items():
        assert (row["n"], row["low"], row["high"]) == (whole[dim]["n"], whole[dim]["low"], whole[dim]["high"])
        np.testing.assert_allclose([row["mean"], row["m2"]], [whole[dim]["mean"], whole[dim]["m2"]], rtol=1e-9)
    popularity = np.array([r[1] for r in rows])
    np.testing.assert_allclose(merged[0]["m2"], ((popularity - popularity.mean()) ** 2).sum(), rtol=1e-9)


def test_a_changed_year_is_all_that_is_counted_again(catalogue, spark, tmp_path):
    house = Lakehouse(spark, f"{tmp_path}/lake", ParquetWarehouse("unused"), last_year=2001, fit_by_year=False)
    house.lake.write(catalogue, "silver.movies_vectors", arrives_by_year=True)
    house.gold_movies_vector()
    changed = catalogue.where("release_year = 1996").withColumn("vote_average", F.col("vote_average") + 1)
    house.lake.write(changed, "silver.movies_vectors", arrives_by_year=True)
    assert house.gold_vector_statistics([1996]).row_count < 40
    house.gold_movies_vector([1996])
    found = {r["id"]: np.array(r["movie_vector"]) for r in house.lake.read("gold.movies_vector").collect()}
    again = house.lake.read("silver.movies_vectors")
    wanted = {r["id"]: np.array(r["movie_vector"]) for r in ft.fit_vectors(again, None).collect()}
    assert found.keys() == wanted.keys()
    for i, vector in found.items():
        np.testing.assert_allclose(vector, wanted[i], rtol=1e-10, atol=1e-11)


def test_statistics_are_combined_before_the_shuffle_and_nothing_is_crossed(catalogue):
    text = plan(sparse.fit_vectors(catalogue, spec=ft.VectorSpec(slots=2000)))
    assert "partial_count" in text
    assert "CartesianProduct" not in text and "NestedLoop" not in text
