import datetime as dt

from pyspark.sql import functions as F

from cinelake import constants as K
from cinelake import schemas
from cinelake.operators.clean import clean_movies, fill_constants, impute_mean, with_key
from cinelake.operators.dedupe import first_per_key
from tests.conftest import plan


def film(**values):
    return tuple(values.get(n) for n in schemas.MOVIES.fieldNames())


def films(spark, rows):
    return spark.createDataFrame([film(**r) for r in rows], schemas.MOVIES)


DAY = dt.date(1999, 5, 1)


def test_text_and_numbers_are_filled(spark):
    row = fill_constants(films(spark, [{"id": 1}])).first().asDict()
    for name, value in K.FILLS.items():
        assert row[name] == value
    for name in ("title", "vote_average", "vote_count", "release_date", "runtime"):
        assert row[name] is None


def test_mean_is_taken_per_year_after_the_key_filter(spark):
    df = films(spark, [
        {"id": 1, "release_date": DAY, "popularity": 2.0},
        {"id": 2, "release_date": DAY, "popularity": 4.0},
        {"id": 3, "release_date": DAY},
        {"id": 4, "release_date": DAY, "popularity": float("nan")},
        {"id": None, "release_date": DAY, "popularity": 1000.0},
        {"id": 5, "release_date": dt.date(2000, 1, 1)},
        {"id": 6},
    ])
    cleaned = {r["id"]: r for r in clean_movies(df).collect()}
    assert cleaned.keys() == {1, 2, 3, 4, 5, 6}
    assert cleaned[3]["popularity"] == cleaned[4]["popularity"] == 3.0
    assert cleaned[5]["popularity"] is None
    assert cleaned[6]["release_year"] is None


def test_cleaned_schema(spark):
    out = clean_movies(films(spark, [{"id": 1, "release_date": DAY}]))
    schemas.assert_schema(out, schemas.DATASETS["silver.movies_cleaned"].stored_schema)


def test_imputation_keeps_a_hot_year_spread_out(spark):
    """Films are not shuffled by year; only one mean per year travels."""
    df = films(spark, [{"id": i, "release_date": DAY, "popularity": float(i)} for i in range(50)])
    text = plan(impute_mean(with_key(df).withColumn("release_year", F.year("release_date"))))
    assert "BroadcastHashJoin" in text
    assert "Window" not in text
    assert "SortMergeJoin" not in text
    # The one exchange is of statistics, combined before it; the films meet them by a broadcast.
    assert text.count("Exchange hashpartitioning") == 1 and "SortMergeJoin" not in text
    assert "partial_" in text.split("Exchange hashpartitioning")[1]


def test_first_per_key_with_a_hot_key(spark):
    rows = [(1, n) for n in range(2000, 0, -1)] + [(k, k) for k in range(2, 1000)]
    df = spark.createDataFrame(rows, "k int, n int").repartition(7)
    first = first_per_key(df, ["k"], ["n"])
    assert {tuple(r) for r in first.collect()} == {(1, 1)} | {(k, k) for k in range(2, 1000)}
    text = plan(first)
    assert text.count("WindowGroupLimit") == 2 and "Partial" in text
