from cinelake import schemas
from cinelake.operators.tracks import explode_genres, favourite_track, with_genre_names
from tests.conftest import plan

GENRES = [(28, "Action"), (18, "Drama"), (35, "Comedy")]


def favourites(spark, rows):
    names = schemas.FAVOURITES.fieldNames()
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schemas.FAVOURITES)


def genre_track(spark):
    return spark.createDataFrame(GENRES, schemas.GENRE_TRACK)


def test_explode_drops_films_without_genres(spark):
    df = favourites(spark, [
        {"id": 1, "genre_ids": [1, 2]}, {"id": 2, "genre_ids": []}, {"id": 3}])
    assert sorted((r.id, r.genre_id) for r in explode_genres(df).collect()) == [(1, 1), (1, 2)]


def test_unknown_genres_are_dropped_and_names_sorted(spark):
    df = favourites(spark, [
        {"id": 1, "title": "a", "genre_ids": [18, 28, 99]},
        {"id": 2, "title": "b", "genre_ids": [99]},
    ])
    out = favourite_track(df, genre_track(spark))
    assert [(r.id, r.genres) for r in out.collect()] == [(1, ["Action", "Drama"])]
    schemas.assert_schema(out, schemas.FAVOURITE_TRACK)


def test_identical_films_merge_and_their_lists_join_up(spark):
    one = {"id": 1, "title": "a", "popularity": 1.5, "genre_ids": [28, 18]}
    out = favourite_track(favourites(spark, [one, one, {**one, "title": None}]), genre_track(spark))
    assert sorted((r.title or "", r.genres) for r in out.collect()) == [
        ("", ["Action", "Drama"]), ("a", ["Action", "Action", "Drama", "Drama"])]


def test_a_film_repeated_very_often_is_counted_before_it_is_collected(spark):
    one = {"id": 1, "title": "a", "genre_ids": [28]}
    df = favourites(spark, [one]).crossJoin(spark.range(5000)).drop("id_")
    df = df.select(*[df[c] for c in schemas.FAVOURITES.fieldNames() if c != "id"])
    df = df.selectExpr("CAST(1 AS bigint) AS id", "*").select(*schemas.FAVOURITES.fieldNames())
    row = favourite_track(df, genre_track(spark)).first()
    assert row.genres == ["Action"] * 5000


def test_binary_genre_names_are_decoded(spark):
    binary = genre_track(spark).selectExpr("id", "CAST(genre_name AS binary) AS genre_name")
    df = favourites(spark, [{"id": 1, "genre_ids": [28]}])
    assert favourite_track(df, binary).first().genres == ["Action"]


def test_lookup_is_an_inner_join_of_a_size_spark_checks(spark):
    named = with_genre_names(
        explode_genres(favourites(spark, [{"id": 1, "genre_ids": [28]}])), genre_track(spark))
    text = plan(named)
    assert "Inner" in text and "LeftOuter" not in text


def test_wide_columns_are_shuffled_once(spark, tmp_path):
    df = favourites(spark, [{"id": 1, "genre_ids": [28]}])
    genre_track(spark).write.parquet(f"{tmp_path}/g")  # a stored lookup has a size that Spark knows
    text = plan(favourite_track(df, spark.read.parquet(f"{tmp_path}/g")))
    assert text.count("Exchange hashpartitioning") == 1
