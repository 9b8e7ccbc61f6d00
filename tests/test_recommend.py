import numpy as np
import pytest
from pyspark.sql import functions as F

from cinelake.operators.recommend import score_films, top_films, top_joined
from tests.conftest import plan
from tests.numpy_oracle import numpy_cosine

FILMS = "id bigint, title string"
SCORES = "id bigint, cosine_similarity float"


def frames(spark, rng, n=200, width=24):
    films = {i: rng.normal(size=width) for i in range(n)}
    films[0] = np.zeros(width)
    user = rng.normal(size=width)
    df = spark.createDataFrame(
        [(i, v.tolist()) for i, v in films.items()], "id bigint, movie_vector array<double>")
    mine = spark.createDataFrame([(user.tolist(),)], "user_vector array<double>")
    return films, user, df, mine


@pytest.mark.parametrize("width", [3, 24, 40])
def test_scores_equal_numpy(spark, width):
    films, user, df, mine = frames(spark, np.random.default_rng(1), width=width)
    scored = score_films(df, mine, as_double=True)
    for row in scored.collect():
        assert row.cosine_similarity == pytest.approx(numpy_cosine(user, films[row.id]), abs=1e-12)
    assert dict(score_films(df, mine).dtypes)["cosine_similarity"] == "float"


def test_zero_profile_scores_zero_and_no_profile_scores_nothing(spark):
    _, _, df, mine = frames(spark, np.random.default_rng(2))
    zero = mine.select(F.transform("user_vector", lambda x: x * 0.0).alias("user_vector"))
    assert {r[1] for r in score_films(df, zero).collect()} == {0.0}
    assert score_films(df, mine.where("false")).isEmpty()


def test_seen_films_stay_unless_excluded(spark):
    _, _, df, mine = frames(spark, np.random.default_rng(3))
    seen = spark.createDataFrame([(5,), (5,), (7,)], "id bigint")
    assert score_films(df, mine).count() == 200
    left = {r.id for r in score_films(df, mine, exclude=seen).collect()}
    assert left == set(range(200)) - {5, 7}


def test_profile_enters_without_a_join(spark):
    _, _, df, mine = frames(spark, np.random.default_rng(4))
    text = plan(score_films(df, mine))
    assert "Join" not in text and "Cartesian" not in text


def brute_force(films, scores, k):
    rows = [(s, i, t) for i, t in films for j, s in scores if i == j]
    return [(i, t) for s, i, t in sorted(rows, key=lambda r: (-r[0], r[1]))[:k]]


def test_top_films_equal_a_full_join(spark):
    rng = np.random.default_rng(5)
    scores = [(int(i), float(np.float32(rng.integers(0, 40) / 40))) for i in range(300)]
    films = [(int(i), f"t{i}") for i in range(50, 400)]
    top = top_films(
        spark.createDataFrame(films, FILMS), spark.createDataFrame(scores, SCORES), k=30)
    assert [tuple(r) for r in top.collect()] == brute_force(films, scores, 30)


def test_top_films_with_repeated_ids(spark):
    scores = [(1, 0.5), (1, 0.5), (2, 0.75), (3, 0.25)]
    films = [(1, "a")] * 3 + [(2, "b"), (3, "c")]
    top = top_films(
        spark.createDataFrame(films, FILMS), spark.createDataFrame(scores, SCORES), k=5)
    assert [tuple(r) for r in top.collect()] == brute_force(films, scores, 5)


def test_two_tables_equal_a_full_join(spark):
    scores = [(i, float(np.float32(i % 7 / 7))) for i in range(40)]
    films = [(i, f"t{i}") for i in range(5, 60)]
    other = spark.createDataFrame([(i, 10 * i) for i in range(0, 60, 2)], "id bigint, x bigint")
    top = top_joined(
        [other, spark.createDataFrame(films, FILMS)], spark.createDataFrame(scores, SCORES), 9, rank="rank")
    wanted = brute_force([f for f in films if f[0] % 2 == 0], scores, 9)
    assert [(r.id, r.title, r.x, r["rank"]) for r in top.collect()] == [
        (i, t, 10 * i, n + 1) for n, (i, t) in enumerate(wanted)]


def test_only_ids_and_scores_are_shuffled(spark, tmp_path):
    """Also where Spark would broadcast nothing by itself."""
    spark.createDataFrame([(1, "a")], FILMS).write.parquet(f"{tmp_path}/f")
    spark.createDataFrame([(1, 2.5)], "id bigint, vote double").write.parquet(f"{tmp_path}/r")
    spark.createDataFrame([(1, 0.5)], SCORES).write.parquet(f"{tmp_path}/s")
    films, rating, scores = (spark.read.parquet(f"{tmp_path}/{n}") for n in "frs")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(top_joined([rating, films], scores))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    lines = text.splitlines()
    wide = [n for n, line in enumerate(lines) if "Exchange hashpartitioning" in line]
    assert wide and "SortMergeJoin" in text
    for n in wide:
        below = lines[n + 1]
        assert "title" not in below and "vote" not in below


def test_wide_columns_are_not_shuffled(spark, tmp_path):
    spark.createDataFrame([(1, "a")], FILMS).write.parquet(f"{tmp_path}/f")
    spark.createDataFrame([(1, 0.5)], SCORES).write.parquet(f"{tmp_path}/s")
    text = plan(top_films(spark.read.parquet(f"{tmp_path}/f"), spark.read.parquet(f"{tmp_path}/s")))
    assert "TakeOrderedAndProject" in text and "BroadcastHashJoin" in text
    shuffled = [line for line in text.splitlines() if "Exchange hashpartitioning" in line]
    assert all("title" not in line for line in shuffled)
