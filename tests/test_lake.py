import datetime as dt
import threading
import time

import pytest
from pyspark.sql import functions as F

from cinelake import schemas
from cinelake.operators import quality
from cinelake.operators.clean import with_year
from cinelake.plans import marts
from cinelake.plans.lakehouse import Lakehouse
from cinelake.session import scratch_folder
from cinelake.sources import CatalogWarehouse, Lake, ParquetWarehouse, as_table, publish
from fixtures.adapter import LAST_YEAR, Inputs
from tests.conftest import formatted_plan, plan
from tests.test_clean import films


def some_films(spark, runtime=100):
    return with_year(films(spark, [
        {"id": i, "title": f"t{i}", "release_date": dt.date(1990 + i % 3, 1, 1), "runtime": runtime}
        for i in range(30)]))


def runtimes(df):
    return {(r.release_year, r.runtime) for r in df.collect()}


def test_a_year_is_overwritten_alone(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    stored = lake.write(some_films(spark), "bronze.movies")
    assert (stored.row_count, stored.column_count, stored.written) == (30, 21, True)
    again = lake.write(some_films(spark, 7).where("release_year = 1991"), "bronze.movies")
    assert again.row_count == 10
    assert runtimes(lake.read("bronze.movies")) == {(1990, 100), (1991, 7), (1992, 100)}
    assert lake.read("bronze.movies").count() == 30


def test_a_hot_year_is_written_by_several_tasks(spark, tmp_path):
    """Five sixths of the rows in one year."""
    lake = Lake(spark, str(tmp_path))
    row = some_films(spark).where("id = 0").drop("id", "release_year")
    many = spark.range(60_000).join(row).selectExpr(
        "*", "CAST(IF(id % 6 = 0, 1991, 1990) AS int) AS release_year",
        "md5(CAST(id AS string)) AS noise").withColumn("overview", F.col("noise")).drop("noise")
    setting = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "200k")
    try:
        lake.write(many.repartition(12), "bronze.movies")
    finally:
        spark.conf.set(setting, before)
    hot = [f for f in lake.read("bronze.movies").inputFiles() if "release_year=1990" in f]
    assert len(hot) > 1
    assert lake.read("bronze.movies").groupBy("release_year").count().collect() in (
        [(1990, 50_000), (1991, 10_000)], [(1991, 10_000), (1990, 50_000)])


def test_bronze_takes_only_the_given_years_of_the_domain(spark, tmp_path):
    house = Lakehouse(
        spark, str(tmp_path), ParquetWarehouse(f"{tmp_path}/wh"), first_year=1991, last_year=2000)
    movies = some_films(spark).drop("release_year")
    assert house.bronze_movies(movies, years=[1990, 1992]).row_count == 10
    assert not house.bronze_movies(movies, years=[1990]).written
    assert runtimes(house.lake.read("bronze.movies")) == {(1992, 100)}
    assert house.bronze_movies(movies).row_count == 20


def test_running_a_year_twice_changes_nothing(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    for _ in range(2):
        lake.write(some_films(spark), "bronze.movies")
    assert lake.read("bronze.movies").count() == 30


def test_empty_frames_are_not_written(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    lake.write(some_films(spark), "bronze.movies")
    assert not lake.write(some_films(spark).where("false"), "bronze.movies").written
    assert lake.read("bronze.movies").count() == 30
    genres = spark.createDataFrame([(1, "a")], schemas.GENRE_TRACK)
    assert lake.write(genres, "bronze.genre_track").written
    assert not lake.write(genres.where("false"), "bronze.genre_track").written
    assert lake.read("bronze.genre_track").count() == 1
    assert lake.write(genres.withColumn("id", F.lit(2)), "bronze.genre_track").written
    assert lake.read("bronze.genre_track").first().id == 2
    assert [p.name for p in (tmp_path / "bronze").iterdir() if "genre" in p.name] == ["genre_track"]


def test_a_frame_that_turns_out_empty_is_counted_as_such(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    genres = spark.createDataFrame([(1, "a")], schemas.GENRE_TRACK)
    lake.write(genres, "bronze.genre_track")
    nothing = genres.join(lake.read("bronze.genre_track").select("id"), "id", "left_anti")
    profile = lake.write(nothing, "bronze.genre_track")
    assert (profile.row_count, profile.written) == (0, False)


def test_a_failed_write_keeps_the_old_data(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    genres = spark.createDataFrame([(1, "a")], schemas.GENRE_TRACK)
    lake.write(genres, "bronze.genre_track")
    broken = genres.withColumn("genre_name", F.raise_error(F.lit("broken")).cast("string"))
    with pytest.raises(Exception, match="broken"):
        lake.write(broken, "bronze.genre_track")
    assert lake.read("bronze.genre_track").first().genre_name == "a"
    assert [p.name for p in (tmp_path / "bronze").iterdir()] == ["genre_track"]


def test_a_reader_never_meets_a_gap(spark, tmp_path):
    """Readers resolve and read all the time while versions are replaced."""
    lake = Lake(spark, str(tmp_path))
    genres = spark.createDataFrame([(n, "a") for n in range(50)], schemas.GENRE_TRACK).cache()
    lake.write(genres, "bronze.genre_track")
    found, failures, done = [], [], threading.Event()

    def read():
        while not done.is_set():
            try:
                rows = lake.read("bronze.genre_track").agg(F.count("*").alias("n"), F.min("genre_name").alias("a"), F.max("genre_name").alias("z")).first()
                found.append((rows.n, rows.a == rows.z))
            except Exception as error:
                failures.append(str(error)[:300])

    readers = [threading.Thread(target=read) for _ in range(2)]
    for thread in readers:
        thread.start()
    for turn in range(6):
        seen = len(found)
        lake.write(genres.withColumn("genre_name", F.lit(f"v{turn}")), "bronze.genre_track")
        deadline = time.monotonic() + 20
        while len(found) < seen + 2 and time.monotonic() < deadline:
            time.sleep(0.05)
    done.set()
    for thread in readers:
        thread.join()
    assert not failures and set(found) == {(50, True)}
    assert lake.read("bronze.genre_track").first().genre_name == "v5"


def test_a_version_once_resolved_outlives_the_next_write(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    genres = spark.createDataFrame([(1, "a")], schemas.GENRE_TRACK)
    for turn in range(4):
        lake.write(genres.withColumn("id", F.lit(turn)), "bronze.genre_track")
        if turn == 2:
            held = lake.read("bronze.genre_track")
    assert (held.first().id, lake.read("bronze.genre_track").first().id) == (2, 3)
    names = sorted(p.name for p in (tmp_path / "bronze" / "genre_track").iterdir() if not p.name.endswith(".crc"))
    assert len(names) == 3 and names[0] == "_current-00000004"


def test_a_folder_without_pointer_is_read_as_it_is(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    spark.createDataFrame([(1, "a")], schemas.GENRE_TRACK).write.parquet(lake.path("bronze.genre_track"))
    assert lake.read("bronze.genre_track").first().id == 1


def scanned_rows(df):
    """Rows that the scans of a query gave, after files and row groups were skipped."""
    df.collect()

    def scans(plan):
        leaves = plan.collectLeaves()
        for leaf in (leaves.apply(k) for k in range(leaves.size())):
            if "QueryStage" in leaf.getClass().getName():
                yield from scans(leaf.plan())
            else:
                yield leaf

    return sum(s.metrics().apply("numOutputRows").value() for s in scans(df._jdf.queryExecution().executedPlan().executedPlan()))


def test_search_skips_files_by_year_and_by_rating(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    spread = "CAST(1950 + pmod(xxhash64(id), 64) AS int) AS release_year", "pmod(xxhash64(id, 7), 100) / 10.0D AS vote_average"
    model = spark.range(20_000).selectExpr(
        "id", "'t' AS title", "'o' AS overview", spread[0], "90 AS runtime", "'a,b' AS genres", spread[1])
    setting = "spark.sql.adaptive.coalescePartitions.enabled"
    shuffle = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set(setting, "false")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        lake.write(model, "marts.infor_rating")
    finally:
        spark.conf.set(setting, "true")
        spark.conf.set("spark.sql.shuffle.partitions", shuffle)
    stored = lake.read("marts.infor_rating")
    assert len(stored.inputFiles()) == 64
    for filters in ({"years": (1960, 1963)}, {"rating": (8.0, 8.9)}, {"years": (1960, 1970), "rating": (2.0, 4.0)}):
        found = marts.search_films(stored, **filters)
        wanted = marts.search_films(model, **filters)
        assert sorted(map(tuple, found.collect())) == sorted(map(tuple, wanted.collect()))
        assert scanned_rows(found.groupBy().count()) < 20_000 / 3  # a count needs no order


def test_a_servers_types_fit_bronze_and_others_are_refused(spark, tmp_path):
    house = Lakehouse(spark, str(tmp_path), ParquetWarehouse(f"{tmp_path}/wh"), last_year=2000)
    movies = some_films(spark).drop("release_year")
    typed = movies.withColumns({
        "popularity": F.lit(1.5).cast("float"), "vote_count": F.lit(3).cast("int"),
        "release_date": F.col("release_date").cast("timestamp"), "title": F.encode("title", "UTF-8")})
    assert house.bronze_movies(typed).row_count == 30
    row = house.lake.read("bronze.movies").where("id = 4").first()
    assert (row.title, row.popularity, row.vote_count, row.release_date) == ("t4", 1.5, 3, dt.date(1991, 1, 1))
    with pytest.raises(schemas.SchemaMismatch, match="vote_average: string"):
        house.bronze_movies(movies.withColumn("vote_average", F.lit("5")))


def test_models_are_replaced_even_by_nothing(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    model = spark.createDataFrame([(1, "t", "o", 1999, 90, "g", 5.0)], schemas.INFOR_RATING)
    assert lake.write(model, "marts.infor_rating").row_count == 1
    assert lake.write(model.where("false"), "marts.infor_rating").written
    assert lake.read("marts.infor_rating").isEmpty()


def test_years_prune_partitions(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    lake.write(some_films(spark), "bronze.movies")
    df = lake.read("bronze.movies", years=[1991])
    assert runtimes(df) == {(1991, 100)}
    text = formatted_plan(df.select("id"))
    assert "PartitionFilters: [isnotnull(release_year" in text
    assert "ReadSchema: struct<id:bigint>" in text
    with pytest.raises(ValueError):
        lake.read("bronze.genre_track", years=[1991])


def test_wrong_columns_are_refused(spark, tmp_path):
    with pytest.raises(schemas.SchemaMismatch):
        Lake(spark, str(tmp_path)).write(spark.range(1), "gold.movies_rating")


def test_scratch_folder_follows_the_session(spark):
    shared = spark.conf.get("spark.checkpoint.dir", None)
    folder = scratch_folder(spark, "x")
    assert "/x-" in folder and folder != scratch_folder(spark, "x")
    if shared:
        assert folder.startswith(f"{shared}/x-")


def test_no_machine_local_scratch_on_a_cluster():
    class Cluster:
        class conf:  # noqa: N801
            get = staticmethod(lambda key, default: default)

        class sparkContext:  # noqa: N801
            master = "spark://host:7077"
            getCheckpointDir = staticmethod(lambda: None)  # noqa: N815

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_folder(Cluster, "x")


def report(df):
    return {(r.rule, r.column): r.violations for r in df.collect()}


def test_checks(spark):
    df = spark.createDataFrame(
        [(1, "a", 1), (1, None, 2), (None, None, 2), (None, "b", 3), (4, "c", 3)],
        "id int, title string, k int")
    rules = [quality.unique("id"), quality.not_null("id"), quality.not_null("title"),
             quality.unique("k")]
    assert report(quality.check(df, rules)) == {
        ("unique", "id"): 1, ("not_null", "id"): 2, ("not_null", "title"): 2, ("unique", "k"): 2}
    assert report(quality.check(df, [quality.not_null("title")])) == {("not_null", "title"): 2}
    assert report(quality.check(df.where("false"), rules)) == dict.fromkeys(
        [("unique", "id"), ("not_null", "id"), ("not_null", "title"), ("unique", "k")], 0)


def test_publish_reports_or_enforces_keys(spark, tmp_path):
    warehouse = ParquetWarehouse(str(tmp_path))
    twice = spark.createDataFrame([(1, 1.0, 1), (1, 2.0, 2)], schemas.MOVIES_RATING)
    checked = publish(twice, "movies_rating", warehouse)
    assert report(checked) == {("unique", "id"): 1, ("not_null", "id"): 0}
    assert warehouse.load(spark, "movies_rating").count() == 2
    with pytest.raises(quality.KeyViolation):
        publish(twice, "movies_rating", warehouse, enforce_keys=True)


def test_bucketed_tables_join_without_a_shuffle(spark, tmp_path):
    a = spark.range(100).select("id", (F.col("id") * 2).alias("x"))
    for name in ("bucketed_a", "bucketed_b"):
        as_table(a, name, f"{tmp_path}/{name}", bucket_by=("id", 4))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(spark.table("bucketed_a").join(spark.table("bucketed_b"), "id"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        spark.sql("DROP TABLE bucketed_a")
        spark.sql("DROP TABLE bucketed_b")
    assert "SortMergeJoin" in text and "Exchange" not in text
    assert len(list(tmp_path.glob("bucketed_a/*.parquet"))) <= 4


def test_models_on_bucketed_tables_need_no_shuffle_on_id(spark, tmp_path):
    house = Lakehouse(
        spark, f"{tmp_path}/lake",
        CatalogWarehouse(f"{tmp_path}/wh", "default", buckets=4), last_year=2000)
    stored = spark.range(50).selectExpr(
        "id", "'t' AS title", "'o' AS overview", "DATE'1999-01-01' AS release_date",
        "1 AS runtime", "'g' AS genres")
    house.lake.write(stored, "gold.movies_infor")
    house.lake.write(
        stored.selectExpr("id", "1.5D AS vote_average", "id AS vote_count"), "gold.movies_rating")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        house.publish("movies_infor")
        house.publish("movies_rating")
        model = marts.infor_rating(
            house.warehouse.load(spark, "movies_infor"), house.warehouse.load(spark, "movies_rating"))
        assert "Exchange" not in plan(model)
        assert model.count() == 50
        house.publish("movies_rating")  # once more, over the table that is there
        assert house.marts_infor_rating().row_count == 50
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        spark.sql("DROP TABLE default.movies_infor")
        spark.sql("DROP TABLE default.movies_rating")


def test_films_read_by_year_are_written_where_they_are(spark, tmp_path, monkeypatch):
    lake = Lake(spark, str(tmp_path))
    lake.write(some_films(spark), "bronze.movies")
    hints = []
    monkeypatch.setattr(
        type(lake.read("bronze.movies")), "hint",
        lambda self, *a, **k: hints.append(a) or self)
    lake.write(lake.read("bronze.movies", years=[1990]).withColumn("runtime", F.lit(1)),
               "bronze.movies", arrives_by_year=True)
    assert hints == []
    assert runtimes(lake.read("bronze.movies")) == {(1990, 1), (1991, 100), (1992, 100)}


def test_lakehouse_runs_and_reworks_a_year(spark, sf_dir, tmp_path):
    i = Inputs(spark, sf_dir)
    house = Lakehouse(
        spark, f"{tmp_path}/lake", ParquetWarehouse(f"{tmp_path}/wh"), last_year=LAST_YEAR)
    profiles = {p.table: p for p in house.run(i.movies_raw, i.genre_track, i.favourites)}
    assert profiles["bronze.movies"].row_count == i.movies_raw.count()
    assert profiles["gold.my_vector"].row_count == 1
    assert all(p.written for p in profiles.values())
    assert profiles["gold.recommendations"].row_count == profiles["gold.movies_vector"].row_count
    assert house.recommendations().count() == 100
    scores = {r.id: r.cosine_similarity for r in house.lake.read("gold.recommendations").collect()}
    ranked = [r.id for r in house.recommendations().collect()]
    assert ranked == sorted(ranked, key=lambda i: (-scores[i], i))
    checked = {(r.checked, r.rule, r.column): r.violations for r in house.quality_report().collect()}
    assert len(checked) == 17
    assert checked["silver.movies_vectors", "complete", "movie_vector"] == (
        profiles["silver.movies_vectors"].row_count - profiles["gold.movies_vector"].row_count)

    before = {tuple(r) for r in house.lake.read("gold.movies_vector").select(
        "id", F.round(F.col("movie_vector")[0], 9)).collect()}
    house.silver_movies_cleaned(years=[1998])
    house.silver_movies_vectors(years=[1998])
    house.gold_movies_vector(years=[1998])
    after = {tuple(r) for r in house.lake.read("gold.movies_vector").select(
        "id", F.round(F.col("movie_vector")[0], 9)).collect()}
    assert before == after

    assert {r.release_year for r in house.search(years=(1998, 1998)).collect()} == {1998}
    assert house.voting_distribution().count() > 0
    assert house.monthly_release_movies().count() > 0
    assert spark.table("voting_distribution").count() == house.voting_distribution().count()


def test_lakehouse_options(spark, sf_dir, tmp_path):
    i = Inputs(spark, sf_dir)
    house = Lakehouse(
        spark, f"{tmp_path}/lake", ParquetWarehouse(f"{tmp_path}/wh"), last_year=LAST_YEAR,
        fit_by_year=False, shared_space=True, exclude_seen=True, trim_tags=True)
    profiles = {p.table: p.row_count for p in house.run(i.movies_raw, i.genre_track, i.favourites)}
    seen = profiles["silver.favorite_track"]
    assert profiles["gold.recommendations"] == profiles["gold.movies_vector"] - seen
    best = house.lake.read("gold.recommendations").agg(F.max("cosine_similarity")).first()[0]
    assert best > 0.9  # in one space, films like the favourites score near 1
    def vectors():
        return {r["id"]: [round(x, 9) for x in r["movie_vector"]] for r in house.lake.read("gold.movies_vector").collect()}

    before = vectors()
    house.gold_movies_vector(years=[1998])  # an unchanged year changes nothing
    assert vectors() == before


def test_views_outlive_a_session_and_follow_a_reload(spark, sf_dir, tmp_path):
    i = Inputs(spark, sf_dir)
    house = Lakehouse(
        spark, f"{tmp_path}/lake", ParquetWarehouse(f"{tmp_path}/wh"), last_year=LAST_YEAR, dashboards="dash_test")
    house.run(i.movies_raw, i.genre_track, i.favourites)
    other = spark.newSession()
    try:
        for view, frame in (("voting_distribution", house.voting_distribution()), ("monthly_release_movies", house.monthly_release_movies())):
            assert not [t for t in other.catalog.listTables() if t.name == view and t.isTemporary]
            rows = [tuple(r) for r in frame.collect()]
            assert [tuple(r) for r in other.table(f"dash_test.{view}").collect()] == rows and rows
        kept = house.infor_rating().where("release_year = 1996")
        house.lake.write(kept, "marts.infor_rating")
        house.dashboard_views()
        other.catalog.refreshTable("dash_test.infor_rating")
        for session in (other, spark.newSession()):
            assert {r.release_year for r in session.table("dash_test.voting_distribution").collect()} == {1996}
    finally:
        spark.sql("DROP DATABASE dash_test CASCADE")


def test_a_film_that_changes_its_year_is_in_one_place(spark, tmp_path):
    house = Lakehouse(spark, str(tmp_path), ParquetWarehouse("unused"), first_year=1980, last_year=2000)
    movies = some_films(spark).drop("release_year")

    def places():
        return {(r.id, r.release_year) for r in house.lake.read("bronze.movies").collect()}

    house.bronze_movies(movies)
    moved = movies.where("year(release_date) = 1992 OR id = 4").withColumn("release_date", F.lit(dt.date(1992, 3, 1)))
    profile, years = house.bronze_movies_moved(moved, [1992])
    assert (profile.row_count, years) == (11, [1991, 1992])
    assert places() == {(n, 1992 if n == 4 else 1990 + n % 3) for n in range(30)}
    assert {(r.id, r.release_year) for r in house.lake.read("bronze.movie_years").collect()} == places()
    # Every film of a year leaves it; a film without id, and one of a year outside the load, change nothing.
    rest = movies.where("year(release_date) = 1990").withColumn("release_date", F.lit(dt.date(1985, 1, 1)))
    odd = movies.where("id = 1").withColumn("id", F.lit(None).cast("long")).withColumn("release_date", F.lit(dt.date(1985, 1, 1)))
    assert house.bronze_movies_moved(rest.unionAll(odd).unionAll(movies.where("id = 2")), [1985])[1] == [1985, 1990]
    assert house.lake.years("bronze.movies") == [1985, 1991, 1992] == house.lake.years("bronze.movie_years")
    assert {y for n, y in places() if n is not None and n % 3 == 0} == {1985}
    assert len(places()) == 31
    assert house.bronze_movies_moved(movies.where("false"), [1991])[1] == [1991]
    assert len(places()) == 31


def test_published_tables_do_not_go_back_to_the_sources(spark, sf_dir, monkeypatch):
    read = {}

    def recorded(df, table, warehouse):
        read[table] = df.inputFiles()
        return publish(df, table, warehouse)

    from cinelake.sources import publish
    from fixtures import queries

    monkeypatch.setattr(queries, "publish", recorded)
    queries.registered()["warehouse_publish"](spark, sf_dir)
    assert len(read) == 5 and not any("lineitem" in f for files in read.values() for f in files)


def test_favourites_of_a_run_come_from_the_stored_films(spark, sf_dir, monkeypatch):
    read = []

    def recorded(self, favourites):
        read.extend(favourites.inputFiles())
        return write(self, favourites)

    from cinelake.plans.lakehouse import Lakehouse
    from fixtures import queries

    write = Lakehouse.bronze_favorite_movies
    monkeypatch.setattr(Lakehouse, "bronze_favorite_movies", recorded)
    queries.registered()["pipeline_quality"](spark, sf_dir)
    assert read and not any("lineitem" in f for f in read)
