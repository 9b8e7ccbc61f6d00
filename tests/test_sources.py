import datetime as dt
import json
import random
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructType

from cinelake import schemas
from cinelake.plans import marts
from cinelake.sources import declared
from cinelake.sources import (
    JdbcWarehouse, cut_points, cut_points_query, cut_predicates, extract_year, extract_years, jdbc_options, key_range_options, land_pages, read_pages, read_positional_csv,
    from_declared, snapshot, to_declared, year_predicates,
)
from fixtures.adapter import Inputs
from tests.conftest import formatted_plan

PAIR = StructType().add("id", LongType()).add("name", StringType())


def write(path, text):
    path.mkdir(exist_ok=True)
    (path / "part.csv").write_text(text)
    return str(path)


def test_columns_bind_by_position_and_quotes_double(spark, tmp_path):
    path = write(tmp_path / "c", 'genre_id,genre_name\n12,"Ad,v ""x"""\n13,plain\n')
    rows = read_positional_csv(spark, path, PAIR).collect()
    assert [tuple(r) for r in rows] == [(12, 'Ad,v "x"'), (13, "plain")]


def rows_of(df):
    return [tuple(r) for r in df.collect()]


def test_stray_quotes_lose_no_row(spark, tmp_path):
    path = write(tmp_path / "q", 'a,b\n1,"x"\n2,12" disk\n3,c\n4,d\n5,e\n')
    for multi_line in (False, True):
        found = rows_of(read_positional_csv(spark, path, PAIR, multi_line=multi_line))
        assert found == [(1, "x"), (2, '12" disk'), (3, "c"), (4, "d"), (5, "e")]


def test_blank_lines_are_no_records_and_no_header(spark, tmp_path):
    path = write(tmp_path / "l", "\na,b\n1,x\n\n2,y\n")
    for multi_line in (False, True):
        assert rows_of(read_positional_csv(spark, path, PAIR, multi_line=multi_line)) == [(1, "x"), (2, "y")]


def test_line_breaks_in_fields(spark, tmp_path):
    path = write(tmp_path / "b", 'a,b\n1,"two\nlines"\n2,"x ""y"" z"\n')
    assert rows_of(read_positional_csv(spark, path, PAIR, multi_line=True)) == [
        (1, "two\nlines"), (2, 'x "y" z')]
    with pytest.raises(Exception, match="MALFORMED|FAILED_READ"):  # not merged, not dropped
        read_positional_csv(spark, path, PAIR).collect()


def test_records_that_do_not_fit_fail_or_are_kept(spark, tmp_path):
    path = write(tmp_path / "m", "a,b\n1,x\nbad,y\n3,z\n")
    with pytest.raises(Exception, match="MALFORMED|FAILED_READ"):
        read_positional_csv(spark, path, PAIR).collect()
    kept = read_positional_csv(spark, path, PAIR, mode="PERMISSIVE")
    assert rows_of(kept) == [(1, "x"), (None, "y"), (3, "z")]


def test_many_records_of_several_lines(spark, tmp_path):
    rng = random.Random(5)
    words = ["plain", 'quo"te', "com,ma", "line\nbreak", "\n\n", "", "é", '""', "x" * 900 + "\n"]
    rows = [(n % 90, "".join(rng.choices(words, k=rng.randint(0, 6)))) for n in range(400)]
    folder = f"{tmp_path}/many"
    spark.createDataFrame(rows, PAIR).coalesce(1).write.option("header", True).option(
        "escape", '"').option("quoteAll", True).option("ignoreLeadingWhiteSpace", False).option(
        "ignoreTrailingWhiteSpace", False).csv(folder)
    found = rows_of(read_positional_csv(spark, folder, PAIR, multi_line=True))
    first = dict(rows_of(read_positional_csv(spark, folder, PAIR, key="id", multi_line=True)))
    rows = [(i, name or None) for i, name in rows]  # an empty field is null to the CSV reader
    assert Counter(found) == Counter(rows)
    expected = {}
    for i, name in rows:
        expected.setdefault(i, name)
    assert first == expected


def test_a_loaders_escapes_and_nulls(spark, tmp_path):
    path = write(tmp_path / "e", 'a,b\n1,\\N\n2,"say \\"x\\""\n')
    found = read_positional_csv(spark, path, PAIR, escape="\\", null_text="\\N")
    assert rows_of(found) == [(1, None), (2, 'say "x"')]


def test_first_row_of_a_key_wins_and_missing_keys_go(spark, tmp_path):
    path = write(tmp_path / "k", "a,b\n1,first\n2,only\n1,second\n,none\n1,third\n")
    rows = read_positional_csv(spark, path, PAIR, key="id").collect()
    assert sorted(tuple(r) for r in rows) == [(1, "first"), (2, "only")]


def test_first_row_is_the_first_in_the_file_when_it_is_split(spark, tmp_path):
    lines = [f"{n % 50},row{n:05d}" for n in range(5000)]
    path = write(tmp_path / "s", "a,b\n" + "\n".join(lines) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    try:
        df = read_positional_csv(spark, path, PAIR, key="id", multi_line=False)
        assert sorted(tuple(r) for r in df.collect()) == [(n, f"row{n:05d}") for n in range(50)]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_blank_fields(spark, tmp_path):
    path = write(tmp_path / "n", "a,b\n,\n7,x\n")
    assert [tuple(r) for r in read_positional_csv(spark, path, PAIR).collect()] == [
        (None, None), (7, "x")]
    filled = read_positional_csv(spark, path, PAIR, blanks_as_defaults=True)
    assert [tuple(r) for r in filled.collect()] == [(0, ""), (7, "x")]


def test_year_extract_reaches_the_scan(spark, tmp_path):
    days = [(1, dt.date(1998, 12, 31)), (2, dt.date(1999, 1, 1)), (3, dt.date(1999, 12, 31)),
            (4, dt.date(2000, 1, 1)), (5, None)]
    spark.createDataFrame(days, "id int, release_date date").write.parquet(f"{tmp_path}/d")
    df = spark.read.parquet(f"{tmp_path}/d")
    assert {r.id for r in extract_year(df, 1999).collect()} == {2, 3}
    assert {r.id for r in extract_years(df, 1999, 1998).collect()} == {1, 2, 3}
    text = formatted_plan(extract_year(df, 1999))
    assert "GreaterThanOrEqual(release_date,1999-01-01)" in text
    assert "LessThan(release_date,2000-01-01)" in text


def test_partition_domain_starts_in_1920(spark):
    df = spark.createDataFrame(
        [(1, dt.date(1919, 12, 31)), (2, dt.date(1920, 1, 1))], "id int, release_date date")
    assert {r.id for r in extract_years(df, 2020).collect()} == {2}


def matches(conditions):
    """How many conditions a row meets, as a flat expression."""
    return F.size(F.filter(F.array(*map(F.expr, conditions)), lambda met: met))


def test_split_years_cover_every_row_once(spark):
    rows = [(i, dt.date(1999, 1, 1) + dt.timedelta(i)) for i in range(730)]
    df = spark.createDataFrame(rows, "id bigint, release_date date")
    for splits in (1, 3, 500):
        parts = [df.where(p) for p in year_predicates(1999, 2000, splits=splits)]
        counted = df.select(matches(year_predicates(1999, 2000, splits=splits)).alias("n"))
        assert {r.n for r in counted.collect()} == {1} and len(parts) <= 2 * splits


def test_jdbc_settings():
    assert year_predicates(1999, 2000) == [
        "release_date >= '1999-01-01' AND release_date < '2000-01-01'",
        "release_date >= '2000-01-01' AND release_date < '2001-01-01'",
    ]
    split = year_predicates(1999, 2000, splits=3)
    assert len(split) == 6
    assert split[4] == "release_date >= '2000-05-02' AND release_date < '2000-09-01'"
    options = jdbc_options("jdbc:x://host/db", user="u", password="p")
    assert options == {
        "url": "jdbc:x://host/db", "fetchsize": "10000", "user": "u", "password": "p"}
    written = JdbcWarehouse(options).write_options("movies_rating")
    assert written["dbtable"] == "movies.movies_rating"
    assert written["truncate"] == "false" and "numPartitions" not in written
    assert JdbcWarehouse(options, truncate=True).write_options("x")["truncate"] == "true"
    assert key_range_options("id", 1, 100, 4) == {
        "partitionColumn": "id", "lowerBound": "1", "upperBound": "100", "numPartitions": "4"}


PAGE = {
    "page": 1, "total_pages": 1,
    "results": [{
        "adult": False, "backdrop_path": "/x", "genre_ids": [28, 12], "id": 7, "overview": "o",
        "popularity": 1.5, "release_date": "2001-02-03", "title": "t", "vote_average": 6.5,
        "vote_count": 3, "video": False}],
}


def test_pages_keep_nine_fields_of_all_pages_or_of_one(spark, tmp_path):
    (tmp_path / "1.json").write_text(json.dumps(PAGE, indent=2))
    (tmp_path / "2.json").write_text(json.dumps({**PAGE, "page": 2}, indent=2))
    df = read_pages(spark, str(tmp_path), page=1)
    schemas.assert_schema(df, schemas.FAVOURITES)
    assert df.count() == 1
    assert df.first().genre_ids == [28, 12]
    assert read_pages(spark, str(tmp_path)).count() == 2


DAMAGED = {
    "cut": '{"page":2,"results":[{"id":2,', "type": '{"page":3,"results":[{"id":"x7","title":"b"},{"id":8}]}',
    "list": "[1, 2]", "two": '{"page":1,"results":[]}{"page":2,"results":[]}', "tail": '{"page":1,"results":[]} and more',
    "none": '{"page":4}', "null": '{"page":5,"results":null}',
}


@pytest.mark.parametrize("multi_line", [True, False])
def test_no_damaged_page_is_lost(spark, tmp_path, multi_line):
    source = tmp_path / "in"
    source.mkdir()
    good = [json.dumps(PAGE), json.dumps({**PAGE, "page": 2}), '{"page":9,"results":[]}']
    if multi_line:
        bodies = {**DAMAGED, "empty": "", "one": good[0], "more": "\n" + good[1] + "\n", "no-films": good[2]}
        for name, body in bodies.items():
            (source / f"{name}.json").write_text(body)
        (source / "bytes.json").write_bytes(good[0].encode()[:-20] + b'\xff"}]}')
    else:
        (source / "pages.json").write_text("\n".join([*DAMAGED.values(), "", *good]))
    landed = land_pages(spark, str(source), str(tmp_path / "out"), multi_line=multi_line)
    assert (landed.pages, landed.damaged_pages) == (3, len(DAMAGED) + (2 if multi_line else 0))
    assert landed.films.count() == 2
    schemas.assert_schema(landed.films, schemas.FAVOURITES)
    found = Counter((r.body, r.damage) for r in landed.damaged.collect())
    for name, body in DAMAGED.items():
        assert found[body, "has no results" if name in ("none", "null") else "is not the API's JSON"] == 1
    assert all(r.file.endswith(".json") for r in landed.damaged.collect())
    with pytest.raises(Exception, match="response in .*json (is not|has no)"):
        read_pages(spark, str(source), multi_line=multi_line).collect()


def test_repaired_pages_replace_the_stored_ones(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    (source / "a.json").write_text(DAMAGED["cut"])
    assert land_pages(spark, str(source), str(tmp_path / "out")).damaged_pages == 1
    (source / "a.json").write_text(json.dumps(PAGE))
    landed = land_pages(spark, str(source), str(tmp_path / "out"), page=1)
    assert (landed.pages, landed.damaged_pages, landed.films.count(), landed.damaged.count()) == (1, 0, 1, 0)


def test_empty_page_gives_no_films(spark, tmp_path):
    (tmp_path / "1.json").write_text('{"page": 1, "results": []}')
    df = read_pages(spark, str(tmp_path))
    assert df.isEmpty()
    schemas.assert_schema(df, schemas.FAVOURITES)


def test_snapshot_falls_back(spark, tmp_path):
    backup = f"{tmp_path}/backup"
    full = spark.createDataFrame([(1, [2, 3])], "id bigint, genre_ids array<bigint>")
    empty = full.where(F.lit(False))
    assert snapshot(empty, backup).isEmpty()
    assert snapshot(full, backup).first() == (1, [2, 3])
    assert snapshot(empty, backup).first() == (1, [2, 3])
    newer = spark.createDataFrame([(9, [9])], full.schema)
    assert [r.id for r in snapshot(newer, backup).collect()] == [9]


def test_schema_differences_are_named(spark):
    df = spark.createDataFrame([(1, 2)], "id int, extra int")
    with pytest.raises(schemas.SchemaMismatch, match="missing.*name.*unexpected.*extra.*id: int"):
        schemas.assert_schema(df, PAIR)


def test_declared_tables_and_back(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    infor = marts.movies_infor(i.movies_cleaned)
    odd = spark.createDataFrame([(1, None, "", None, None, "nan"), (2, "t", "o", None, 1, None), (3, "t", "o", None, 1, "a, b,")], schemas.MOVIES_INFOR)
    track = i.favorite_track
    for table, df in (("movies_infor", infor.unionAll(odd)), ("movies_genres", marts.movies_genres(i.movies_cleaned)), ("favorite_track", track)):
        mapped = to_declared(df, table)
        assert mapped.schema.simpleString() == declared.DECLARED[table].simpleString()
        back = from_declared(mapped, table)
        schemas.assert_schema(back, schemas.WAREHOUSE[table])
        assert Counter(map(str, back.collect())) == Counter(map(str, df.select(back.columns).collect()))
    assert to_declared(odd, "movies_infor").where("id = 1").first().genres == []
    blank = track.limit(1).withColumn("release_date", F.lit(" "))
    assert to_declared(blank, "favorite_track").first().release_date is None
    for column, value in (("release_date", F.lit("soon")), ("id", F.lit(2 ** 40))):
        with pytest.raises(Exception, match="CAST"):
            to_declared(track.limit(1).withColumn(column, value), "favorite_track").collect()


def test_a_declared_warehouse_maps_both_ways(spark, sf_dir, monkeypatch):
    """The JDBC calls are replaced by a frame that keeps what was written."""
    warehouse = JdbcWarehouse(jdbc_options("jdbc:x://h/d"), truncate=True, declared=True)
    rating = marts.movies_rating(Inputs(spark, sf_dir).movies_cleaned)
    mapped = to_declared(rating, "movies_rating")
    monkeypatch.setattr("cinelake.sources.warehouse.read_table", lambda *_: mapped)
    back = warehouse.load(spark, "movies_rating")
    schemas.assert_schema(back, schemas.MOVIES_RATING)
    assert back.count() == rating.count()
    assert warehouse.write_options("movies_rating")["truncate"] == "true"


@pytest.mark.parametrize("keys", [
    [None, 1, 2, 3], [5] * 90 + list(range(10)), list(range(100)) + [10 ** 9] * 3, [], [None, None], [7]])
def test_split_reads_cover_every_row_once(spark, keys):
    """The statement for the cuts runs in another database; the conditions there and here."""
    database = duckdb.connect()
    database.execute("CREATE TABLE t (k BIGINT, s VARCHAR)")
    if keys:
        database.executemany("INSERT INTO t VALUES (?, ?)", [(k, None if k is None else f"it's {k:09d}") for k in keys])
    df = spark.createDataFrame([(k, None if k is None else f"it's {k:09d}") for k in keys], "k long, s string")
    for key in ("k", "s"):
        for tasks in (1, 2, 4, 200):
            found = [r[0] for r in database.execute(cut_points_query("t", key, tasks)).fetchall()]
            conditions = cut_predicates(key, found[1:])
            assert len(conditions) <= tasks
            counts = [database.execute(f"SELECT COUNT(*) FROM t WHERE {c}").fetchone()[0] for c in conditions]
            assert sum(counts) == len(keys)
            hits = df.select(matches(conditions).alias("n"))
            assert {r.n for r in hits.collect()} <= {1}
            distinct = len(set(keys) - {None})
            if distinct == len(keys) and tasks <= len(keys):
                assert max(counts) <= -(-len(keys) // tasks) + 1
    assert cut_points(df, "k", 1) == []
    assert len(cut_predicates("k", cut_points(df, "k", 4))) <= 4


def test_server_dates_do_not_follow_the_session_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    rows = "SELECT timestamp'2001-02-03 00:00:00 UTC' AS release_date, CAST(1.25 AS DECIMAL(9, 3)) AS popularity, CAST(7 AS DECIMAL(20, 0)) AS id"
    try:
        for zone in ("America/New_York", "Asia/Tokyo", "UTC"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            row = schemas.conform(spark.sql(rows), schemas.MOVIES).first()
            assert (str(row.release_date), row.popularity, row.id) == ("2001-02-03", 1.25, 7)
            local = spark.sql("SELECT timestamp_ntz'2001-02-03 00:00:00' AS release_date")
            assert str(schemas.conform(local, schemas.MOVIES).first().release_date) == "2001-02-03"
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
