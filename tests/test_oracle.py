"""Every registered query against its SQL."""

import duckdb
import pytest

import __spark_entry__ as contract
from fixtures.compare import connect, differences
from fixtures.queries import registered
from tests.conftest import SF_DIR, plan


@pytest.fixture(scope="module")
def database():
    return connect(SF_DIR)


def test_every_query_has_an_oracle():
    assert registered().keys() <= contract.queries().keys()
    assert registered().keys() <= contract.oracle_sql().keys()
    assert contract.oracle_sql().keys() <= contract.queries().keys()


@pytest.mark.parametrize("name", sorted(registered()))
def test_query_equals_sql(spark, database, name):
    df = contract.queries()[name](spark, SF_DIR)
    text = plan(df)
    for unwanted in ("CartesianProduct", "NestedLoopJoin", "EvalPython", "InPandas"):
        assert unwanted not in text
    assert differences(df, database, contract.oracle_sql()[name]) == ""


def test_key_dedupe_takes_the_first_of_equal_lines_in_the_files(spark, database, tmp_path):
    """Orders whose lines are dealt over several files, of which a later one is the largest and is read first."""
    items = "SELECT *, ROW_NUMBER() OVER () AS place FROM lineitem"
    folder = tmp_path / "lineitem.parquet"
    folder.mkdir()
    for n, share in enumerate(("place <= 1000", "place BETWEEN 1001 AND 2500", "place > 2500")):
        database.execute(f"COPY (SELECT * EXCLUDE place FROM ({items}) WHERE {share} ORDER BY place) "
                         f"TO '{folder}/part-{n:04d}.parquet' (FORMAT parquet)")
    df = contract.queries()["key_dedupe"](spark, str(tmp_path))
    # With one thread the SQL engine too keeps tied rows in the order of the files.
    alone = duckdb.connect(config={"threads": 1})
    alone.execute(f"CREATE VIEW lineitem AS SELECT * FROM read_parquet('{folder}/*.parquet')")
    assert differences(df, alone, contract.oracle_sql()["key_dedupe"]) == ""


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == [
        "id", "title", "overview", "release_year", "runtime", "genres", "vote_average"]
    assert df.count() == 100
