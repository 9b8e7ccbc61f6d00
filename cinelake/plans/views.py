"""Dashboard views that outlive a session: catalogue views over catalogue tables.

A table of the catalogue names the version of a dataset that is current. A reload moves that name in
one step; the views are defined once and follow. Spark remembers the place of a table per session, so
one that lives on over a reload calls ``spark.catalog.refreshTable``; new ones see it at once.
"""

from __future__ import annotations

from cinelake import constants as K
from cinelake.schemas import DATASETS
from cinelake.sources import Lake

#: Dataset behind each catalogue table.
TABLES = {"infor_rating": "marts.infor_rating", "movies_infor": "gold.movies_infor"}


def _statements(database: str) -> dict[str, str]:
    """The views, as the text their definition keeps."""
    low, high = K.RATING_FLOOR_RANGE
    floor = "CAST(FLOOR(vote_average) AS INT)"
    label = f"CASE WHEN {floor} BETWEEN {low} AND {high} THEN CONCAT({floor}, '-', {floor} + 1) ELSE '{K.UNKNOWN_RATING}' END"
    return {
        "voting_distribution": f"""SELECT release_year, {label} AS rating_bin_label, COUNT(*) AS movie_count
            FROM {database}.infor_rating WHERE vote_average IS NOT NULL
            GROUP BY 1, 2 ORDER BY rating_bin_label, release_year""",
        "monthly_release_movies": f"""SELECT DATE_FORMAT(release_date, 'yyyy-MM') AS release_month, COUNT(*) AS movie_count
            FROM {database}.movies_infor WHERE release_date IS NOT NULL GROUP BY 1 ORDER BY release_month""",
    }


def publish_views(lake: Lake, database: str) -> None:
    """Point the catalogue's tables to the current versions and define the views if they are missing."""
    spark = lake.spark
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for table, dataset in TABLES.items():
        name, place = f"{database}.{table}", lake.location(dataset).replace("'", "\\'")
        if spark.catalog.tableExists(name):
            spark.sql(f"ALTER TABLE {name} SET LOCATION '{place}'")
            spark.catalog.refreshTable(name)
        else:
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in DATASETS[dataset].stored_schema)
            spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet LOCATION '{place}'")
    for view, statement in _statements(database).items():
        spark.sql(f"CREATE VIEW IF NOT EXISTS {database}.{view} AS {statement}")
