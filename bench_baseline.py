"""A job per release year and a row-at-a-time Python cosine against the one-job operators.

Both sides read the same stored silver tables and write the same gold tables. Settings as in
``bench.py``; prints one JSON line.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from cinelake.plans.lakehouse import Lakehouse
from cinelake.session import local_session, scratch_folder
from cinelake.sources import ParquetWarehouse
from fixtures.adapter import LAST_YEAR, Inputs
from tests.numpy_oracle import vectors_of


def fit_each_year(house: Lakehouse, target: str) -> None:
    films = house.lake.read("silver.movies_vectors").where(
        "vote_average IS NOT NULL AND popularity IS NOT NULL AND vote_count IS NOT NULL")
    years = sorted(r[0] for r in films.select("release_year").distinct().collect())
    for year in years:
        one = films.where(F.col("release_year") == year)
        rows = [(i, v.tolist()) for i, v in vectors_of(one).items()]
        house.spark.createDataFrame(rows, "id bigint, vector array<double>").write.mode(
            "overwrite").parquet(f"{target}/{year}")


def score_in_python(house: Lakehouse, vectors: str, target: str) -> None:
    user = house.lake.read("gold.my_vector").first()[0]
    length = sum(x * x for x in user) ** 0.5

    @F.udf(FloatType())
    def cosine(vector):
        own = sum(x * x for x in vector) ** 0.5
        return sum(x * y for x, y in zip(vector, user)) / (own * length) if own and length else 0.0

    films = house.spark.read.parquet(f"{vectors}/*")
    films.select("id", cosine("vector").alias("s")).write.mode("overwrite").parquet(target)


def seconds(action) -> float:
    start = time.perf_counter()
    action()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    root = scratch_folder(spark, "baseline")
    inputs = Inputs(spark, folder)
    house = Lakehouse(
        spark, f"{root}/lake", ParquetWarehouse(f"{root}/warehouse"), last_year=LAST_YEAR)
    house.run(inputs.movies_raw, inputs.genre_track, inputs.favourites)
    runs = {}
    for _ in range(2):  # the second round counts; the order changes nothing when all is warm
        runs = {
            "vectors_per_year_numpy": seconds(lambda: fit_each_year(house, f"{root}/per-year")),
            "vectors_one_job": seconds(house.gold_movies_vector),
            "scores_python_udf": seconds(
                lambda: score_in_python(house, f"{root}/per-year", f"{root}/scores")),
            "scores_native": seconds(house.gold_recommendations),
        }
    print(json.dumps({"metric": "seconds", "unit": "sec", "queries": runs,
                      "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
