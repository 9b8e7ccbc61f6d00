"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` names the data folder, ``BENCH_CPUS`` the number of local cores. Every query is
run to its last row into Spark's no-op sink, once to warm up and then ``BENCH_RUNS`` times; the
median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from cinelake.session import local_session
from fixtures.queries import registered

HEADLINES = (
    "movies_cleaned", "favorite_track", "movie_vectors", "user_vector", "cosine_scores",
    "recommendations_top100", "infor_rating", "voting_distribution", "monthly_release",
    "catalogue_search", "quality_report", "key_dedupe", "csv_positional", "full_load",
    "lakehouse_end_to_end",
)


def run(query, spark, folder: str) -> float:
    start = time.perf_counter()
    query(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    only = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n]
    spark = local_session(cpus)
    available = registered()
    seconds = {}
    for name in only or HEADLINES:
        run(available[name], spark, folder)
        times = [run(available[name], spark, folder) for _ in range(runs)]
        seconds[name] = round(statistics.median(times), 3)
    print(json.dumps({
        "metric": "total_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
