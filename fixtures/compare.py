"""Side-by-side run of a registered query and its SQL."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    database = duckdb.connect()
    for name in TABLES:
        file = Path(folder) / f"{name}.parquet"
        database.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{file}')")
    return database


def _rows(names: list[str], rows: list[tuple]) -> tuple[list[str], Counter]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    # Adding 0.0 makes a negative zero positive.
    clean = Counter(
        tuple(r[i] + 0.0 if isinstance(r[i], float) else r[i] for i in order) for r in rows)
    return [names[i] for i in order], clean


def differences(df: DataFrame, database: duckdb.DuckDBPyConnection, sql: str) -> str:
    """Empty when both sides return the same columns and the same rows, whatever their order."""
    names, ours = _rows(df.columns, [tuple(r) for r in df.collect()])
    result = database.execute(sql)
    other_names, theirs = _rows([c[0] for c in result.description], result.fetchall())
    if names != other_names:
        return f"columns {names} against {other_names}"
    if ours != theirs:
        missing, extra = theirs - ours, ours - theirs
        return (f"{missing.total()} rows missing such as {list(missing)[:3]}, "
                f"{extra.total()} unexpected such as {list(extra)[:3]}")
    return ""
