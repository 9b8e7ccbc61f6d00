"""Intermediate tables in the shared folder, bounded summaries, and connected components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinelake.session import scratch_folder

#: Numbers in one block of a summary that travels between tasks.
BLOCK = 4096


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """The rows written once to the shared folder and read from there: cuts lineage, survives lost executors.

    The driver then collects its garbage, on which Spark removes the shuffle files of finished
    steps; a job of many steps would hold them all otherwise.
    """
    path = scratch_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    df.sparkSession.sparkContext._jvm.System.gc()
    return df.sparkSession.read.schema(df.schema).parquet(path)


def summed(counted: DataFrame, width: int) -> np.ndarray:
    """Add up rows (block, cells), each the bytes of ``BLOCK`` longs, into one array of ``width`` longs.

    The array has a fixed size whatever the data, so it may reach the driver and be broadcast.
    """
    out = pa.schema([("block", pa.int64()), ("cells", pa.binary())])

    def add(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for part in parts:
            for block, cells in zip(part.column("block").to_pylist(), part.column("cells")):
                values = np.frombuffer(cells.as_buffer(), dtype=np.int64)
                held[block] = held[block] + values if block in held else values.copy()
        if held:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(held)), pa.array([v.tobytes() for v in held.values()], pa.binary())], schema=out)

    total = np.zeros(width, dtype=np.int64)
    for row in counted.repartition("block").mapInArrow(add, "block long, cells binary").collect():
        total[row.block * BLOCK:(row.block + 1) * BLOCK] += np.frombuffer(bytes(row.cells), dtype=np.int64)
    return total


def blocks(cells: np.ndarray) -> Iterator[tuple[int, bytes]]:
    for block, values in enumerate(cells.reshape(-1, BLOCK)):
        if values.any():
            yield block, values.tobytes()


def components(edges: DataFrame) -> DataFrame:
    """``node`` and the smallest node it is connected with, ``label``, for every node of an edge.

    ``edges`` has columns ``a`` and ``b``. Large-star and small-star rounds hang every node below the
    smallest neighbour it knows, until nothing changes; only the smallest neighbour is aggregated, so
    a node with very many neighbours is no large group.
    """
    def tidy(df: DataFrame) -> DataFrame:
        return df.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()

    def digest(df: DataFrame):
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    now = stored(tidy(edges), "edges")
    before = digest(now)
    while before[0]:
        both = now.unionAll(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = tidy(both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")))
        large = stored(large, "edges")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionAll(
            least.select("a", F.col("m").alias("b")))
        now = stored(tidy(small), "edges")
        after = digest(now)
        if after == before:
            break
        before = after
    return now.select(F.col("a").alias("node"), F.col("b").alias("label")).unionAll(
        now.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())
