"""Approximate nearest neighbours by cosine, on randomly rotated one-bit codes.

Unit vectors are split among clusters fitted on a bounded sample. Of a vector's residual to its
centre only the signs after a random rotation are kept, with two scalars: its length and its inner
product with its own code. They give an estimate of any inner product and a bound of its error.
A vector is reranked on the original values if the upper end of its estimate reaches the k-th
best lower end.

A query is first answered from its own cluster. The k-th best score found there is a floor: another
cluster is skipped only if the angle to its centre and the widest angle inside it leave no room for
a score that reaches the floor. All others are searched.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cinelake.llm.store import stored
from cinelake.llm.text import batches

#: Rows the centres are fitted on at most. Every row is indexed.
SAMPLE = 10_000
#: Vectors per cluster, about, and the most clusters there are.
CLUSTER_ROWS = 1500
CLUSTERS = 4096
#: Share of the clusters, nearest first, that a query may look at. Less than all may miss neighbours.
PROBED = 1.0
#: Radians that rounding may take from the angle between two vectors.
SLACK = 1e-6
#: Below any cosine.
NO_FLOOR = -2.0
#: Vectors of one cluster that a task holds together; larger clusters are cut into so many parts.
PART = 20_000
#: Queries of one cluster that a task holds together, about; more are cut into blocks.
ASKED = 8192
#: Width of the error bound in standard errors.
EPSILON = 3.0
SEED = 11


def valid(vector: Column) -> Column:
    """Not null, nothing null or non-finite inside, not zero."""
    x = F.transform(vector, lambda v: v.cast("double"))
    fine = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return F.coalesce(fine & F.exists(x, lambda v: v != 0), F.lit(False))


def rotation(size: int, seed: int = SEED) -> np.ndarray:
    return np.linalg.qr(np.random.default_rng(seed).normal(size=(size, size)))[0]


def unit(rows: np.ndarray) -> np.ndarray:
    scaled = rows / np.abs(rows).max(axis=1, keepdims=True)  # no overflow in the squares
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def ranged(vectors: np.ndarray) -> np.ndarray:
    """Rows brought by a power of two to where squares neither vanish nor overflow: cosines keep every bit."""
    exponent = np.frexp(np.abs(vectors).max(axis=1, initial=0.0))[1]
    return np.ldexp(vectors, -exponent[:, None])


def centres(sample: np.ndarray, count: int, rounds: int = 8) -> np.ndarray:
    """Spherical k-means of unit vectors."""
    draw = np.random.default_rng(SEED)
    out = sample[draw.choice(len(sample), size=min(count, len(sample)), replace=False)]
    for _ in range(rounds):
        owner = (sample @ out.T).argmax(axis=1)
        sums = np.zeros_like(out)
        np.add.at(sums, owner, sample)
        norm = np.sqrt((sums * sums).sum(axis=1, keepdims=True))
        out = np.where(norm > 1e-9, sums / np.maximum(norm, 1e-9), out)
    return out


def encode(units: np.ndarray, centre: np.ndarray, turned: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed signs, residual length and the residual direction's inner product with its code."""
    rest = units - centre
    length = np.sqrt((rest * rest).sum(axis=1))
    direction = (rest / np.maximum(length, 1e-12)[:, None]) @ turned.T
    own = np.abs(direction).sum(axis=1) / np.sqrt(units.shape[1])
    return np.packbits(direction > 0, axis=1), length, np.maximum(own, 1e-6)


def candidates(codes: np.ndarray, length: np.ndarray, own: np.ndarray, queries: np.ndarray, centre: np.ndarray,
               turned: np.ndarray, k: int, least: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """For each query, which vectors may be among its k nearest ids, by the estimates and their bounds.

    Vectors that cannot reach the query's score in ``least`` are not. ``firsts`` are the places where
    another id begins; an id counts once, by the best of its lower ends.
    """
    size = queries.shape[1]
    signs = (np.unpackbits(codes, axis=1, count=size).astype(np.float32) * 2 - 1) / np.float32(np.sqrt(size))
    guess = (queries @ turned.T).astype(np.float32) @ signs.T / own
    guess = (queries @ centre)[:, None] + guess * length
    error = length * EPSILON * np.sqrt(np.maximum(1 - own * own, 0)) / own / np.sqrt(max(size - 1, 1)) + 1e-6
    floor = least[:, None]
    if len(firsts) > k:
        lower = guess - error
        if len(firsts) < guess.shape[1]:
            lower = np.maximum.reduceat(lower, firsts, axis=1)
        floor = np.maximum(floor, -np.partition(-lower, k - 1, axis=1)[:, k - 1:k])
    return guess + error >= floor


def dealt(data: DataFrame, queries: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both sides with ``part`` and ``block``: every row meets every query of its cluster in one group.

    A cluster's rows are cut into parts and its queries into blocks, by hashes of the whole row, so
    that both sides of a group have a known size. Rows come once per block, queries once per part.
    There are at most ``CLUSTERS`` clusters of a size, so their numbers may be broadcast.
    """
    def counted(df: DataFrame, most: int) -> dict[tuple[int, int], int]:
        return {(r.size, r.cluster): -(-r["count"] // most) for r in df.groupBy("size", "cluster").count().collect()}

    parts, blocks = counted(data, PART), counted(queries, ASKED)
    groups = data.sparkSession.createDataFrame(
        [(*key, parts[key], n) for key, n in blocks.items() if key in parts], "size int, cluster int, parts int, blocks int")
    places = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    place = lambda n: F.pmod(F.xxhash64("id", "v"), F.col(n)).cast("int")
    left, right = (df.join(F.broadcast(groups), ["size", "cluster"]) for df in (data, queries))
    return (left.withColumn("part", place("parts")).withColumn("block", places("blocks")).drop("parts", "blocks"),
            right.withColumn("block", place("blocks")).withColumn("part", places("parts")).drop("parts", "blocks"))


def nearest(vectors: DataFrame, every: int, k: int = 5, id: str = "vec_id", vector: str = "embedding",
            probed: float = PROBED) -> DataFrame:
    """``query_id``, ``rank`` from 1, ``vec_id`` and ``score``: the k nearest ids per query.

    The queries are the rows whose id is divisible by ``every``.

    Vectors that are null, zero or hold something null or non-finite, and rows without id, take no
    part. Vectors are compared with those of their size. Ties go to the smaller id. Rows that share
    an id with the query count as the query itself. Repeated rows count once. An id with several
    vectors is one neighbour, by the best score of any of them with any of the query's. Of equal vectors only the k + 1 smallest ids can
    be among anyone's k nearest; the others are left out before anything is compared.
    """
    rows = vectors.select(vectors[id].cast("long").alias("id"), vectors[vector].cast("array<double>").alias("v")).where(
        F.col("id").isNotNull() & valid(F.col("v"))).withColumn("size", F.size("v"))
    rows = rows.dropDuplicates(["id", "v"])
    asked = rows.where(F.col("id") % every == 0)
    place = Window.partitionBy("v").orderBy("id")
    kept = rows.withColumn("copy", F.row_number().over(place)).where(F.col("copy") <= k + 1).drop("copy")
    kept = stored(kept, "vectors")
    sizes = {r.size: r["count"] for r in kept.groupBy("size").count().collect()}
    sample: dict[int, list] = {}
    for r in kept.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).collect():
        sample.setdefault(r.size, []).append(r.v)
    middle = {size: centres(unit(np.array(v)), max(1, min(CLUSTERS, sizes[size] // CLUSTER_ROWS))) for size, v in sample.items()}
    shared = kept.sparkSession.sparkContext.broadcast(middle)

    def homes(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = pa.schema([("size", pa.int32()), ("cluster", pa.int32()), ("angle", pa.float64()), ("id", pa.int64()), ("v", pa.list_(pa.float64()))])

        def found():
            for part in parts:
                for key, v in zip(part.column("id").to_pylist(), part.column("v").to_pylist()):
                    centre = shared.value.get(len(v))
                    near = centre @ unit(np.array([v]))[0] if centre is not None else np.zeros(1)
                    home = int(near.argmax())
                    yield len(v), home, float(np.arccos(np.clip(near[home], -1, 1))), key, v

        return batches(found(), out, lambda row: 64 + 8 * len(row[4]))

    homed = "size int, cluster int, angle double, id long, v array<double>"
    data = stored(kept.select("id", "v").mapInArrow(homes, homed), "homes")
    queries = stored(asked.select("id", "v").mapInArrow(homes, homed), "queries")
    radius = {size: np.full(len(c), np.nan) for size, c in middle.items()}
    for r in data.groupBy("size", "cluster").agg(F.max("angle").alias("angle")).collect():
        if r.size in radius:
            radius[r.size][r.cluster] = r.angle + SLACK
    data = data.select("size", "cluster", "id", "v")
    reach = kept.sparkSession.sparkContext.broadcast(radius)

    def others(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each query once per cluster besides its own that may hold a score of its floor or more."""
        out = pa.schema([("size", pa.int32()), ("cluster", pa.int32()), ("id", pa.int64()), ("v", pa.list_(pa.float64())), ("floor", pa.float64())])

        def found():
            for part in parts:
                for home, key, v, floor in zip(*(part.column(c).to_pylist() for c in ("cluster", "id", "v", "floor"))):
                    centre = shared.value.get(len(v))
                    if centre is None:
                        continue
                    near = centre @ unit(np.array([v]))[0]
                    room = np.maximum(np.arccos(np.clip(near, -1, 1)) - reach.value[len(v)], 0)
                    for c in np.argsort(-near, kind="stable")[:int(np.ceil(probed * len(centre)))].tolist():
                        if c != home and np.cos(room[c]) >= floor:
                            yield len(v), c, key, v, floor

        return batches(found(), out, lambda row: 64 + 8 * len(row[3]))

    def search(key, left: pa.Table, right: pa.Table) -> pa.Table:
        out = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])
        if not left.num_rows or not right.num_rows:
            return out.empty_table()
        ids, own = (t.column("id").to_numpy() for t in (left, right))
        held, asking = (pc.list_flatten(t.column("v")).to_numpy().reshape(t.num_rows, -1) for t in (left, right))
        order = np.argsort(ids, kind="stable")
        ids, held = ids[order], held[order]
        firsts = np.flatnonzero(np.concatenate(([True], ids[1:] != ids[:-1])))
        centre = shared.value.get(held.shape[1])
        centre = centre[key[1].as_py()] if centre is not None else np.zeros(held.shape[1])
        turned = rotation(held.shape[1])
        codes, length, inner = encode(unit(held), centre, turned)
        floors = right.column("floor").to_numpy()
        held, asking = ranged(held), ranged(asking)
        norm_held, norm_asking = np.sqrt((held * held).sum(axis=1)), np.sqrt((asking * asking).sum(axis=1))
        found = []
        for low in range(0, len(own), 256):
            block = slice(low, low + 256)
            # One more than k, since the query itself may be among them.
            mask = candidates(codes, length, inner, unit(asking[block]), centre, turned, k + 1, floors[block], firsts)
            for q, chosen in zip(range(low, low + len(mask)), mask):
                at = np.flatnonzero(chosen)
                at = at[ids[at] != own[q]]
                score = (held[at] * asking[q]).sum(axis=1) / (norm_held[at] * norm_asking[q])
                best = np.lexsort((ids[at], -score))
                if len(firsts) < len(ids):  # the best row of each id
                    best = best[np.sort(np.unique(ids[at[best]], return_index=True)[1])]
                for j in best[:k]:
                    found.append((int(own[q]), int(ids[at[j]]), float(score[j])))
        return pa.Table.from_batches(batches(found, out), out)

    def searched(asking: DataFrame) -> DataFrame:
        left, right = (df.groupBy("size", "cluster", "part", "block") for df in dealt(data, asking))
        return left.cogroup(right).applyInArrow(
            search, "query_id long, vec_id long, score double")

    def ranked(found: DataFrame) -> DataFrame:
        best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
        by_id = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
        return by_id.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)

    own = stored(searched(queries.select("size", "cluster", "id", "v", F.lit(NO_FLOOR).alias("floor"))), "own")
    floors = ranked(own).where(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("score").alias("floor"))
    left = queries.join(floors, "id", "left").select(
        "cluster", "id", "v", F.coalesce(F.nanvl("floor", F.lit(NO_FLOOR)), F.lit(NO_FLOOR)).alias("floor"))
    more = searched(left.mapInArrow(others, "size int, cluster int, id long, v array<double>, floor double"))
    return ranked(own.unionAll(more)).select("query_id", "rank", "vec_id", "score")
