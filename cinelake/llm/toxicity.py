"""Toxicity by a factorization machine over hashed terms.

A document is the set of its terms, each hashed into one of ``BUCKETS``. The machine adds a weight
per term and the inner product of the factors of every pair of terms, so that a pair such as an
insult and the mention of a group counts beyond its parts.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinelake.llm.text import CACHED_WORDS, batches, inputs, table_rows, words

BUCKETS = 1 << 20
#: Labelled rows the machine is fitted on at most, chosen by a hash of their id.
TRAINING_ROWS = 12_000
#: Terms kept by the fit for what they say alone: those whose rate differs most between the two labels.
KEPT_TERMS = 1024
#: Terms whose pairs are looked at besides: the most frequent of the sample that so many rows have, and the standard
#: errors by which the labels must differ on a pair: far more than chance gives, since copies in the sample repeat pairs.
PAIR_TERMS = 2048
LEAST_ROWS = 30
PAIR_Z = 16.0
FACTORS = 8
EPOCHS = 60
#: Share of rows, by the checksum of their id, that no fit ever sees: one in five.
FOLDS = 5
EDGES = b".,;:!?\"'()[]{}<>*$%&#|-_"


class Terms(dict):
    """Bucket of a lower-cased word without punctuation at its ends."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        value = self[word] = zlib.crc32(word.strip(EDGES)) % BUCKETS
        return value


def terms(text: str | None, cache: Terms) -> np.ndarray:
    """The distinct buckets of a text, sorted."""
    found = set(map(cache.__getitem__, words(text, lower=True)))
    out = np.fromiter(found, dtype=np.int32, count=len(found))
    out.sort()
    return out


@dataclass(frozen=True)
class Machine:
    """``kept`` buckets, sorted, with their weights and factors."""

    bias: float
    kept: np.ndarray
    weight: np.ndarray
    factor: np.ndarray

    def score(self, found: np.ndarray) -> float:
        at = np.searchsorted(self.kept, found)
        at = at[(at < len(self.kept)) & (self.kept[np.minimum(at, len(self.kept) - 1)] == found)] if len(self.kept) else at[:0]
        total = self.bias + float(self.weight[at].sum())
        rows = self.factor[at]
        total += 0.5 * float((rows.sum(axis=0) ** 2 - (rows ** 2).sum(axis=0)).sum())
        return 1.0 / (1.0 + float(np.exp(-np.clip(total, -30, 30))))


def paired(rows: list[np.ndarray], positive: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Terms that some other term changes the meaning of, whatever they say alone.

    For every pair of the ``PAIR_TERMS`` most frequent terms, how much more often than by chance
    the two meet is compared between the labels; a term is kept if that differs with any partner by
    ``PAIR_Z`` standard errors.
    """
    common = np.argsort(-counts, kind="stable")[:PAIR_TERMS]
    common = np.sort(common[counts[common] >= LEAST_ROWS])
    size = len(common)
    if size < 2:
        return common[:0]
    together = np.zeros((2, size, size), dtype=np.float32)
    alone = np.zeros((2, size))
    for first in range(0, len(rows), 1024):  # bounds the matrix held at a time
        some, labels = rows[first:first + 1024], positive[first:first + 1024]
        x = np.zeros((len(some), size), dtype=np.float32)
        for k, r in enumerate(some):
            x[k, np.flatnonzero(np.isin(common, r, assume_unique=True))] = 1
        for y in (0, 1):
            own = x[labels == y]
            together[y] += own.T @ own
            alone[y] += own.sum(axis=0)
    n = np.array([len(rows) - positive.sum(), positive.sum()], dtype=float)
    differ, error = np.zeros((size, size)), np.zeros((size, size))
    for y, sign in ((0, -1), (1, 1)):
        rate = alone[y] / n[y]
        chance = np.outer(rate, rate)
        differ += sign * (together[y] / n[y] - chance)
        error += chance * np.outer(1 - rate, 1 - rate) / n[y]
    pooled = (alone.sum(axis=0) + 1) / (n.sum() + 2)
    floor = np.outer(pooled, pooled) * np.outer(1 - pooled, 1 - pooled) * (1 / n).sum()
    z = np.abs(differ) / np.sqrt(np.maximum(error, floor))
    np.fill_diagonal(z, 0)
    return common[z.max(axis=1) > PAIR_Z]


def fit(rows: list[np.ndarray], labels: np.ndarray, seed: int = 7) -> Machine:
    """Fit on term sets and 0/1 labels: logistic loss, classes weighted alike, adaptive steps."""
    positive = labels == 1
    n, n1 = len(labels), int(positive.sum())
    empty = np.array([], dtype=np.int32)
    if n1 in (0, n):
        rate = (n1 + 0.5) / (n + 1.0)
        return Machine(float(np.log(rate / (1 - rate))), empty, np.zeros(0), np.zeros((0, FACTORS)))
    every = np.concatenate(rows)
    ones = np.bincount(np.concatenate([r for r, y in zip(rows, positive) if y]), minlength=BUCKETS)
    both = np.bincount(every, minlength=BUCKETS)
    p1, p0 = ones / n1, (both - ones) / (n - n1)
    pooled = both / n
    z = np.abs(p1 - p0) / np.sqrt(pooled * (1 - pooled) * (1 / n1 + 1 / (n - n1)) + 1e-12)
    z[both < 3] = 0
    kept = np.argsort(-z, kind="stable")[:KEPT_TERMS]
    kept = np.union1d(kept[z[kept] > 2.0], paired(rows, positive, both)).astype(np.int32)
    matrix = np.zeros((n, len(kept)))
    for k, r in enumerate(rows):
        matrix[k, np.flatnonzero(np.isin(kept, r, assume_unique=True))] = 1
    draw = np.random.default_rng(seed)
    weight, factor = np.zeros(len(kept)), draw.normal(0, 0.01, (len(kept), FACTORS))
    bias, share = 0.0, np.where(positive, 0.5 / n1, 0.5 / (n - n1)) * n
    sums = [np.full_like(x, 1e-8) for x in (np.zeros(1), weight, factor)]
    for _ in range(EPOCHS):
        order = draw.permutation(n)
        for chunk in np.array_split(order, max(1, n // 512)):
            x = matrix[chunk]
            mixed = x @ factor
            total = bias + x @ weight + 0.5 * ((mixed ** 2) - x @ (factor ** 2)).sum(axis=1)
            error = share[chunk] * (1 / (1 + np.exp(-np.clip(total, -30, 30))) - positive[chunk]) / len(chunk)
            g_weight = x.T @ error + 1e-4 * weight
            g_factor = x.T @ (error[:, None] * mixed) - factor * (x.T @ error)[:, None] + 1e-3 * factor
            g_bias = np.array([error.sum()])
            for held, g in zip(sums, (g_bias, g_weight, g_factor)):
                held += g * g
            bias -= 0.2 * g_bias[0] / np.sqrt(sums[0][0])
            weight -= 0.2 * g_weight / np.sqrt(sums[1])
            factor -= 0.05 * g_factor / np.sqrt(sums[2])
    # Classes weighted alike put one half where both are equally likely.
    return Machine(float(bias), kept, weight, factor)


def held_out(id):
    """True for the rows no fit sees."""
    return F.crc32(id.cast("string").cast("binary")) % FOLDS == 0


def train(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "toxic",
          training_rows: int = TRAINING_ROWS) -> Machine:
    """Fit on at most ``training_rows`` labelled rows outside the held-out fold.

    The rows are those with the smallest hash of their id; their number bounds the side that is
    broadcast and the term sets that reach the driver. Of rows that share an id, the one whose text
    has the least hash is fitted on, and toxic wins over not. Rows without id or label are passed
    over; without any, every text scores one half.
    """
    known = labels.where(F.col(label).isin(0, 1) & F.col(id).isNotNull() & ~held_out(F.col(id))).select(
        F.col(id).cast("long").alias("id"), F.col(label).cast("int").alias("label"))
    chosen = known.groupBy("id").agg(F.max("label").alias("label")).orderBy(F.xxhash64("id"), "id").limit(training_rows)
    wanted = inputs(docs, id=id, text=text).join(F.broadcast(chosen), "id").groupBy("id", "label").agg(
        F.min_by("text", F.xxhash64("text")).alias("text"))
    out = pa.schema([("id", pa.int64()), ("label", pa.int32()), ("terms", pa.binary())])

    def collect(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = Terms()
        rows = ((k, y, terms(body, cache).tobytes()) for k, y, body in table_rows(parts, "id", "label", "text"))
        return batches(rows, out, lambda row: len(row[2]))

    found = sorted((r.id, r.label, bytes(r.terms)) for r in wanted.mapInArrow(
        collect, "id long, label int, terms binary").collect())
    return fit([np.frombuffer(t, dtype=np.int32) for _, _, t in found], np.array([y for _, y, _ in found]))


def score(docs: DataFrame, machine: Machine, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Score in [0, 1] and prediction for every row's whole text; nothing is shuffled.

    A null or empty text has no terms and scores by the bias alone. A null id is not held out.
    Repeated rows give a row each; an empty table gives none.
    """
    out = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64()), ("predicted", pa.int32())])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = Terms()

        def rows():
            for key, out_of_fit, body in table_rows(parts, "id", "held", "text"):
                value = machine.score(terms(body, cache))
                yield key, bool(out_of_fit), value, int(value >= 0.5)

        return batches(rows(), out)

    read = inputs(docs, id=id, text=text).select(
        F.col("id").cast("long").alias("id"), held_out(F.col("id")).alias("held"), "text")
    return read.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")
