"""Product codes of integer vectors, exact to the last bit, with distances by the Walsh-Hadamard transform.

The transform of a part, zero-padded to a power of two, keeps squared distances up to that factor,
and gathers the smooth share of a part in its first places when they are ordered by sequency (sign
changes). Squared differences are summed in that order; an entry goes as soon as its sum exceeds
the whole distance of the entry that led after the first place. Sums only grow, so no nearest entry
is lost and a tie still goes to the lower index. Everything is integer arithmetic.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinelake.llm.store import stored
from cinelake.llm.vectors import BLOCKS, BLOCKS_DDL, halves, magnitude, matrix, roomy, totals, usable

FACTOR = 4096
PARTS = 8
ENTRIES = 16
ROUNDS = 6
#: Vectors whose candidates are looked at together: bounds memory, never results.
ROWS = 16_384
LONGS = (1 << 63) - 1


def sequency(size: int) -> np.ndarray:
    """The places of the natural-order transform by rising sign changes: bit-reversed Gray codes."""
    bits = size.bit_length() - 1
    gray = np.arange(size) ^ (np.arange(size) >> 1)
    out = np.zeros(size, dtype=np.int64)
    for b in range(bits):
        out |= ((gray >> b) & 1) << (bits - 1 - b)
    return out


def transform(parts: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard transform along the last axis, zero-padded to a power of two, in sequency order."""
    width = parts.shape[-1]
    size = 1 << max(width - 1, 0).bit_length()
    out = np.zeros((*parts.shape[:-1], size), dtype=parts.dtype)
    out[..., :width] = parts
    reach = 1
    while reach < size:
        pairs = out.reshape(*parts.shape[:-1], size // (2 * reach), 2, reach)
        a, b = pairs[..., 0, :], pairs[..., 1, :]
        out = np.stack([a + b, a - b], axis=-2).reshape(*parts.shape[:-1], size)
        reach *= 2
    return out[..., sequency(size)]


def nearest(part: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry of every row, the lowest of equals, and its squared distance.

    ``part`` and ``entries`` are transformed.
    """
    size, rows = part.shape[-1], np.arange(len(part))
    if not size:
        return np.zeros(len(part), dtype=np.int64), np.zeros(len(part), dtype=np.int64)
    total = (part[:, :1] - entries[:, 0]) ** 2
    leader = np.argmin(total, axis=1)
    bound = ((part - entries[leader]) ** 2).sum(axis=1)
    row, entry = np.nonzero(total <= bound[:, None])
    total = total[row, entry]
    for place in range(1, size):
        total = total + (part[row, place] - entries[entry, place]) ** 2
        left = total <= bound[row]
        row, entry, total = row[left], entry[left], total[left]
    ends = np.empty((len(part), len(entries)), dtype=part.dtype)
    ends[:] = bound[:, None] + 1
    ends[row, entry] = total
    best = np.argmin(ends, axis=1)
    return best, ends[rows, best] // size


@dataclass(frozen=True)
class Codebooks:
    """``entries[part][index]`` as lists of Python integers."""

    entries: list[list[list[int]]]

    @property
    def sha256(self) -> str:
        return hashlib.sha256(",".join(str(x) for part in self.entries for e in part for x in e).encode()).hexdigest()

    def assign(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of integer vectors, their parts, the index of every part and its squared distance."""
        books = np.array(self.entries, dtype=object)
        parts = _cut(vectors)
        size = 1 << max(parts.shape[-1] - 1, 0).bit_length()
        largest = 2 * size * max(magnitude(parts), magnitude(books))
        parts_ = transform(roomy(largest, size, parts))
        books = transform(books if parts_.dtype == object else books.astype(np.int64))
        found = [nearest(parts_[:, p], books[p]) for p in range(PARTS)]
        return parts, np.stack([f[0] for f in found], axis=1), np.stack([f[1] for f in found], axis=1)

    def moved(self, sums: list[int], counts: list[int]) -> Codebooks:
        """Every entry replaced by the floored mean of its parts; an unused one stays."""
        size, width, sums, counts = len(self.entries[0]), len(self.entries[0][0]), iter(sums), iter(counts)
        out = []
        for part in self.entries:
            out.append([])
            for entry in part:
                own, n = [next(sums) for _ in range(width)], next(counts)
                out[-1].append([s // n for s in own] if n else entry)
        assert len(out) == PARTS and size
        return Codebooks(out)


def _cut(vectors: np.ndarray) -> np.ndarray:
    """Equal consecutive parts; a width that they do not divide is filled up with zeros at the end."""
    width = -(-vectors.shape[1] // PARTS)
    filled = np.zeros((len(vectors), PARTS * width), dtype=np.int64)
    filled[:, :vectors.shape[1]] = vectors
    return filled.reshape(len(vectors), PARTS, width)


def first_codebooks(rows: DataFrame) -> Codebooks | None:
    """The parts of the smallest ids, of equal ids the smallest vectors; rows without id come last."""
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(ENTRIES).collect()
    if not first:
        return None
    values = np.floor(np.array([r.v for r in first], dtype=np.float64).reshape(len(first), -1) * FACTOR).astype(np.int64)
    return Codebooks(_cut(values).transpose(1, 0, 2).tolist())


def _moved(rows: DataFrame, books: Codebooks) -> Codebooks:
    """One round: every part goes to its nearest entry, every entry to the mean of its parts."""
    entries, width = len(books.entries[0]), len(books.entries[0][0])
    held = rows.sparkSession.sparkContext.broadcast(books)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((PARTS, entries, width), dtype=object)
        counts = np.zeros((PARTS, entries), dtype=object)
        for vectors in _blocks(parts):
            cut, codes, _ = held.value.assign(vectors)
            cut = cut if magnitude(cut) * len(cut) < 1 << 62 else cut.astype(object)
            for p in range(PARTS):
                for k in np.unique(codes[:, p]):
                    own = cut[codes[:, p] == k, p]
                    sums[p, k] += own.sum(axis=0).astype(object)
                    counts[p, k] += len(own)
        cells = list(halves([*sums.ravel().tolist(), *counts.ravel().tolist()], sums.size + counts.size))
        yield pa.RecordBatch.from_arrays([pa.array([c[0] for c in cells], pa.int64()), pa.array([c[1] for c in cells], pa.binary())], schema=BLOCKS)

    numbers = PARTS * entries * (width + 1)
    found = totals(rows.select("v").mapInArrow(run, BLOCKS_DDL), numbers)
    return books.moved(found[:PARTS * entries * width], found[PARTS * entries * width:])


def _blocks(parts: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    for part in parts:
        for start in range(0, part.num_rows, ROWS):
            yield matrix(part.slice(start, ROWS), FACTOR)


def train(rows: DataFrame) -> Codebooks | None:
    """Codebooks of all ``rows`` (``usable``) after all rounds; None without rows."""
    books = first_codebooks(rows)
    for _ in range(ROUNDS if books else 0):
        books = _moved(rows, books)
    return books


def encode(rows: DataFrame, books: Codebooks, label: str) -> DataFrame:
    """``vec_id``, the label, ``code`` and ``error`` of every row."""
    kind = rows.schema[label].dataType.simpleString()
    held = rows.sparkSession.sparkContext.broadcast(books)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in parts:
            for start in range(0, whole.num_rows, ROWS):
                part = whole.slice(start, ROWS)
                _, codes, far = held.value.assign(matrix(part, FACTOR))
                text = codes.astype(np.uint8).tobytes().hex()
                texts = [text[i:i + 2 * PARTS] for i in range(0, len(text), 2 * PARTS)]
                errors = [e if e <= LONGS else None for e in map(sum, far.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [part.column("vec_id"), part.column(label), pa.array(texts, pa.string()), pa.array(errors, pa.int64())],
                    names=["vec_id", label, "code", "error"])

    return rows.mapInArrow(run, f"vec_id long, `{label}` {kind}, code string, error long")


def decode(encoded: DataFrame, books: Codebooks, code: str = "code", output: str = "vector") -> DataFrame:
    """``encoded`` with the vector that each code stands for, in the units of the table; null for a null code."""
    width = len(books.entries[0][0])
    table = F.array(*(F.array(*(F.lit([x / FACTOR for x in e]) if e else F.array().cast("array<double>") for e in part))
                      for part in books.entries))
    index = [F.conv(F.substring(code, 2 * p + 1, 2), 16, 10).cast("int") for p in range(PARTS)]
    return encoded.withColumn(output, F.concat(*(table[p][index[p]] for p in range(PARTS))) if width else F.array().cast("array<double>"))


def compress(vectors: DataFrame, id: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """``vec_id``, ``code``, ``error``, ``label_error`` and ``codebooks_sha256`` of every usable row.

    Which rows take part: ``vectors.usable``. A width that eight parts do not divide is filled up
    with zeros; fewer than 16 rows give fewer entries. Rows without id are coded like any, and start
    an entry only where ids are too few. Repeated rows give a row each; an empty table none. Errors
    beyond the range of longs are null, and so is a sum over one. The table is read once per round, so it should be stored.
    """
    rows = usable(vectors, FACTOR, id, vector, label)
    books = train(rows)
    if books is None:
        return rows.select("vec_id", F.lit("").alias("code"), *(F.lit(0).cast("long").alias(c) for c in ("error", "label_error")),
                           F.lit("").alias("codebooks_sha256")).where(F.lit(False))
    coded = stored(encode(rows, books, label).withColumnRenamed(label, "_label"), "codes")
    whole = coded.groupBy(F.col("_label").alias("_of")).agg(
        F.expr("if(count(error) = count(*), try_cast(sum(cast(error as decimal(38, 0))) as bigint), null)").alias("label_error"))
    return coded.join(whole, F.col("_label").eqNullSafe(F.col("_of")), "left").select(
        "vec_id", "code", "error", "label_error", F.lit(books.sha256).alias("codebooks_sha256"))
