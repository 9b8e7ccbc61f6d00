"""Vectors as exact integers, shared by the operators on embeddings."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinelake.llm.store import BLOCK, summed

#: Components whose integer leaves this range have no place in a long and count as not finite.
RANGE = 1 << 62
#: Bits of the lower half of a number that is summed in two longs.
HALF = 32


def usable(table: DataFrame, factor: int, id: str, vector: str, *others: str) -> DataFrame:
    """``vec_id``, ``v`` (array of double) and the other columns of the rows that take part.

    Left out are null vectors, vectors with a null, NaN, infinite or, times ``factor``, unstorable
    component, and vectors of another length than the most common one, of equally common ones the
    longest. A null id takes part.
    """
    limit = F.lit(RANGE / factor)
    read = table.select(table[id].cast("long").alias("vec_id"), table[vector].cast("array<double>").alias("v"),
                        *(table[c].alias(c) for c in others))
    # A comparison with a null or NaN component holds for no vector: NaN counts as the largest number.
    good = read.where(F.col("v").isNotNull() & F.forall("v", lambda x: F.coalesce(F.abs(x) < limit, F.lit(False))))
    widths = good.groupBy(F.size("v").alias("width")).count()
    common = widths.agg(F.max(F.struct("count", "width")).alias("m")).first().m
    return good.where(F.size("v") == (common.width if common else 0))


def matrix(part: pa.RecordBatch, factor: int) -> np.ndarray:
    """floor(factor * component) of every vector of a batch as longs, exactly."""
    lists = part.column("v")
    values = lists.flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, -1) if part.num_rows else np.empty((0, 0))
    return np.floor(values * factor).astype(np.int64)  # the factor is a power of two, so the product is exact


def roomy(largest: int, terms: int, array: np.ndarray) -> np.ndarray:
    """The array as longs if sums of ``terms`` products of numbers up to ``largest`` fit, else as Python integers."""
    return array if largest * largest * max(terms, 1) < 1 << 62 else array.astype(object)


def magnitude(array: np.ndarray) -> int:
    """Largest absolute value, as a Python integer."""
    return max(abs(int(array.max())), abs(int(array.min()))) if array.size else 0


def halves(values: Iterable[int], width: int) -> Iterator[tuple[int, bytes]]:
    """Blocks for ``totals``: every number as an upper and a lower half, which are added on their own."""
    cells = np.zeros(-(-2 * width // BLOCK) * BLOCK, dtype=np.int64)
    numbers = list(values)
    cells[:width] = [v >> HALF for v in numbers]
    cells[width:2 * width] = [v & ((1 << HALF) - 1) for v in numbers]
    for block, own in enumerate(cells.reshape(-1, BLOCK)):
        if own.any():
            yield block, own.tobytes()


def totals(counted: DataFrame, width: int) -> list[int]:
    """Exact sums of ``width`` numbers over all rows of ``halves``: of fixed size, whatever the data."""
    cells = summed(counted, -(-2 * width // BLOCK) * BLOCK)
    return [(int(a) << HALF) + int(b) for a, b in zip(cells[:width], cells[width:2 * width])]


BLOCKS = pa.schema([("block", pa.int64()), ("cells", pa.binary())])
BLOCKS_DDL = "block long, cells binary"
