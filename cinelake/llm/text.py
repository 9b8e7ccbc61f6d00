"""Words, word hashes and Arrow batches, shared by the operators that run Python inside tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: White space between words; ``bytes.split()`` cuts at exactly these six characters.
BLANKS = r"[\x20\x09-\x0D]+"
BLANK_CHARACTERS = " \t\n\x0b\x0c\r"
#: Entries a worker's word cache holds before it starts afresh; bounds memory, never results.
CACHED_WORDS = 400_000
#: Rows and bytes of one Arrow batch that a task returns.
BATCH_ROWS = 4096
BATCH_BYTES = 16 << 20


class WordHashes(dict):
    """64-bit hash of a word, the same in every process."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def words(text: str | None, lower: bool = False) -> list[bytes]:
    """UTF-8 words of a text, with A-Z lower-cased on request."""
    if not text:
        return []
    data = text.encode("utf-8", "surrogatepass")
    return (data.lower() if lower else data).split()


def hashes(tokens: list[bytes], cache: WordHashes) -> np.ndarray:
    return np.fromiter(map(cache.__getitem__, tokens), dtype=np.uint64, count=len(tokens))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def chained(parts: Iterable[np.ndarray], seed: int) -> np.ndarray:
    """One hash per row over columns of numbers."""
    out = np.uint64(seed)
    for values in parts:
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + values)
    return out


def shingles(values: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of ``width`` values; of the whole sequence if it is shorter and not empty."""
    width = min(width, len(values))
    if not width:
        return values
    count = len(values) - width + 1
    with np.errstate(over="ignore"):
        return chained((values[k:k + count] for k in range(width)), width)


def sequence_key(tokens: list[bytes]) -> str:
    """128-bit key of a word sequence: words hold no blank, so the joined text is unambiguous."""
    return xxhash.xxh3_128_hexdigest(b" ".join(tokens))


def word_array(text: Column) -> Column:
    """The words as a native array; none for a null text."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANK_CHARACTERS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, BLANKS))


def batches(rows: Iterable[tuple], schema: pa.Schema, weight: Callable[[tuple], int] = lambda row: 64,
            ) -> Iterator[pa.RecordBatch]:
    """Pack row tuples into Arrow batches of bounded rows and bytes."""
    held: list[tuple] = []
    size = 0
    for row in rows:
        held.append(row)
        size += weight(row)
        if len(held) >= BATCH_ROWS or size >= BATCH_BYTES:
            yield _packed(held, schema)
            held, size = [], 0
    if held:
        yield _packed(held, schema)


def _packed(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(values, type=field.type) for values, field in zip(zip(*rows), schema)], schema=schema)


def table_rows(parts: Iterable[pa.RecordBatch], *columns: str) -> Iterator[tuple]:
    """Row tuples of the named columns, a slice at a time so that Python objects stay few."""
    for part in parts:
        for start in range(0, part.num_rows, 512):
            piece = part.slice(start, 512)
            yield from zip(*(piece.column(c).to_pylist() for c in columns))


def lots(rows: Iterable[tuple], characters: int) -> Iterator[list[tuple]]:
    """Lists of (key, text) rows that hold about so many characters, one row at least."""
    held: list[tuple] = []
    size = 0
    for row in rows:
        held.append(row)
        size += len(row[1] or "")
        if size >= characters:
            yield held
            held, size = [], 0
    if held:
        yield held


def inputs(docs: DataFrame, **columns: str) -> DataFrame:
    """Only the columns an operator reads, under its own names, whatever else the table holds."""
    return docs.select(*(docs[source].alias(name) for name, source in columns.items()))
