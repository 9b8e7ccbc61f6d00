"""SentencePiece encoding by suffix-array matching, and decoding.

The units of a lot of texts are written one after the other and indexed by a suffix array. Every
piece of the vocabulary is found in it by binary search, which gives the range of its occurrences.
The occurrences are the edges of a graph over text positions. Sorted by position and relaxed in
that order, an edge is taken if its piece fits the last piece of the path that ends where it
starts; exactly one path does, and that is the encoding.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinelake.llm import bpe
from cinelake.llm.text import inputs, lots, table_rows

#: Units a worker remembers, and the characters of text it looks at together, one text at least.
CACHED_UNITS = 600_000
LOT_CHARACTERS = 2 << 20
#: Characters matched together, and edges that become Python objects together: bound memory, never results.
WINDOW = 1 << 18
EDGES = 1 << 16


def suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """Positions in the order of their first ``depth`` values; past the end counts as smallest."""
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64) + 1
    reach = 1
    while reach < depth:
        following = np.zeros_like(rank)
        following[:-reach or None] = rank[reach:] if reach < len(rank) else 0
        rank = np.unique(rank * (rank.max() + 1) + following, return_inverse=True)[1].astype(np.int64) + 1
        reach *= 2
    return np.argsort(rank, kind="stable")


class PieceIndex:
    """The pieces as columns of characters, for binary search."""

    def __init__(self, vocabulary: bpe.Pieces):
        names = [p for p in vocabulary.id if vocabulary.events(p) is not None]
        self.names = np.array(names, dtype=object)
        #: The pieces, and one more place for a character that none holds.
        self.names_and_none = np.append(self.names, "")
        self.sizes = np.array([len(p) for p in names])
        self.longest = int(self.sizes.max())
        self.characters = np.zeros((self.longest, len(names)), dtype=np.int64)
        for k, p in enumerate(names):
            self.characters[:len(p), k] = [ord(c) for c in p]
        self.single = np.array(sorted(ord(p) for p in names if len(p) == 1))

    def occurrences(self, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start position and number of the piece, for every place where a piece occurs."""
        order = suffix_array(text, self.longest)
        padded = np.concatenate([text, np.zeros(self.longest, dtype=text.dtype)])
        low = np.zeros(len(self.names), dtype=np.int64)
        high = np.full(len(self.names), len(text), dtype=np.int64)
        for depth in range(self.longest):
            active = np.flatnonzero((self.sizes > depth) & (low < high))
            column = padded[order + depth]
            wanted = self.characters[depth, active]
            ranges = low[active], high[active]
            low[active] = _bisect(column, *ranges, wanted)
            high[active] = _bisect(column, *ranges, wanted + 1)
        count = high - low
        number = np.repeat(np.arange(len(count)), count)
        offset = np.arange(len(number)) - np.repeat(np.cumsum(count) - count, count)
        return order[low[number] + offset], number


def _bisect(column: np.ndarray, low: np.ndarray, high: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """For each range of the column, which is sorted within it, the first place not below ``wanted``."""
    low, high = low.copy(), high.copy()
    last = len(column) - 1
    while (low < high).any():
        middle = (low + high) >> 1
        below = (column[np.minimum(middle, last)] < wanted) & (low < high)
        low = np.where(below, middle + 1, low)
        high = np.where(below, high, np.maximum(middle, low))
    return low


class UnitIds(dict):
    """Ids of whole units, as the bytes of 32-bit numbers."""

    def __init__(self, vocabulary: bpe.Pieces):
        super().__init__()
        self.vocabulary, self.index = vocabulary, PieceIndex(vocabulary)
        self.long: dict[str, bytes] = {}

    def learn(self, units: set[str]) -> None:
        if len(self) >= CACHED_UNITS:
            self.clear()
        self.long = {}
        new = sorted(units.difference(self))
        for unit, ids in zip(new, self._encoded([bpe.marked(u) for u in new]) if new else ()):
            (self if len(unit) <= bpe.CACHED_LENGTH else self.long)[unit] = ids

    def __missing__(self, unit: str) -> bytes:
        return self.long[unit]

    def _encoded(self, units: list[str]) -> Iterator[bytes]:
        # A zero between units keeps pieces from reaching over; it equals no character of a piece.
        joined = "\0".join(units)
        lengths = self._paths(joined)
        ids, to_bytes, end = self.vocabulary.id, self.vocabulary.byte, 0
        for unit in units:
            begin, out = end, []
            end = here = begin + len(unit)
            while here > begin:
                there = here - lengths[here]
                piece = joined[there:here]
                known = ids.get(piece)
                if known is not None:
                    out.append(known)
                else:
                    out.extend(to_bytes[b] for b in reversed(piece.encode("utf-8", "surrogatepass")))
                here = there
            out.reverse()
            yield np.array(out, dtype=np.int32).tobytes()
            end += 1

    def _paths(self, text: str) -> array:
        """For every position, the length of the piece that ends there on the path to it.

        The text is matched and relaxed in windows. A path is carried over by what may follow it at
        the last places, as many as the longest piece, so neither long units nor many of them hold
        more than a window's occurrences.
        """
        fresh, followers = self.vocabulary.followers(""), self.vocabulary.followers
        lengths = array("H", bytes(2 * len(text) + 2))
        carried: list = [fresh]  # what may follow the paths that end at the places before the window and at its start
        for begin in range(0, len(text), WINDOW):
            low = begin + 1 - len(carried)
            after = carried + [None] * min(WINDOW, len(text) - begin)
            for piece, end, size in self._edges(text[low:begin + WINDOW], begin - low):
                if after[end] is None:
                    if not piece:
                        after[end], lengths[low + end] = fresh, size
                    elif after[end - size][piece]:
                        after[end], lengths[low + end] = followers(piece), size
            carried = after[-self.index.longest:]
        return lengths

    def _edges(self, text: str, known: int) -> Iterator[tuple[str, int, int]]:
        """(piece, end, length) of the pieces that end behind the ``known`` first places, the longest first at each end.

        A character that no piece holds is an edge without a piece.
        """
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)
        start, number = self.index.occurrences(codes)
        end = start + self.index.sizes[number]
        own = np.flatnonzero(end > known)
        unknown = np.flatnonzero(~np.isin(codes, self.index.single))
        unknown = unknown[unknown >= known]
        end = np.concatenate([end[own], unknown + 1])
        number = np.concatenate([number[own], np.full(len(unknown), len(self.index.sizes))])
        size = np.append(self.index.sizes, 1)[number]
        order = np.lexsort((-size, end))
        names = self.index.names_and_none
        for first in range(0, len(order), EDGES):
            some = order[first:first + EDGES]
            yield from zip(names[number[some]].tolist(), end[some].tolist(), size[some].tolist())


@cache
def unit_ids(model: str) -> UnitIds:
    """One cache of units per process and model: a task finds what earlier ones have learnt."""
    return UnitIds(bpe.pieces(model))


class Decoder:
    """Text of ids, as the library gives it for valid sequences."""

    def __init__(self, vocabulary: bpe.Pieces):
        self.of = [p.replace(bpe.BLANK, " ").encode() for p in vocabulary.piece]
        for byte, number in vocabulary.byte.items():
            self.of[number] = bytes([byte])
        for number, p in enumerate(vocabulary.piece):
            if p not in vocabulary.id and number not in set(vocabulary.byte.values()):
                self.of[number] = b""

    def __call__(self, ids) -> str | None:
        if ids is None:
            return None
        text = b"".join(map(self.of.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if text[:1] == " " else text


def encode(docs: DataFrame, model: str, id: str = "doc_id", text: str = "text", decoded: bool = False) -> DataFrame:
    """``ids`` (array of int) and ``n_pieces`` of every row's whole text, in one pass without a shuffle.

    ``decoded`` adds the text that the ids decode to, and ``round_trip``: whether it is the text,
    the model's blank mark counting as a blank. A null text counts as empty and gives no ids, and
    its decoded text is empty. Repeated rows and null ids give a row each; an empty table none.
    """
    fields = [("doc_id", pa.int64()), ("n_pieces", pa.int64()), ("ids", pa.list_(pa.int32()))]
    fields += [("text", pa.string()), ("round_trip", pa.bool_())] if decoded else []
    out = pa.schema(fields)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = bpe.pieces(model)
        known, decoder = unit_ids(model), Decoder(vocabulary)
        for lot in lots(table_rows(parts, "id", "text"), LOT_CHARACTERS):
            found = [bpe.units(body) for _, body in lot]
            known.learn(set().union(*found))
            data = [b"".join(map(known.__getitem__, own)) for own in found]
            sizes = np.array([len(d) // 4 for d in data], dtype=np.int64)
            offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            values = np.frombuffer(b"".join(data), dtype=np.int32)
            columns = [pa.array([key for key, _ in lot], pa.int64()), pa.array(sizes),
                       pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))]
            if decoded:
                texts = [decoder(np.frombuffer(d, dtype=np.int32).tolist()) for d in data]
                columns += [pa.array(texts, pa.string()),
                            pa.array([t == (body or "").replace(bpe.BLANK, " ") for t, (_, body) in zip(texts, lot)])]
            yield pa.RecordBatch.from_arrays(columns, schema=out)

    more = ", text string, round_trip boolean" if decoded else ""
    return inputs(docs, id=id, text=text).withColumn("id", F.col("id").cast("long")).mapInArrow(
        run, "doc_id long, n_pieces long, ids array<int>" + more)


def decode(encoded: DataFrame, model: str, id: str = "doc_id", ids: str = "ids") -> DataFrame:
    """The text of every row's ids; null ids give a null text."""
    out = pa.schema([("doc_id", pa.int64()), ("text", pa.string())])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(bpe.pieces(model))
        for part in parts:
            texts = [decoder(row) for row in part.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(texts, pa.string())], schema=out)

    return inputs(encoded, id=id, ids=ids).withColumn("id", F.col("id").cast("long")).mapInArrow(
        run, "doc_id long, text string")
