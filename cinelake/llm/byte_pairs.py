"""Byte-level byte-pair encoding by a shuffle of distinct words, and decoding by the token table.

A task cuts its texts into words and groups them in lots. A lot keeps its texts as numbers of its
own words, and posts each of its words once with its number there: that is every pre-token with
all its positions, combined before the shuffle. One exchange brings equal words of all lots
together, where a word is encoded once for all of them. Its ids travel back to the lots that asked,
and take the place of the numbers there. A word is one row per lot at most, so the most frequent
word is no larger a key than any word that every lot holds.
"""

from __future__ import annotations

import base64
import heapq
import re
from collections.abc import Iterator
from functools import cache
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinelake.llm.text import inputs, table_rows

#: A lot ends with the text that brings it to so many distinct words, or words in all.
LOT_DISTINCT = 500_000
LOT_WORDS = 6_000_000
#: Words looked at together while a text is cut, and ids of one Arrow batch: bound memory, never results.
SLICE = 1 << 20
#: Longer words are merged with a heap, shorter ones by looking for the least pair each time.
SHORT = 128
#: The most frequent words of a lot take one byte each, the others three.
FREQUENT = 200
#: Letters and numbers of Unicode that the reference library's tables do not know yet, as ranges. To its
#: pattern they are neither.
LATE = """
558 58B-58C 88F C5C CDC 208F 209D-209F A7CE-A7CF A7D2 A7D4 A7DD A7E2 A7F1 AB6C-AB6D 107BB-107BF 10940-10959 10EC5-10EC7
10ED9-10EEE 11B0A 11DB0-11DDB 11DE0-11DE9 11DF1 1246F 12475-1247F 12550-12686 16EA0-16EB8 16EBB-16ED3 16FF2-16FF6
187F8-187FF 18CD6-18CDA 18D09-18D20 18D80-18DF2 18E00-19191 191A0-191D2 1B123-1B128 1B168 1D6A6 1DF1F-1DF24 1DF2B-1DF81
1DF90-1DF96 1DFCD-1DFFF 1E6C0-1E6DE 1E6E0-1E6E2 1E6E4-1E6E5 1E6E7-1E6ED 1E6F0-1E6F4 1E6FE-1E6FF 2B73A-2B73F 2B81E
2CEA2-2CEAD 323B0-33479 3D000-3FC3F
"""
LATE = re.compile("[" + "".join("-".join(chr(int(c, 16)) for c in r.split("-")) for r in LATE.split()) + "]")
#: A character that is no letter, number or space in any table.
NEITHER = "\ufdd0"
#: A place is the number of a lot and that of a word in it; the lot's texts have the number that no word has.
NUMBER_BITS = 22
TEXTS = (1 << NUMBER_BITS) - 1
#: A lot's number: its task, its turn there, and a check of its content.
TURN_BITS, CHECK_BITS = 10, 12
PLACED = pa.schema([("place", pa.int64()), ("data", pa.binary())])


class Ranks:
    """The merge ranks of a tiktoken file, and the encoding of one word."""

    def __init__(self, path: str):
        with open(path, "rb") as file:
            self.of = {base64.b64decode(a): int(b) for a, b in map(bytes.split, filter(bytes.strip, file))}
        if any(bytes([b]) not in self.of for b in range(256)):
            raise ValueError("every byte needs a rank")
        #: The smallest type that holds every id, for ids that travel.
        self.kind = "<u2" if max(self.of.values()) < 1 << 16 else "<i4"

    def encode(self, word: bytes) -> list[int]:
        """Ids of a word: the neighbours whose union has the least rank merge first, the leftmost among equals."""
        whole = self.of.get(word)
        if whole is not None:
            return [whole]
        return self._scanned(word) if len(word) <= SHORT else self._heaped(word)

    def _scanned(self, word: bytes) -> list[int]:
        rank, never = self.of.get, len(self.of) << 32
        at = list(range(len(word) + 1))
        pairs = [rank(word[k:k + 2], never) for k in range(len(word) - 1)]
        while pairs:
            least = min(pairs)
            if least == never:
                break
            k = pairs.index(least)
            del at[k + 1], pairs[k]
            if k < len(pairs):
                pairs[k] = rank(word[at[k]:at[k + 2]], never)
            if k:
                pairs[k - 1] = rank(word[at[k - 1]:at[k + 1]], never)
        return [self.of[word[a:b]] for a, b in zip(at, at[1:])]

    def _heaped(self, word: bytes) -> list[int]:
        size, rank = len(word), self.of.get
        following = np.arange(1, size + 2).tolist()
        before = np.arange(-1, size).tolist()
        #: Rank of the pair that starts here, -1 for none; an entry of the heap that differs is out of date.
        now = [rank(word[k:k + 2], -1) for k in range(size)]
        now[-1] = -1
        heap = [(r << 40) | k for k, r in enumerate(now) if r >= 0]
        heapq.heapify(heap)

        def judge(k: int) -> None:
            middle = following[k]
            r = rank(word[k:following[middle]], -1) if middle < size else -1
            now[k] = r
            if r >= 0:
                heapq.heappush(heap, (r << 40) | k)

        while heap:
            entry = heapq.heappop(heap)
            k = entry & ((1 << 40) - 1)
            if now[k] != entry >> 40:
                continue
            gone = following[k]
            now[gone] = -1
            following[k] = following[gone]
            if following[k] < size:
                before[following[k]] = k
            judge(k)
            if before[k] >= 0:
                judge(before[k])
        out, k = [], 0
        while k < size:
            out.append(self.of[word[k:following[k]]])
            k = following[k]
        return out


@cache
def ranks(path: str) -> Ranks:
    """One table per process and file."""
    return Ranks(path)


class _Numbers(dict):
    """Numbers words in the order they come."""

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self)
        return number


def _pack(ids: pa.Array, sizes: np.ndarray, numbers: np.ndarray) -> bytes:
    """The texts of a lot, compressed: ids, words per text, and the word numbers, each byte of them on its own.

    A number takes one byte if it is frequent and three if not.
    """
    known = ids.is_valid().to_numpy(zero_copy_only=False)
    common = numbers < FREQUENT
    rest = (numbers[~common] - FREQUENT).astype("<u4").view(np.uint8).reshape(-1, 4)
    first = np.where(common, numbers, FREQUENT).astype(np.uint8)
    first[~common] += rest[:, 2]
    head = np.array([len(ids), len(numbers)], dtype=np.int64)
    return zstandard.ZstdCompressor(level=3).compress(b"".join(a.tobytes() for a in (
        head, ids.fill_null(0).to_numpy(), sizes, known, first, rest[:, 1], rest[:, 0])))


def _unpack(packed: bytes) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    data = zstandard.ZstdDecompressor().decompress(packed)
    docs, count = np.frombuffer(data, dtype=np.int64, count=2).tolist()
    ids, sizes = np.frombuffer(data, dtype=np.int64, count=2 * docs, offset=16).reshape(2, docs)
    cells = np.frombuffer(data, dtype=np.uint8, offset=16 + 16 * docs)
    known, cells = cells[:docs].astype(bool), cells[docs:]
    numbers = cells[:count].astype(np.int32)
    rare = np.flatnonzero(numbers >= FREQUENT)
    middle, low = cells[count:count + len(rare)].astype(np.int32), cells[count + len(rare):]
    numbers[rare] = FREQUENT + ((numbers[rare] - FREQUENT) << 16) + (middle << 8) + low
    return pa.array(ids, mask=~known), sizes, numbers


#: Distinct words of one lot: the places of three bytes hold (256 - 200) * 65,536 numbers.
MOST = FREQUENT + (256 - FREQUENT) * 65_536


class _Lot:
    def __init__(self):
        self.known, self.ids, self.sizes, self.numbers, self.words = _Numbers(), [], [], [], 0

    def add(self, id: int | None, text: str | None, pattern: regex.Pattern) -> None:
        size = 0
        for found in _slices(text, pattern):
            self.numbers.append(np.fromiter(map(self.known.__getitem__, found), dtype=np.int32, count=len(found)))
            size += len(found)
        self.ids.append(id)
        self.sizes.append(size)
        self.words += size

    def full(self) -> bool:
        return len(self.known) >= LOT_DISTINCT or self.words >= LOT_WORDS

    def posted(self, task: int, turn: int) -> Iterator[pa.RecordBatch]:
        """The lot's texts in one row, and a row per distinct word; frequent words have the small numbers."""
        numbers = np.concatenate(self.numbers) if self.numbers else np.empty(0, dtype=np.int32)
        if len(self.known) > MOST or turn >> TURN_BITS:
            raise ValueError("a text holds more distinct words, or a task more lots, than a place can number")
        order = np.argsort(-np.bincount(numbers, minlength=len(self.known)), kind="stable")
        renumbered = np.empty(len(order), dtype=np.int64)
        renumbered[order] = np.arange(len(order))
        ids = pa.array(self.ids, pa.int64())
        texts = _pack(ids, np.array(self.sizes, dtype=np.int64), renumbered[numbers])
        # A task that is repeated over rows in another order makes other lots, and no mixture of two goes unnoticed.
        lot = (task << TURN_BITS | turn) << CHECK_BITS | xxhash.xxh3_64_intdigest(texts) & ((1 << CHECK_BITS) - 1)
        places = (lot << NUMBER_BITS) + renumbered
        yield pa.RecordBatch.from_arrays([pa.array([(lot << NUMBER_BITS) + TEXTS]), pa.array([texts], pa.binary())], schema=PLACED)
        words = list(self.known)
        for start in range(0, len(words), SLICE >> 4):
            own = pa.array(words[start:start + (SLICE >> 4)], pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(places[start:start + len(own)]), own.cast(pa.binary())], schema=PLACED)


def _slices(text: str | None, pattern: regex.Pattern) -> Iterator[list[str]]:
    """The words of a text, a bounded number of them at a time."""
    if not text:
        return
    late = not text.isascii() and LATE.search(text)
    if len(text) <= SLICE and not late:
        yield pattern.findall(text)
        return
    spans = (m.span() for m in pattern.finditer(LATE.sub(NEITHER, text) if late else text))
    while found := [text[a:b] for a, b in islice(spans, SLICE)]:
        yield found


def _posted(docs: DataFrame, pattern: str) -> DataFrame:
    """(place, data) of all lots' words and texts."""
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled, task, turn, lot = regex.compile(pattern), TaskContext.get().partitionId(), 0, _Lot()
        for id, text in table_rows(parts, "id", "text"):
            lot.add(id, text, compiled)
            if lot.full():
                yield from lot.posted(task, turn)
                lot, turn = _Lot(), turn + 1
        if lot.ids:
            yield from lot.posted(task, turn)

    return docs.mapInArrow(run, "place long, data binary")


def _encoder(path: str):
    """Of (place, data) with equal words together, the ids of every word; a run of equal words is encoded once."""
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, last, ids = ranks(path), None, b""
        for part in parts:
            part = part.filter(pc.not_equal(pc.bit_wise_and(part.column("place"), TEXTS), TEXTS))
            found = []
            for word in part.column("data").to_pylist():
                if word != last:
                    last, ids = word, np.array(table.encode(word), dtype=table.kind).tobytes()
                found.append(ids)
            yield pa.RecordBatch.from_arrays([part.column("place"), pa.array(found, pa.binary())], schema=PLACED)

    return run


def _gathered(numbers: np.ndarray, start: np.ndarray, count: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of a run of numbers, one after the other, and how many each has."""
    sizes = count[numbers]
    ends = np.cumsum(sizes)
    offsets = np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - sizes, sizes)
    return values[np.repeat(start[numbers], sizes) + offsets], sizes


def _reassembler(path: str):
    """The ids of every text of a lot, from its texts and the ids of its words."""
    out = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])

    def run(texts: pa.Table, words: pa.Table) -> pa.Table:
        kind = np.dtype(ranks(path).kind)
        number = words.column("place").to_numpy() & TEXTS
        found = pa.concat_arrays(words.column("data").chunks) if words.num_rows else pa.array([], pa.binary())
        offsets = np.frombuffer(found.buffers()[1], dtype=np.int32, count=len(found) + 1) // kind.itemsize if len(found) else np.zeros(1, np.int32)
        values = np.frombuffer(found.buffers()[2], dtype=kind) if len(found) else np.empty(0, kind)
        batches = []
        for packed in texts.column("data"):
            docs, sizes, numbers = _unpack(packed.as_py())
            size = int(numbers.max()) + 1 if len(numbers) else 0
            if len(number) != size:
                raise RuntimeError("words of a lot are missing: the documents changed while they were read")
            start, count = np.zeros(size, dtype=np.int64), np.zeros(size, dtype=np.int64)
            start[number], count[number] = offsets[:-1], np.diff(offsets)
            ends, first = np.cumsum(sizes), 0
            while first < len(docs):  # as many texts as make a batch, one at least
                begin = int(ends[first - 1]) if first else 0
                last = max(first + 1, int(np.searchsorted(ends, begin + SLICE, side="right")))
                ids, per_word = _gathered(numbers[begin:int(ends[last - 1])], start, count, values)
                per_word = np.concatenate([[0], np.cumsum(per_word)])
                bounds = per_word[np.concatenate([[0], ends[first:last] - begin])].astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(bounds), pa.array(ids.astype(np.int32)))
                batches.append(pa.RecordBatch.from_arrays([docs.slice(first, last - first), lists], schema=out))
                first = last
        return pa.Table.from_batches(batches, schema=out)

    return run


def encode(docs: DataFrame, path: str, pattern: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id`` and ``ids`` (array of int) of every row's whole text.

    ``path`` is a rank file on every machine, ``pattern`` cuts texts into words. No special token
    is known; what a pattern does not match has no ids. A null or empty text has none. Bytes that
    are no UTF-8 count as replacement characters. Repeated rows and null ids give a row each; an
    empty table gives none. Memory is bounded by a lot, or by the longest single text.
    """
    read = inputs(docs, id=id, text=text).select(F.col("id").cast("long").alias("id"), F.make_valid_utf8("text").alias("text"))
    posted, lot = _posted(read, pattern), F.shiftright("place", NUMBER_BITS)
    is_texts = F.col("place").bitwiseAND(F.lit(TEXTS)) == TEXTS
    dealt = F.when(is_texts, lot).otherwise(F.xxhash64("data"))
    posted = posted.repartition(dealt)
    words = posted.sortWithinPartitions(F.xxhash64("data")).mapInArrow(_encoder(path), "place long, data binary")
    # A condition that names the task stays above the exchange, so both readers share it and texts are cut once; the
    # lots are already dealt by their number, where the ids of their words come to them.
    texts = posted.where(is_texts | (F.spark_partition_id() < 0))
    return texts.groupBy(dealt.alias("lot")).cogroup(words.groupBy(lot.alias("lot"))).applyInArrow(
        _reassembler(path), "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str, ids: str = "ids", output: str = "decoded") -> DataFrame:
    """``encoded`` with the bytes of every row's ids; null ids give null, an unknown id is an error.

    The ids are joined with the table of token bytes, which has one entry per token of the
    vocabulary and so is held by every task.
    """
    others = [c for c in encoded.columns if c != output]
    read = encoded.select(*others)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = ranks(path).of
        known = [b""] * (max(table.values()) + 1)
        valid = np.zeros(len(known), dtype=bool)
        for token, rank in table.items():
            known[rank], valid[rank] = token, True
        tokens = pa.array(known, pa.binary())
        for part in parts:
            for at in range(0, part.num_rows, 64):  # a slice of rows at a time
                piece = part.slice(at, 64)
                lists = piece.column(ids)
                flat = lists.flatten()
                numbers = flat.to_numpy(zero_copy_only=False)
                if flat.null_count or (len(numbers) and (numbers.min() < 0 or numbers.max() >= len(known) or not valid[numbers].all())):
                    raise ValueError("an id is not in the vocabulary")
                data = tokens.take(pa.array(numbers, pa.int64()))
                sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
                bounds = np.concatenate([[0], np.cumsum(sizes)])
                edges = np.frombuffer(data.buffers()[1], dtype=np.int32)[:len(data) + 1] if len(data) else np.zeros(1, np.int32)
                found = pa.BinaryArray.from_buffers(
                    pa.binary(), len(lists), [None, pa.py_buffer(edges[bounds].astype(np.int32).tobytes()), data.buffers()[2] or pa.py_buffer(b"")])
                if lists.null_count:
                    found = pa.array([None if n else b.as_py() for n, b in zip(lists.is_null().to_pylist(), found)], pa.binary())
                yield pa.RecordBatch.from_arrays([*piece.columns, found], names=[*others, output])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in read.schema), f"`{output}` binary"])
    return read.mapInArrow(run, schema)
