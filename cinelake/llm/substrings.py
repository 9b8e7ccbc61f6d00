"""Removal of long repeated word sequences by prefix-partitioned suffix trees.

Only suffixes at anchors are indexed: in every window of 50 consecutive words the anchor is the
start of the eight-word prefix with the smallest hash, so equal windows have equal anchors. A census
of the anchors' prefixes drops those that one text alone holds: their subtree is a leaf. The rest
is split by prefix into lots that fit in memory, each suffix with the words of the windows it anchors.
A lot's subtrees are built level by level down to depth 50; a node there is a set of
equal windows, and everything but its smallest document repeats. A prefix that too many documents
share is extended to the full 50 words, where all suffixes are equal and only the smallest
document counts, which is an aggregate. Runs of repeated windows are the maximal repeats.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinelake.llm.store import stored
from cinelake.llm.text import WordHashes, batches, hashes, inputs, sequence_key, shingles, table_rows, words

WINDOW = 50
PREFIX = 8
#: Suffixes in one lot, about; a prefix with more of them is extended to the whole window.
LOT = 30_000


def anchors(values: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Prefix hash, and first and last start of the windows it anchors, for every anchor of a text."""
    prefixes = shingles(values, PREFIX)
    span = window - PREFIX + 1
    starts = len(values) - window + 1
    view = np.lib.stride_tricks.sliding_window_view(prefixes, span)
    at = np.empty(starts, dtype=np.int64)
    for low in range(0, starts, 1 << 16):
        at[low:low + (1 << 16)] = view[low:low + (1 << 16)].argmin(axis=1)
    at += np.arange(starts)
    first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    last = np.concatenate([first[1:], [starts]]) - 1
    return prefixes[at[first]].view(np.int64), at[first], first, last


def repeated_starts(chunks: list[tuple[int, list[bytes]]], window: int = WINDOW) -> list[np.ndarray]:
    """For each (document, words), which windows start in a smaller document of the lot as well.

    Suffixes are told apart by their first 1, 2, 4 ... words: the levels of the tree. The nodes at
    the depth of the window hold the windows that are equal.
    """
    number: dict[bytes, int] = {}
    sizes = np.array([len(w) for _, w in chunks])
    rank = np.fromiter((number.setdefault(x, len(number)) for _, w in chunks for x in w), dtype=np.int64, count=sizes.sum())
    begin = np.cumsum(sizes) - sizes

    def joined(rank: np.ndarray, shift: int) -> np.ndarray:
        following = np.zeros_like(rank)
        following[:len(rank) - shift] = rank[shift:]
        return np.unique(rank * (rank.max() + 1) + following, return_inverse=True)[1].astype(np.int64)

    depth = 1
    while depth < window:
        step = min(depth, window - depth)
        rank = joined(rank, step)
        depth += step
    counts = sizes - window + 1
    place = np.repeat(begin, counts) + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    owner = np.repeat(np.array([d for d, _ in chunks]), counts)
    node = np.unique(rank[place], return_inverse=True)[1]
    smallest = np.full(node.max() + 1, np.iinfo(np.int64).max)
    np.minimum.at(smallest, node, owner)
    return np.split(owner > smallest[node], np.cumsum(counts)[:-1])


def runs(flags: np.ndarray) -> list[tuple[int, int]]:
    """First and last place of every run of true flags."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return [(int(a), int(b) - 1) for a, b in zip(edges[::2], edges[1::2])]


def remove_repeats(docs: DataFrame, id: str = "doc_id", text: str = "text", kept_text: bool = False) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_removed`` and ``kept_sha256``, one row per row of ``docs``.

    A word goes if a window of 50 words covers it that also starts in a document with a smaller id.
    ``kept_text`` adds the kept words, joined by one blank, as ``text``. A null text has no words.
    A row without id has no place in the order: it neither loses words nor makes others lose any.
    Rows with the same id and text get the same result; two texts under one id do not remove each
    other. An empty table gives none.
    """
    read = inputs(docs, id=id, text=text).withColumn("id", F.col("id").cast("long"))
    found = stored(_anchored(read), "anchors")
    anchored = found.where("prefix is not null").repartition("prefix")
    texts = stored(found.where("prefix is null").select("doc_id", "sid").distinct().join(
        found.where("prefix is null").groupBy("sid").agg(F.min("doc_id").alias("first")), "sid"), "texts")
    census = anchored.groupBy("prefix").agg(
        F.min("sid").alias("x"), F.max("sid").alias("y"), F.count("*").alias("n")).where("x <> y").select("prefix", "n")
    first_texts = texts.where("doc_id = first").select("doc_id", "sid")
    shared = anchored.join(census, "prefix").join(first_texts, ["doc_id", "sid"])
    wanted = stored(shared.groupBy("doc_id", "sid").agg(
        F.collect_list(F.struct("prefix", "first", "last", "n")).alias("anchors")), "wanted")
    total = wanted.agg(F.sum(F.size("anchors"))).first()[0] or 0
    lots = total // LOT + 1
    chunks = stored(_chunks(read, wanted, lots), "chunks")
    repeats = _subtrees(chunks.where("prefix is not null")).unionAll(_whole_windows(chunks.where("prefix is null")))
    whole = texts.where("doc_id > first").select("doc_id", "sid", F.lit(None).cast("array<struct<low:long,high:long>>").alias("gone"))
    gone = repeats.groupBy("doc_id", "sid").agg(F.collect_list(F.struct("low", "high")).alias("gone"))
    verdicts = gone.unionAll(whole).groupBy("doc_id").agg(F.collect_list(F.struct("sid", "gone")).alias("verdicts"))
    return _without(read.join(verdicts.withColumnRenamed("doc_id", "id"), "id", "left"), kept_text)


def _anchored(read: DataFrame) -> DataFrame:
    """A row per anchor, and one without prefix per text of at least a window."""
    out = pa.schema([("doc_id", pa.int64()), ("sid", pa.string()), ("prefix", pa.int64()), ("first", pa.int64()), ("last", pa.int64())])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = WordHashes()

        def rows():
            for key, body in table_rows(parts, "id", "text"):
                tokens = words(body)
                if key is None or len(tokens) < WINDOW:
                    continue
                sid = sequence_key(tokens)
                yield key, sid, None, None, None
                prefix, _, first, last = anchors(hashes(tokens, cache))
                for row in zip(prefix.tolist(), first.tolist(), last.tolist()):
                    yield key, sid, *row

        return batches(rows(), out)

    return read.mapInArrow(run, "doc_id long, sid string, prefix long, first long, last long")


def _chunks(read: DataFrame, wanted: DataFrame, lots: int) -> DataFrame:
    """Anchored suffixes with the words of their windows; single windows, by hash, for extended prefixes."""
    out = pa.schema([("lot", pa.int64()), ("prefix", pa.int64()), ("h1", pa.int64()), ("h2", pa.int64()),
                     ("doc_id", pa.int64()), ("sid", pa.string()), ("first", pa.int64()), ("words", pa.binary())])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for key, sid, body, own in table_rows(parts, "id", "sid", "text", "anchors"):
                tokens = words(body)
                if sequence_key(tokens) != sid:
                    continue
                for a in own:
                    if a["n"] <= LOT:
                        yield (a["prefix"] % lots, a["prefix"], None, None, key, sid, a["first"],
                               b" ".join(tokens[a["first"]:a["last"] + WINDOW]))
                        continue
                    for start in range(a["first"], a["last"] + 1):
                        h = xxhash.xxh3_128_intdigest(b" ".join(tokens[start:start + WINDOW]))
                        yield (None, None, (h >> 64) - (1 << 63), (h & ((1 << 64) - 1)) - (1 << 63), key, sid, start, None)

        return batches(rows(), out, lambda row: 100 + len(row[7] or b""))

    joined = read.join(wanted.withColumnRenamed("doc_id", "id"), "id")
    return joined.select("id", "sid", "text", "anchors").mapInArrow(
        run, "lot long, prefix long, h1 long, h2 long, doc_id long, sid string, first long, words binary")


def _subtrees(chunks: DataFrame) -> DataFrame:
    out = pa.schema([("doc_id", pa.int64()), ("sid", pa.string()), ("low", pa.int64()), ("high", pa.int64())])

    def build(lot: pa.Table) -> pa.Table:
        rows = list(zip(*(lot.column(c).to_pylist() for c in ("doc_id", "sid", "first", "words"))))
        flags = repeated_starts([(d, w.split()) for d, _, _, w in rows])
        found = [(d, sid, first + a, first + b) for (d, sid, first, _), f in zip(rows, flags) for a, b in runs(f)]
        return pa.Table.from_batches(batches(found, out), out)

    return chunks.groupBy("lot").applyInArrow(build, "doc_id long, sid string, low long, high long")


def _whole_windows(windows: DataFrame) -> DataFrame:
    smallest = windows.groupBy("h1", "h2").agg(F.min("doc_id").alias("least"))
    return windows.join(smallest, ["h1", "h2"]).where("doc_id > least").select(
        "doc_id", "sid", F.col("first").alias("low"), F.col("first").alias("high"))


def _without(joined: DataFrame, kept_text: bool) -> DataFrame:
    fields = [("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string())]
    out = pa.schema(fields + ([("text", pa.string())] if kept_text else []))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for key, body, verdicts in table_rows(parts, "id", "text", "verdicts"):
                tokens = words(body)
                kept = tokens
                if verdicts:
                    sid = sequence_key(tokens)
                    for v in verdicts:
                        if v["sid"] != sid:
                            continue
                        keep = np.ones(len(tokens), dtype=bool)
                        for part in v["gone"] if v["gone"] is not None else [{"low": 0, "high": len(tokens)}]:
                            keep[part["low"]:part["high"] + WINDOW] = False
                        kept = [w for w, k in zip(tokens, keep.tolist()) if k]
                        break
                body = b" ".join(kept)
                row = (key, len(tokens), len(tokens) - len(kept), hashlib.sha256(body).hexdigest())
                yield row + ((body.decode("utf-8", "surrogatepass"),) if kept_text else ())

        return batches(rows(), out, (lambda row: 100 + len(row[4])) if kept_text else lambda row: 128)

    return joined.select("id", "text", "verdicts").mapInArrow(
        run, "doc_id long, n_words long, n_removed long, kept_sha256 string" + (", text string" if kept_text else ""))
