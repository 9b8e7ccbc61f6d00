"""Near-duplicate join on word shingles: a size-aware, heavy-light set join.

Texts with the same shingles form one class and count once. Shingles are ordered from rare to
frequent by a count sketch over all documents. Two sets that overlap enough share a shingle among
the first ``n - ceil(0.8 n) + 1`` of each, and two shingles among one more than that. Small sets
therefore emit every pair of that longer prefix as one key; large sets, and the small ones that can
match a large one, go into the inverted list of each shingle of the shorter prefix. The size where
one way gives way to the other has the least estimated cost over the histogram of sizes.

Lists that hold the same classes are one list, and pairs of a list are candidates if their sizes and
parities allow a link. Lists are not expanded into pairs: each is first compared with its smallest and
its largest class, and candidates join into groups. While the pairs of a list that are still in
different groups outnumber its entries, further classes serve as hubs. Then those pairs are compared,
all of them. So every link lies within a group.

Groups are verified on whole sets, each of which travels once per tile of its group: tiles of bounded
size are multiplied as incidence matrices, which gives the links of every class and the components
without a row per pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinelake.llm.store import blocks, components, stored, summed
from cinelake.llm.text import BATCH_BYTES, WordHashes, batches, chained, hashes, inputs, shingles, table_rows, words

WIDTH = 5
#: Links need ``100 * intersection >= PERCENT * union``.
PERCENT = 80
#: Cells of the count sketch: 2 MB whatever the data.
SKETCH = 1 << 18
#: Classes a task remembers to pass each of them on once; bounds memory, never results.
CACHED_CLASSES = 500_000
#: Bits of the filter of classes that have candidates: 8 MB whatever the data. It passes too many, never too few.
FILTER_BITS = 1 << 26
#: Parity bits kept per class: sets that differ in few shingles differ in few of them.
PARITY = 256
BITS = [f"w{k}" for k in range(PARITY // 64)]
#: Parity bits that candidate pairs are looked at with before whole sets travel, at least; larger sets have as many as
#: shingles, up to the next power of two.
WIDE = 2048
#: Pairs across components that lists may expand to, per entry, before further hubs are tried first.
LINEAR = 4
#: Classes of a tile, and shingles of one slice of its incidence matrix: bound memory, never results.
TILE = 512
COLUMNS = 4096
#: Cost of scanning an inverted list per entry, against emitting one subset.
SCAN_COST = 4.0


def shingle_set(text: str | None, cache: WordHashes, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct 64-bit shingle hashes of a text."""
    return np.unique(shingles(hashes(words(text, lower=True), cache), width))


def class_of(found: np.ndarray) -> int:
    """64-bit id of a set, as a signed long."""
    return int(np.uint64(xxhash.xxh3_64_intdigest(found.tobytes())).astype(np.int64))


def parity(found: np.ndarray, bits: int) -> np.ndarray:
    """Whether an odd number of shingles falls on each bit, packed into longs."""
    odd = np.bincount((found >> np.uint64(40)).astype(np.int64) % bits, minlength=bits) & 1
    return np.packbits(odd.astype(bool)).view(np.int64)


def wide(found: np.ndarray) -> np.ndarray:
    """Parities of as many bits as tell apart sets of this size."""
    return parity(found, max(WIDE, 1 << max(len(found) - 1, 0).bit_length()))


def needed(size: int) -> int:
    """Least overlap of a set of this size with any set it links to."""
    return -(-PERCENT * size // 100)


def boundary(sizes: dict[int, int]) -> int:
    """Largest size that counts as small: the one with the least estimated cost."""
    if not sizes:
        return 0
    most = max(sizes)
    light, heavy = np.zeros(most + 2), np.zeros(most + 2)
    for n, count in sizes.items():
        p = n - needed(n) + 1
        light[n] = count * (p + 1) * p / 2
        heavy[n] = count * p * SCAN_COST
    below, listed = np.cumsum(light), np.cumsum(heavy)
    costs = [below[b] + listed[-1] - listed[needed(b + 1) - 1 if b else 0] for b in range(most + 1)]
    return int(np.argmin(costs))


def keys(found: np.ndarray, sketch: np.ndarray, small: int) -> np.ndarray:
    """The join keys of a set."""
    n = len(found)
    if n < 4:
        return found[:0]  # such sets link with equal ones only
    order = found[np.lexsort((found, sketch[(found % np.uint64(len(sketch))).astype(np.int64)]))]
    p = n - needed(n) + 1
    out = []
    if n <= small:
        first = order[:p + 1]
        i, j = np.triu_indices(len(first), 1)
        low, high = np.minimum(first[i], first[j]), np.maximum(first[i], first[j])
        out.append(chained((low, high), 2))
    if n >= needed(small + 1):
        out.append(order[:p])
    return np.concatenate(out)


def near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id``, ``class_id``, ``n_links``, ``group_id`` and ``content``, one row per row.

    ``component_id`` is the smallest id reachable over links, null only if no id of the component is
    known. Rows of equal sets share a ``class_id``, and ``n_links`` is the number of other rows that
    a row is linked with; counting them is quadratic in the classes of one group of near copies.
    ``group_id`` tells components apart, those without any id included, and ``content`` is a hash of
    the text, which tells texts under one id apart. A null text or one without words has no shingles, is linked with nothing and keeps its own id.
    Repeated rows give a row each and share their component; an empty table gives none. Sets are
    told apart by 64-bit hashes of their shingles and of themselves.
    """
    read = inputs(docs, id=id, text=text).select(F.col("id").cast("long").alias("id"), "text", F.xxhash64("text").alias("mark"))
    seen = stored(_seen(read), "sets")
    info = seen.where("block is null")
    classes = info.where("n > 0").groupBy("cid").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("copies"), F.min("mark").alias("mark"))
    classes = stored(classes, "classes")
    found = stored(_verified(read, classes, _groups(read, seen)), "links")
    labels = components(found.where("other is not null").select(F.col("cid").alias("a"), F.col("other").alias("b")))
    counted = found.groupBy("cid").agg(F.sum("linked").alias("linked"))
    classes = classes.join(labels.select(F.col("node").alias("cid"), "label"), "cid", "left").join(counted, "cid", "left").select(
        "cid", "least", (F.col("copies") - 1 + F.coalesce("linked", F.lit(0))).alias("links"), F.coalesce("label", "cid").alias("label"))
    whole = classes.groupBy("label").agg(F.min("least").alias("component"))
    of_class = classes.join(whole, "label").select("cid", "label", "component", "links")
    some = F.col("n") > 0
    return info.join(of_class, "cid", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(some, F.col("component")).otherwise(F.col("doc_id")).alias("component_id"),
        F.when(some, F.col("cid")).alias("class_id"), F.when(some, F.col("links")).otherwise(0).alias("n_links"),
        F.when(some, F.col("label")).alias("group_id"), F.col("mark").alias("content"))


def _seen(read: DataFrame) -> DataFrame:
    """One pass over all texts: a row per row, with the parities of a class where a task meets it first, and the count
    sketch's blocks, which have no row of ``read``."""
    out = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("cid", pa.int64()), ("mark", pa.int64()), *((w, pa.int64()) for w in BITS),
                     ("wide", pa.list_(pa.int64())), ("block", pa.int64()), ("cells", pa.binary())])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, cells, known = WordHashes(), np.zeros(SKETCH, dtype=np.int64), set()

        def rows():
            for key, body, mark in table_rows(parts, "id", "text", "mark"):
                found = shingle_set(body, cache)
                cid = class_of(found)
                if cid in known:
                    yield key, len(found), cid, mark, *(None,) * (len(BITS) + 3)
                    continue
                if len(known) >= CACHED_CLASSES:
                    known.clear()
                known.add(cid)
                np.add.at(cells, (found % np.uint64(SKETCH)).astype(np.int64), 1)
                yield key, len(found), cid, mark, *parity(found, PARITY).tolist(), wide(found), None, None
            for block, packed in blocks(cells):
                yield *(None,) * (len(BITS) + 5), block, packed

        return batches(rows(), out, lambda row: len(row[-1] or b"") + (8 * len(row[-3]) if row[-3] is not None else 0) + 100)

    return read.mapInArrow(run, "doc_id long, n long, cid long, mark long, " + ", ".join(f"{w} long" for w in BITS)
                           + ", wide array<long>, block long, cells binary")


def _lists(read: DataFrame, seen: DataFrame) -> DataFrame:
    """(key, cid, n) of the keys that two classes share, one key for all that have the same classes."""
    spark = read.sparkSession
    # Sizes above 2,000 count as 2,000 here: that moves the boundary of least cost, and no result.
    sizes = {r.n: r["count"] for r in seen.where("n > 0").select(
        F.least("n", F.lit(2000)).alias("n")).groupBy("n").count().collect()}
    small = boundary(sizes)
    sketch = spark.sparkContext.broadcast(summed(seen.where("block is not null").select("block", "cells"), SKETCH))
    out = pa.schema([("key", pa.int64()), ("cid", pa.int64()), ("n", pa.int64())])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, held, size, marks, met = WordHashes(), [], 0, set(), set()

        def packed():
            key, cid, n = (np.concatenate(c) for c in zip(*held))
            return pa.RecordBatch.from_arrays([pa.array(key), pa.array(cid), pa.array(n)], schema=out)

        for body, mark in table_rows(parts, "text", "mark"):
            if mark in marks:  # a task posts the copies of a class once; the rest go with distinct below
                continue
            found = shingle_set(body, cache)
            cid = class_of(found)
            if len(marks) >= CACHED_CLASSES:
                marks.clear()
                met.clear()
            marks.add(mark)
            if cid in met:
                continue
            met.add(cid)
            own = keys(found, sketch.value, small).view(np.int64)
            if len(own):
                held.append((own, np.full(len(own), cid), np.full(len(own), len(found))))
                size += 24 * len(own)
                if size >= BATCH_BYTES:
                    yield packed()
                    held, size = [], 0
        if held:
            yield packed()

    # Both sides read the same columns of the same rows, so they share one exchange.
    posted = read.select("text", "mark").mapInArrow(run, "key long, cid long, n long").where("key is not null").repartition("key")
    # Tasks that met copies of one class have posted the same keys: they go before anything is joined.
    posted = posted.distinct()
    own = F.xxhash64("cid")
    lists = posted.groupBy("key").agg(
        F.min("cid").alias("low"), F.max("cid").alias("high"), F.max("n").alias("most"), F.count(F.lit(1)).alias("c"),
        F.sum(own.bitwiseAND(F.lit(0xFFFFFFFF))).alias("x"), F.sum(F.shiftrightunsigned(own, 32)).alias("y"))
    kept = lists.where("low <> high and most > 0").groupBy("c", "x", "y").agg(F.min("key").alias("key")).select("key")
    return posted.join(kept, "key")


def _sets(read: DataFrame, wanted: DataFrame) -> DataFrame:
    """(cid, items) of the classes whose rows have the marks in ``wanted``, once each."""
    spark = read.sparkSession
    out = pa.schema([("block", pa.int64()), ("cells", pa.binary())])

    def mark(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(FILTER_BITS, dtype=bool)
        for part in parts:
            bits[_bit(part.column("mark"))] = True
        cells = np.packbits(bits).view(np.int64)
        return batches(blocks(cells), out, lambda row: len(row[1]))

    # Bits are distinct marks here, so adding the packed blocks of disjoint sets of bits joins them.
    by_bit = wanted.select(F.pmod("mark", F.lit(FILTER_BITS)).alias("mark")).distinct()
    packed = summed(by_bit.mapInArrow(mark, "block long, cells binary"), FILTER_BITS // 64)
    chosen = spark.sparkContext.broadcast(packed.view(np.uint8))
    schema = pa.schema([("cid", pa.int64()), ("items", pa.list_(pa.int64()))])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, met = WordHashes(), set()

        def passed():
            for part in parts:  # other texts never become Python objects
                bit = _bit(part.column("mark"))
                own = part.filter(pa.array((chosen.value[bit >> 3] >> (7 - (bit & 7)) & 1).astype(bool)))
                if own.num_rows:
                    yield own

        def rows():
            for body, mark in table_rows(passed(), "text", "mark"):
                if mark not in met:
                    if len(met) >= CACHED_CLASSES:
                        met.clear()
                    met.add(mark)
                    found = shingle_set(body, cache)
                    yield class_of(found), found.view(np.int64)

        return batches(rows(), schema, lambda row: 8 * len(row[1]))

    found = read.select("text", "mark").mapInArrow(run, "cid long, items array<long>")
    return found.groupBy("cid").agg(F.first("items").alias("items"))


def _bit(marks: pa.Array) -> np.ndarray:
    return (marks.to_numpy(zero_copy_only=False).view(np.uint64) % np.uint64(FILTER_BITS)).astype(np.int64)


def _overlap(total):
    """Least overlap of two linked sets, by the sum of their sizes."""
    return F.ceil(total * PERCENT / (100 + PERCENT) - 1e-9)


def _possible(x: str, y: str):
    """Whether two classes can link, by their sizes and parities.

    Two sets differ in at least as many shingles as their parities differ in bits.
    """
    apart = sum((F.bit_count(F.col(f"{x}.{w}").bitwiseXOR(F.col(f"{y}.{w}"))) for w in BITS), F.lit(0))
    n, m = F.col(f"{x}.n"), F.col(f"{y}.n")
    return (100 * F.least(n, m) >= PERCENT * F.greatest(n, m)) & (apart <= n + m - 2 * _overlap(n + m))


def _pair(x: str, y: str):
    return F.least(f"{x}.cid", f"{y}.cid").alias("a"), F.greatest(f"{x}.cid", f"{y}.cid").alias("b")


def _apart(p: str, q: str):
    """In how many bits two wide parities differ, the longer one folded to the length of the other.

    Sizes of a candidate pair are near, so one is at most twice as long.
    """
    def folded(x: str, y: str):
        half = (F.size(x) / 2).cast("int")
        halves = F.zip_with(F.slice(x, F.lit(1), half), F.slice(x, half + 1, half), lambda a, b: a.bitwiseXOR(b))
        return F.when(F.size(x) > F.size(y), halves).otherwise(F.col(x))

    bits = F.zip_with(folded(p, q), folded(q, p), lambda a, b: F.bit_count(a.bitwiseXOR(b)))
    return F.aggregate(bits, F.lit(0), lambda x, y: x + y)


def _candidates(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs (a, b) that the wide parities do not rule out."""
    side = lambda c, n, w: classes.select(F.col("cid").alias(c), F.col("n").alias(n), F.col("wide").alias(w))
    wide = pairs.distinct().join(side("a", "m", "p"), "a").join(side("b", "n", "q"), "b")
    return stored(wide.where(_apart("p", "q") <= F.col("m") + F.col("n") - 2 * _overlap(F.col("m") + F.col("n"))).select("a", "b"), "pairs")


def _groups(read: DataFrame, seen: DataFrame) -> DataFrame:
    """(node, label): the group of every class that has a candidate. Links lie within groups."""
    lists = stored(_lists(read, seen), "lists")
    listed = lists.select("cid").distinct()
    classes = stored(seen.where("wide is not null").join(listed, "cid", "left_semi").groupBy("cid").agg(
        *(F.first(c).alias(c) for c in ("n", *BITS, "wide"))), "classes")
    lists = stored(lists.join(classes.select("cid", *BITS), "cid"), "lists")
    links, labels, before, turn = None, None, None, 0
    while True:
        hubs = ((F.min, F.col("cid")), (F.max, F.col("cid"))) if not turn else ((F.min, F.xxhash64("cid", F.lit(turn))),)
        known = lists if labels is None else _open(lists, labels)
        if labels is not None:
            known = stored(known, "open")
            groups = known.groupBy("key", "label").count().groupBy("key").agg(
                F.sum("count").alias("n"), F.sum(F.col("count") * F.col("count")).alias("within"))
            rows, crossing = groups.agg(F.sum("n"), F.sum((F.col("n") * F.col("n") - F.col("within")) / 2)).first()
            if not rows:
                return labels
            if crossing <= LINEAR * rows or (before is not None and crossing > 0.9 * before):
                break
            before = crossing
        stars = None
        for pick, order in hubs:
            hub = known.groupBy("key").agg(pick(F.struct(order.alias("o"), "cid", "n", *BITS)).alias("hub")).select("key", "hub.*")
            star = known.alias("x").join(hub.alias("y"), "key").where("x.cid <> y.cid").where(_possible("x", "y")).select(*_pair("x", "y"))
            stars = star if stars is None else stars.unionAll(star)
        found = _candidates(stars, classes)
        links = found if links is None else links.unionAll(found)
        labels = stored(components(links), "labels")
        turn += 1
    # Entries are fewer than the pairs they may make, so the wide parities come to them and rule out pairs as they arise.
    known = stored(known.join(classes.select("cid", "wide"), "cid"), "open")
    x, y = known.alias("x"), known.alias("y")
    pairs = x.join(y, (F.col("x.key") == F.col("y.key")) & (F.col("x.label") < F.col("y.label")) & _possible("x", "y") & (
        _apart("x.wide", "y.wide") <= F.col("x.n") + F.col("y.n") - 2 * _overlap(F.col("x.n") + F.col("y.n"))))
    return components(links.unionAll(stored(pairs.select(*_pair("x", "y")).distinct(), "pairs")))


def _open(lists: DataFrame, labels: DataFrame) -> DataFrame:
    """The lists that still hold different groups, with each entry's group."""
    known = lists.join(labels.select(F.col("node").alias("cid"), "label"), "cid", "left").select(
        "key", "cid", "n", *BITS, F.coalesce("label", "cid").alias("label"))
    several = known.groupBy("key").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x <> y").select("key")
    return known.join(several, "key")


def _verified(read: DataFrame, classes: DataFrame, groups: DataFrame) -> DataFrame:
    """(cid, linked, other): in part how many rows of other classes a class is linked with, and classes it is connected to.

    A group's classes are dealt to tiles by a hash, about ``TILE`` to each, and every pair of tiles
    is looked at on its own: its size is bounded, and a class travels once per tile of its group.
    """
    grouped = classes.join(groups.select(F.col("node").alias("cid"), "label"), "cid")
    sizes = grouped.groupBy("label").agg(F.ceil(F.count(F.lit(1)) / TILE).alias("tiles"))
    own = stored(grouped.join(sizes, "label").select(
        "cid", "label", "copies", "mark", "tiles", F.pmod(F.xxhash64("cid"), "tiles").alias("tile")), "members")
    sets = own.join(_sets(read, own).withColumnRenamed("cid", "_cid"), F.col("cid") == F.col("_cid")).drop("_cid", "mark")
    dealt = sets.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)))
    dealt = dealt.select("label", F.least("tile", "other").alias("p"), F.greatest("tile", "other").alias("q"), "tile", "cid", "copies", "items")
    out = pa.schema([("cid", pa.int64()), ("linked", pa.int64()), ("other", pa.int64())])

    def count(table: pa.Table) -> pa.Table:
        cid, tile, copies = (table.column(c).to_numpy() for c in ("cid", "tile", "copies"))
        p, q = table.column("p")[0].as_py(), table.column("q")[0].as_py()
        left, right = np.flatnonzero(tile == p), np.flatnonzero(tile == q)
        linked = linked_classes(table.column("items"), left, right)
        if p == q:
            linked[np.arange(len(left)), np.arange(len(left))] = False
        root = connected(linked, left, right, len(cid))
        # A class of the first tile counts its links here; one of the second does where the tiles differ.
        sums = np.zeros(len(cid), dtype=np.int64)
        sums[left] += linked @ copies[right]
        if p != q:
            sums[right] += copies[left] @ linked
        others = [None if r == k else int(cid[r]) for k, r in enumerate(root.tolist())]
        return pa.table([pa.array(cid, pa.int64()), pa.array(sums), pa.array(others, pa.int64())], schema=out)

    return dealt.groupBy("label", "p", "q").applyInArrow(count, "cid long, linked long, other long")


def connected(linked: np.ndarray, left: np.ndarray, right: np.ndarray, count: int) -> np.ndarray:
    """For each of ``count`` classes the first one it is connected to over the links between two tiles."""
    root = np.arange(count)
    while len(left) and len(right):
        before = root.copy()
        root[left] = np.minimum(root[left], np.where(linked, root[right][None, :], count).min(axis=1))
        root[right] = np.minimum(root[right], np.where(linked, root[left][:, None], count).min(axis=0))
        if (root == before).all():
            break
    return root


def linked_classes(items: pa.ChunkedArray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Which sets of two tiles overlap enough, as a matrix.

    Only shingles that both tiles have can count; they are looked at in slices of bounded number.
    """
    if not len(left) or not len(right):  # a hash may leave a tile empty
        return np.zeros((len(left), len(right)), dtype=bool)
    used, same = np.union1d(left, right), np.array_equal(left, right)
    sets = [items[int(k)].values.to_numpy() for k in used]
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), sizes)
    names, column = np.unique(np.concatenate(sets), return_inverse=True)
    rows, columns = np.searchsorted(used, left), np.searchsorted(used, right)
    on = [np.bincount(column[np.isin(used, side)[owner]], minlength=len(names)) for side in (left, right)]
    shared = on[0] > 1 if same else (on[0] > 0) & (on[1] > 0)
    kept = shared[column]
    owner, column = owner[kept], (np.cumsum(shared) - 1)[column[kept]]
    order = np.argsort(column, kind="stable")
    owner, column, width = owner[order], column[order], int(shared.sum())
    both = np.zeros((len(left), len(right)), dtype=np.float32)  # overlaps below 2^24 are exact
    for first in range(0, width, COLUMNS):
        a, b = np.searchsorted(column, [first, first + COLUMNS])
        table = np.zeros((len(sets), min(COLUMNS, width - first)), dtype=np.float32)
        table[owner[a:b], column[a:b] - first] = 1
        both += table[rows] @ table[columns].T
    both = both.astype(np.int64)
    if same:  # a set has all its own shingles, shared or not
        both[np.arange(len(left)), np.arange(len(left))] = sizes[rows]
    union = sizes[rows][:, None] + sizes[columns][None, :] - both
    return 100 * both >= PERCENT * union
