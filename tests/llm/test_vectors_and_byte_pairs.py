"""Whitening, vector codes and byte-level pairs against libraries and brute force."""

import hashlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cinelake.llm import byte_pairs, queries, vector_codes, vectors, whitening

tiktoken = pytest.importorskip("tiktoken")
public_tokenizers = pytest.importorskip("public_tokenizers")
TEXTS = [
    (1, None), (2, ""), (3, " \n\t  "), (4, "one"), (5, "it's  we'll\n\n漢字 é🙂 12345 <|endoftext|> ..."), (6, "ab" * 3000),
    (7, "the the the"), (7, "the the the"), (None, "no id"), (8, "a　b\xa0c\x85d   e"), (9, "x\U00016ea7 Ᲊ\U000323b0y"),
    (10, "word " * 500 + "tail"),
]
VECTORS = "vec_id long, embedding array<double>, label string, id long, code string"


@pytest.fixture(scope="module")
def library():
    table = byte_pairs.ranks(queries.model_path(queries.RANKS)).of
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame([(i, t, i, "x") for i, t in TEXTS], "doc_id long, text string, lot long, word string")


def encoded(docs):
    path = queries.model_path(queries.RANKS)
    found = byte_pairs.encode(docs, path, public_tokenizers.PATTERN)
    return byte_pairs.decode(found, path)


@pytest.mark.parametrize("lot", [400_000, 3])
def test_byte_pairs_equal_the_library(texts, library, lot, monkeypatch):
    monkeypatch.setattr(byte_pairs, "LOT_DISTINCT", lot)
    want = sorted((str(i), library.encode_ordinary(t or ""), (t or "").encode()) for i, t in TEXTS)
    assert sorted((str(r.doc_id), r.ids, bytes(r.decoded)) for r in encoded(texts).collect()) == want
    assert encoded(texts.where("false")).count() == 0


def test_texts_are_cut_once(texts):
    df = encoded(texts)
    df.collect()
    assert df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0].count("ReusedExchange") == 1


def test_long_texts_come_in_slices(texts, library, monkeypatch):
    monkeypatch.setattr(byte_pairs, "SLICE", 16)
    want = sorted((str(i), library.encode_ordinary(t or "")) for i, t in TEXTS)
    assert sorted((str(r.doc_id), r.ids) for r in encoded(texts).collect()) == want


def test_every_character_is_cut_as_the_library_cuts_it():
    """A toy table merges a letter, digit or stop with the first byte behind it only if one word holds both."""
    ranks = {bytes([b]): b for b in range(256)}
    for p in (b"a", b"1", b"."):
        ranks |= {p + bytes([b]): len(ranks) + b - 128 for b in range(128, 256)}
    toy = tiktoken.Encoding("toy", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    pattern = byte_pairs.regex.compile(public_tokenizers.PATTERN)
    for code in [*range(128, 0xD800), *range(0xE000, 0x110000)]:
        for p in "a1.":
            text = p + chr(code)
            together = len(toy.encode_ordinary(text)) == len(text.encode()) - 1
            words = [w for found in byte_pairs._slices(text, pattern) for w in found]
            assert (len(words) == 1) == together, hex(code)


def test_both_ways_of_merging_agree(library):
    draw = np.random.default_rng(1)
    table = byte_pairs.ranks(queries.model_path(queries.RANKS))
    for size in (2, 5, 30, 129, 400):
        for _ in range(30):
            word = bytes(draw.choice(np.frombuffer(b"aabbcetthinges\xe6\xbc\xa2", dtype=np.uint8), size))
            assert table._scanned(word) == table._heaped(word)
    long = "ab" * 100_000 + "漢" * 1000
    assert table.encode(long.encode()) == library.encode_ordinary(long)


def test_lots_survive_packing():
    numbers = np.array([0, 199, 200, 455, 456, 65_735, 65_736, byte_pairs.MOST - 1], dtype=np.int64)
    for ids, sizes, own in (([1, None, -5], [3, 0, 5], numbers), ([None], [0], numbers[:0]), ([], [], numbers[:0])):
        back = byte_pairs._unpack(byte_pairs._pack(pa.array(ids, pa.int64()), np.array(sizes, dtype=np.int64), own))
        assert [b.tolist() for b in back] == [ids, sizes, own.tolist()]


def test_unknown_and_null_ids(spark):
    path = queries.model_path(queries.RANKS)
    some = spark.createDataFrame([(1, None), (2, []), (3, [0, 1])], "doc_id long, ids array<int>")
    table = {r: t for t, r in byte_pairs.ranks(path).of.items()}
    assert {r.doc_id: r.decoded and bytes(r.decoded) for r in byte_pairs.decode(some, path).collect()} == {
        1: None, 2: b"", 3: table[0] + table[1]}
    for bad in ([-1], [10 ** 6], [None]):
        with pytest.raises(Exception, match="not in the vocabulary"):
            byte_pairs.decode(spark.createDataFrame([(1, bad)], "doc_id long, ids array<int>"), path).collect()


def awkward(spark, width=16, rows=300, scale=1.0):
    draw = np.random.default_rng(4)
    made = [(i, (draw.normal(size=width) * scale).tolist(), None if i % 3 == 0 else "odd" if i % 2 else "even") for i in range(rows)]
    made += [(5, made[5][1], "odd"), (7, made[8][1], "even"), (None, made[9][1], None)]
    left_out = [(900, None, "x"), (901, [float("nan")] * width, "x"), (902, [float("inf")] + [0.0] * (width - 1), "x"),
                (903, [None] + [0.0] * (width - 1), "x"), (904, [1.0] * (width + 1), "x"), (905, [1e300] * width, "x")]
    return spark.createDataFrame([(*r, -1, "c") for r in made + left_out], VECTORS).repartition(5), made


def brute_codes(made, factor=4096):
    rows = [([int(np.floor(factor * x)) for x in v], i, label) for i, v, label in made]
    width = -(-len(rows[0][0]) // 8)
    cut = [[(q + [0] * (8 * width - len(q)))[p * width:(p + 1) * width] for p in range(8)] for q, _, _ in rows]
    order = sorted(range(len(rows)), key=lambda k: (rows[k][1] is None, rows[k][1] or 0, made[k][1]))[:16]
    books = [[cut[k][p] for k in order] for p in range(8)]

    def far(a, b):
        return sum((x - y) ** 2 for x, y in zip(a, b))

    def assigned():
        return [[min((far(c[p], e), k) for k, e in enumerate(books[p])) for p in range(8)] for c in cut]

    for _ in range(6):
        found = assigned()
        for p in range(8):
            for k in range(len(books[p])):
                own = [c[p] for c, f in zip(cut, found) if f[p][1] == k]
                if own:
                    books[p][k] = [sum(x) // len(own) for x in zip(*own)]
    found = assigned()
    error = [sum(d for d, _ in f) for f in found]
    whole = {}
    for (_, _, label), e in zip(rows, error):
        whole[label] = whole.get(label, 0) + e
    sha = hashlib.sha256(",".join(str(x) for part in books for e in part for x in e).encode()).hexdigest()
    broken = {label for (_, _, label), e in zip(rows, error) if e >= 1 << 63} | {k for k, e in whole.items() if e >= 1 << 63}
    return sorted(((str(i), "".join(f"{k:02x}" for _, k in f), e if e < 1 << 63 else None, None if label in broken else whole[label], sha)
                   for (_, i, label), f, e in zip(rows, found, error)), key=str)


@pytest.mark.parametrize("width, rows, scale", [(16, 300, 1.0), (20, 60, 1.0), (8, 10, 1.0), (24, 40, 1e6), (5, 30, 3e7)])
def test_codes_equal_brute_force(spark, width, rows, scale):
    table, made = awkward(spark, width, rows, scale)
    rows = vector_codes.compress(table).collect()
    got = sorted(((str(r.vec_id), r.code, r.error, r.label_error, r.codebooks_sha256) for r in rows), key=str)
    assert got == brute_codes(made)


def test_codes_of_nothing_and_back(spark):
    table, made = awkward(spark, 16, 40)
    assert vector_codes.compress(table.where("false")).collect() == []
    rows = vectors.usable(table, vector_codes.FACTOR, "vec_id", "embedding", "label")
    books = vector_codes.train(rows)
    coded = vector_codes.encode(rows, books, "label")
    near = {str(r.vec_id): (r.error, r.vector) for r in vector_codes.decode(coded, books).collect()}
    for i, v, _ in made[:40]:
        if i not in (5, 7):
            error, back = near[str(i)]
            whole = [int(np.floor(4096 * x)) for x in v]
            assert error == sum((a - int(b * 4096)) ** 2 for a, b in zip(whole, back))


def test_transform_is_orthogonal_and_ordered_by_sign_changes():
    for size in (1, 2, 8, 32):
        table = vector_codes.transform(np.eye(size, dtype=np.int64)).T
        assert [(np.diff(r) != 0).sum() for r in table] == list(range(size))
        assert (table @ table.T == size * np.eye(size)).all()


def test_ties_go_to_the_lower_entry():
    part = vector_codes.transform(np.array([[0, 0], [2, 0], [1, 1]]))
    entries = vector_codes.transform(np.array([[1, 0], [1, 0], [0, 1], [-1, 0]]))
    assert [a.tolist() for a in vector_codes.nearest(part, entries)] == [[0, 0, 0], [1, 1, 1]]


@pytest.mark.parametrize("width, rows, scale", [(16, 300, 1.0), (64, 20, 1.0), (3, 50, 1e9)])
def test_whitening_equals_dense_algebra(spark, width, rows, scale):
    table, made = awkward(spark, width, rows, scale)
    x = [[int(np.floor(64 * c)) + 1_000_000 for c in v] for _, v, _ in made]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    y = np.array([[float((n * a - s) / n) for a, s in zip(r, sums)] for r in x])
    cov = y.T @ y / n
    values, axes = np.linalg.eigh(cov)
    values, axes = values[::-1], axes[:, ::-1]
    kept = min(32, width, n - 4)  # three rows are repeated
    want = y @ axes[:, :kept] / np.sqrt(values[:kept])
    found = {}
    for r in whitening.whiten(table).collect():
        found.setdefault((str(r.vec_id), r.deviation), {})[r.component] = r
    deviation = [sum((n * a - s) ** 2 for a, s in zip(r, sums)) for r in x]
    deviation = [d if d < 1 << 63 else None for d in deviation]
    assert set(found) == {(str(i), d) for (i, _, _), d in zip(made, deviation)}
    sign = None
    for (i, _, _), d, row in zip(made, deviation, want):
        if str(i) in ("5", "7"):
            continue
        own = found[(str(i), d)]
        assert sorted(own) == list(range(1, kept + 1))
        got = np.array([own[c].whitened for c in sorted(own)])
        sign = np.sign(got * row) if sign is None else sign
        assert np.allclose(got, row * sign, atol=1e-7)
        assert all(r.n == n and r.identity_error < 1e-9 for r in own.values())
        assert np.allclose([own[c].explained for c in sorted(own)], values[:kept] / np.trace(cov))


def test_whitening_of_nothing_and_of_equal_vectors(spark):
    table, _ = awkward(spark, 8, 10)
    assert whitening.whiten(table.where("false")).collect() == []
    assert whitening.whiten(table.where("vec_id = 900")).collect() == []
    assert whitening.whiten(table.where("vec_id in (5, 900)")).collect() == []


@pytest.mark.parametrize("values", [[7.0] * 3 + list(range(6, 0, -1)), [5.0] * 10 + [1.0] * 30 + [0.0] * 24,
                                    list(1 + 1e-7 * np.arange(64)), [1.0], list(10.0 ** -np.arange(10))])
def test_no_eigenvalue_is_missed(values):
    values = np.sort(np.array(values))[::-1]
    turn = np.linalg.qr(np.random.default_rng(2).normal(size=2 * (len(values),)))[0]
    table = (turn * values) @ turn.T
    found, axes = whitening.principal((table + table.T) / 2)
    want = values[:32][values[:32] > 0]
    assert np.allclose(found, want, rtol=0, atol=1e-13)
    assert np.allclose(axes.T @ axes, np.eye(len(want)), atol=1e-13)
    assert np.abs(table @ axes - axes * found).max() < 1e-13


def test_inertia_counts():
    table = np.random.default_rng(6).normal(size=(30, 30))
    table += table.T
    values = np.linalg.eigvalsh(table)
    parts = whitening.tridiagonal(table)
    for shift in np.linspace(values[0] - 1, values[-1] + 1, 50):
        assert whitening.above(*parts, shift) == (values > shift).sum()


@pytest.mark.parametrize("name", ["op11_whitening", "op13_byte_level_bpe"])
def test_queries_return_a_row_per_row(spark, sf_dir, name):
    got = queries.QUERIES[name](spark, sf_dir)
    table = spark.read.parquet(f"{sf_dir}/{'documents' if name.startswith('op13') else 'embeddings'}.parquet")
    assert got.count() == table.count() * (32 if name.startswith("op11") else 1)
    if name.startswith("op13"):
        same = got.join(table, "doc_id").where(F.col("decoded_sha256") == F.sha2(F.col("text").cast("binary"), 256))
        assert same.count() == table.count()
