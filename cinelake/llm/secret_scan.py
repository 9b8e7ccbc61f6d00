"""Secret scans in DataFrame functions only: fixed patterns, and a battery of randomness tests.

Runs of characters that could encode a key are tested per inferred encoding: chi-squared
uniformity over the alphabet, the number of runs of character classes, and serial correlation of
neighbours. A candidate counts if it looks random, and if ordinary text of its length would hardly
look so: the tests' values under a text model give a p-value, which falls with length. The p-values
of all candidates of the table go through false-discovery control.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cinelake.llm.cascade import let

ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: Kinds in the order of their spans; pattern, and the group that must be long enough.
BASE = (("assign", ASSIGN, 2, 6), ("access", "AKIA[A-Z0-9]+", 0, 20), ("hex", "[0-9a-f]{24,}", 0, 24))
#: Runs of 20 and more characters of the widest alphabet that hold a digit.
CANDIDATE = r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*[0-9])[A-Za-z0-9+/_=-]{20,}"
RANDOM = "random"
#: Share of false discoveries allowed among the candidates reported.
FALSE_DISCOVERIES = 0.01
#: Limit of the standard scores within which a candidate still looks random.
RANDOM_Z = 4.0
#: The text model: chance that two characters agree, and that neighbours differ in class.
TEXT_AGREE = 0.07
TEXT_CHANGE = 0.12
#: Size of a bin of the logarithm of p-values; the correction works on bins of all candidates.
BIN = 0.25
#: Places, and code points, of one block of a long text.
BLOCK = 256
PIECE = 1024
#: Bins there are; the last holds all smaller p-values, which pass against any number of candidates.
BINS = 4096


def _blocks(count: Column) -> Column:
    """Number of blocks of ``BLOCK`` places."""
    return F.ceil(count / BLOCK).cast("int")


def _every(count: Column, of) -> Column:
    """An array of ``of(0)`` to ``of(count - 1)``."""
    some = F.sequence(F.lit(0), F.greatest(count - 1, F.lit(0)))
    return F.transform(F.slice(some, 1, count), of)


def running(values: Column, start: Column, add) -> Column:
    """For every place, ``add`` over ``start`` and all values before it, for associative ``add``.

    Arrays cannot grow without being copied, so places are added up per block, blocks among
    themselves, and each place within its block: work of 1.5 powers of the length, not two.
    """
    def from_blocks(values, blocks):
        return let(_every(F.size(blocks), lambda b: F.aggregate(F.slice(blocks, 1, b), start, add)), lambda before: F.transform(
            values, lambda _, k: F.aggregate(
                F.slice(values, k - k % BLOCK + 1, k % BLOCK), F.get(before, F.floor(k / BLOCK).cast("int")), add)))

    return let(values, lambda v: let(_every(_blocks(F.size(v)), lambda b: F.aggregate(
        F.slice(v, b * BLOCK + 1, F.lit(BLOCK)), start, add)), lambda blocks: from_blocks(v, blocks)))


def spans(text: Column, pattern: str, group: int, least: int, kind: int) -> Column:
    """(start, end, kind) of all matches, left to right, whose group has at least ``least`` characters.

    The pieces between the matches and the matches themselves add up to the places of the matches.
    """
    none = F.array().cast("array<struct<start:int,end:int,kind:int,part:string>>")

    def placed(found, gaps):
        lengths = F.zip_with(found, gaps, lambda m, gap: F.length(m["all"]) + F.length(gap))

        def of(found, before):
            return F.transform(found, lambda m, k: let(F.get(before, k) + F.length(F.get(gaps, k)), lambda begin: F.struct(
                begin.alias("start"), (begin + F.length(m["all"])).alias("end"), F.lit(kind).alias("kind"), m["part"].alias("part"))))

        return let(running(lengths, F.lit(0), lambda a, b: a + b), lambda before: of(found, before))

    found = F.arrays_zip(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("all"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("part"))
    every = let(found, lambda m: let(F.slice(F.split(text, pattern, -1), 1, F.size(m)), lambda gaps: placed(m, gaps)))
    return F.when(text.rlike(pattern), F.filter(every, lambda s: F.length(s.part) >= least)).otherwise(none)


def _log_tail(z: Column) -> Column:
    """Natural logarithm of the upper tail of the normal distribution, by the usual rational approximation.

    A number for every z: the tail itself is 0 in floating point beyond 38 standard deviations.
    """
    x = F.abs(z)
    t = 1 / (1 + 0.2316419 * x)
    poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    far = F.log(0.3989422804014327 * poly) - x * x / 2
    return F.when(z >= 0, far).otherwise(F.log(1 - F.exp(far)))


def tested(token: Column) -> Column:
    """(random, log_p): whether the token passes as random, and how likely text of its length looks like it.

    The probability is given as its decimal logarithm, since long tokens have less than the least double.
    """
    size = F.when(token.rlike("^[0-9a-f]+$|^[0-9A-F]+$"), 16.0).when(token.rlike("^[A-Z2-7]+$"), 32.0).otherwise(64.0)

    def of(chars, codes, mean, k):
        n = F.size(chars).cast("double")
        squares = F.aggregate(F.transform(F.array_distinct(chars), lambda d: F.size(F.filter(chars, lambda c: c == d)).cast("double")),
                              F.lit(0.0), lambda s, c: s + c * c)
        chi = k / n * squares - n
        kinds = F.transform(chars, lambda c: F.when(c.between("0", "9"), 1).when(c.between("a", "z"), 2).when(c.between("A", "Z"), 3).otherwise(4))
        changes = let(kinds, lambda own: F.aggregate(
            F.zip_with(own, F.slice(own, 2, F.greatest(F.size(own) - 1, F.lit(0))), lambda a, b: (a != b).cast("int")),
            F.lit(0.0), lambda s, x: s + F.coalesce(x, F.lit(0))))
        spread = F.aggregate(codes, F.lit(0.0), lambda s, x: s + (x - mean) * (x - mean))
        product = F.aggregate(F.zip_with(codes, F.slice(codes, 2, F.greatest(F.size(codes) - 1, F.lit(0))), lambda a, b: (a - mean) * (b - mean)),
                              F.lit(0.0), lambda s, x: s + F.coalesce(x, F.lit(0.0)))
        return let(F.struct(chi.alias("chi"), changes.alias("changes"), spread.alias("spread"), product.alias("product")),
                   lambda m: judged(n, k, m["chi"], m["changes"], m["spread"], m["product"]))

    def judged(n, k, chi, changes, spread, product):
        change = F.when(k == 16, 0.469).when(k == 32, 0.305).otherwise(0.635)
        uniform_z = (chi - (k - 1)) / F.sqrt(2 * (k - 1))
        runs_z = (changes - (n - 1) * change) / F.sqrt((n - 1) * change * (1 - change))
        serial_z = F.when(spread > 0, product / spread * F.sqrt(n)).otherwise(99.0)
        random = (uniform_z <= RANDOM_Z) & (F.abs(runs_z) <= RANDOM_Z) & (F.abs(serial_z) <= RANDOM_Z)
        skew = k * TEXT_AGREE - 1
        text_chi = (n * skew - (chi - (k - 1))) / F.sqrt(2 * (k - 1) + 4 * n * skew)
        text_runs = (changes - (n - 1) * TEXT_CHANGE) / F.sqrt((n - 1) * TEXT_CHANGE * (1 - TEXT_CHANGE))
        # Two p-values joined by Fisher's way: the product q has tail q * (1 - ln q).
        log_q = _log_tail(text_chi) + _log_tail(text_runs)
        return F.struct(random.alias("random"), ((log_q + F.log(1 - log_q)) / math.log(10)).alias("log_p"))

    def summed(codes):
        return F.aggregate(codes, F.lit(0.0), lambda s, x: s + x)

    # Each array is worked out once per token: its elements are looked at many times.
    return let(F.filter(F.split(token, ""), lambda c: c != ""), lambda chars: let(size, lambda k: let(
        F.transform(chars, lambda c: F.ascii(c).cast("double")), lambda codes: let(
            summed(codes) / F.size(chars), lambda mean: of(chars, codes, mean, k)))))


def _candidates(text: Column) -> Column:
    return F.transform(spans(text, CANDIDATE, 0, 20, len(BASE)), lambda s: F.struct(
        s.start.alias("start"), s.end.alias("end"), s.kind.alias("kind"), s.part.alias("part"), tested(s.part).alias("test")))


def threshold(docs: DataFrame, text: str = "text", rate: float = FALSE_DISCOVERIES) -> float:
    """Logarithm of the largest p-value that false-discovery control accepts over all candidates of the table.

    Minus infinity if it accepts none.

    Counts per bin of p-values are all that is gathered: at most ``BINS`` numbers whatever the data.
    """
    found = docs.select(F.explode(_candidates(F.coalesce(docs[text], F.lit("")))).alias("s")).select("s.test.*")
    bins = found.select(F.when(F.col("random"), F.least(F.greatest(F.floor(-F.col("log_p") / BIN), F.lit(0)), F.lit(BINS - 1))).otherwise(0).alias("bin")).groupBy("bin").count()
    counts = {r.bin: r["count"] for r in bins.collect()}
    total, rank, best = sum(counts.values()), 0, -math.inf
    for b in sorted(counts, reverse=True):
        rank += counts[b]
        if rank and -b * BIN <= math.log10(rate * rank / total):
            best = -b * BIN
    return best


def with_spans(docs: DataFrame, text: str, limit: float, base: str = "base", every: str = "spans") -> DataFrame:
    """Adds the base spans and all spans, each sorted by start and kind, as (start, end, kind)."""
    body = F.coalesce(F.col(text), F.lit(""))
    plain = lambda a: F.transform(a, lambda s: F.struct(s.start.alias("start"), s.kind.alias("kind"), s.end.alias("end")))
    fixed = F.sort_array(F.concat(*(plain(spans(body, p, g, n, k)) for k, (_, p, g, n) in enumerate(BASE))))
    more = plain(F.filter(_candidates(body), lambda s: s.test.random & (s.test.log_p <= limit)))
    return docs.withColumn(base, fixed).withColumn(every, F.sort_array(F.concat(F.col(base), more)))


def _written(array: Column) -> Column:
    names = F.array(*(F.lit(k) for k, *_ in BASE), F.lit(RANDOM))
    return F.array_join(F.transform(array, lambda s: F.concat_ws(":", F.get(names, s.kind), s.start.cast("string"), s.end.cast("string"))), ",")


def scan(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs`` with counts per kind, the digest of the base spans and all spans.

    Places count code points, the end exclusive. A null text counts as empty and has no spans.
    Repeated rows and null ids give a row each; an empty table gives none. Spans of different kinds may overlap.
    """
    limit = threshold(docs, text)
    df = with_spans(docs.select(docs[id].alias("doc_id"), docs[text].alias("_text")), "_text", limit, "_base", "_spans")
    count = lambda k: F.size(F.filter("_base", lambda s: s.kind == k)).cast("long")
    return df.select("doc_id", *(count(k).alias(f"n_{name}") for k, (name, *_) in enumerate(BASE)),
                     F.sha2(_written(F.col("_base")), 256).alias("base_sha256"), _written(F.col("_spans")).alias("spans"))


def redact(docs: DataFrame, text: str = "text", mark: str = "[secret]") -> DataFrame:
    """The rows of ``docs`` with every span, overlapping ones joined, replaced by a mark; nulls stay."""
    names = docs.columns
    limit = threshold(docs, text)
    own = f"c{names.index(text)}"
    df = with_spans(docs.toDF(*(f"c{k}" for k in range(len(names)))), own, limit, "_base", "_spans")
    clean = let(F.regexp_extract_all(F.col(own), F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0)), lambda pieces: _marked(pieces, F.col("_spans"), mark))
    return df.withColumn("_clean", F.when(F.size("_spans") > 0, clean).otherwise(F.col(own))).select(
        *(F.col("_clean" if name == text else f"c{k}").alias(name) for k, name in enumerate(names)))


def _marked(pieces: Column, spans: Column, mark: str) -> Column:
    """The text of ``pieces``, of ``PIECE`` code points each but the last, with marks for spans sorted by start.

    Every gap is cut from the pieces that it touches, so a long text is not walked through once per span.
    """
    def cut(begin: Column, end: Column | None) -> Column:
        first = F.floor(begin / PIECE).cast("int")
        count = F.size(pieces) - first if end is None else F.floor((end - 1) / PIECE).cast("int") - first + 1
        touched = F.array_join(F.slice(pieces, first + 1, F.greatest(count, F.lit(0))), "")
        return F.substring(touched, begin - first * PIECE + 1, F.length(touched) if end is None else end - begin)

    def joined(before: Column) -> Column:
        gaps = F.transform(spans, lambda s, k: F.when(s.start >= F.get(before, k), F.concat(
            F.when(s.start > F.get(before, k), cut(F.get(before, k), s.start)).otherwise(""), F.lit(mark))).otherwise(""))
        last = F.aggregate(spans, F.lit(0), lambda a, s: F.greatest(a, s.end))
        return let(last, lambda at: F.concat(F.array_join(gaps, ""), cut(at, None)))

    return let(running(F.transform(spans, lambda s: s.end), F.lit(0), lambda a, b: F.greatest(a, b)), joined)
