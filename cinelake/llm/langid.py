"""Language of web pages by Bayesian evidence fusion.

Four kinds of evidence are added as logarithms: the text under a character model per language, the
language the markup declares, the address suffix, and the host. What a declaration or an address
says is learnt from the pages themselves by grouped aggregation of the texts' votes; a host's
counts are smoothed towards its domain, the domain's towards its suffix, and that towards all
pages. A page's own vote is left out of its priors.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zlib
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cinelake.llm.store import stored
from cinelake.llm.text import batches, inputs, table_rows

BUCKETS = 1 << 15
#: Labelled texts the character model is fitted on at most, by the hash of their id.
TRAINING_ROWS = 6000
#: Trigrams of a page that count as independent evidence at most; more only sharpen their mean.
INDEPENDENT = 60
#: Weight of the level above in smoothing, in pages.
SMOOTHING = 4.0
RAW = re.compile(r"(script|style)\b", re.I)
CLOSING = {name: re.compile(rf"</{name}\s*>", re.I) for name in ("script", "style")}
DECLARED = re.compile(r"<html\b[^>]*?\blang\s*=\s*[\"']?\s*([A-Za-z]+)", re.I)
HOST = re.compile(r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", re.I)


class Trigrams(dict):
    """Buckets of the character trigrams of a lower-cased word."""

    def __missing__(self, word: str) -> list[int]:
        if len(self) >= 200_000:
            self.clear()
        padded = f" {word} "
        value = self[word] = [zlib.crc32(padded[i:i + 3].encode("utf-8", "surrogatepass")) % BUCKETS for i in range(len(padded) - 2)]
        return value


def visible(markup: str | None) -> str:
    """The text of a page with a blank for every tag, comment, script and style sheet.

    One scan: what has no end anywhere behind is looked for once. A comment, script or style sheet
    without end hides its opening mark alone, and a mark that is never closed is text.
    """
    if not markup:
        return ""
    out, at, endless = [], 0, set()

    def end(name: str, find) -> int:
        place = -1 if name in endless else find()
        if place < 0:
            endless.add(name)
        return place

    while True:
        begin = markup.find("<", at)
        if begin < 0 or (shut := end(">", lambda: markup.find(">", begin))) < 0:
            out.append(markup[at:])
            return "".join(out)
        out.append(markup[at:begin])
        out.append(" ")
        past = shut + 1
        if raw := RAW.match(markup, begin + 1):
            name = raw[1].lower()
            found = None if name in endless else CLOSING[name].search(markup, past)
            past = past if end(name, lambda: found.end() if found else -1) < 0 else found.end()
        elif markup.startswith("!--", begin + 1) and (place := end("-->", lambda: markup.find("-->", begin + 4))) >= 0:
            past = place + 3
        at = past


def trigram_counts(text: str | None, cache: Trigrams) -> np.ndarray:
    found = [b for w in (text or "").lower().split() for b in cache[w]]
    return np.array(found, dtype=np.int64)


def train(texts: DataFrame, id: str = "doc_id", text: str = "text", lang: str = "lang", training_rows: int = TRAINING_ROWS,
          ) -> tuple[list[str], np.ndarray]:
    """Languages, and the logarithm of each bucket's rate per language."""
    wanted = inputs(texts, id=id, text=text, lang=lang).where("text is not null and lang is not null")
    chosen = wanted.orderBy(F.xxhash64("id"), "id").select("id", "lang").limit(training_rows).distinct()
    sample = wanted.join(F.broadcast(chosen), ["id", "lang"])
    out = pa.schema([("lang", pa.string()), ("counts", pa.binary())])

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, held = Trigrams(), {}
        for language, body in table_rows(parts, "lang", "text"):
            total = held.setdefault(language, np.zeros(BUCKETS))
            found = trigram_counts(body, cache)
            total += np.bincount(found, minlength=BUCKETS) / max(len(found), 1)
        return batches(((k, v.tobytes()) for k, v in held.items()), out, lambda row: len(row[1]))

    sums: dict[str, np.ndarray] = {}
    for r in sample.select("lang", "text").mapInArrow(count, "lang string, counts binary").toLocalIterator():
        sums[r.lang] = sums.get(r.lang, np.zeros(BUCKETS)) + np.frombuffer(bytes(r.counts))
    names = sorted(sums) or ["und"]
    rates = np.array([sums.get(n, np.zeros(BUCKETS)) for n in names])
    rates = rates / np.maximum(rates.sum(axis=1, keepdims=True), 1e-9) + 1e-6
    return names, np.log(rates / rates.sum(axis=1, keepdims=True))


def evidence(pages: DataFrame, names: list[str], rates: np.ndarray, id: str, url: str, html: str) -> DataFrame:
    """Per page: logarithms of the text likelihoods, its vote, and the keys of the other evidence."""
    shared = pages.sparkSession.sparkContext.broadcast(rates)
    out = pa.schema([("page_id", pa.int64()), ("host", pa.string()), ("domain", pa.string()), ("suffix", pa.string()),
                     ("declared", pa.string()), ("logs", pa.list_(pa.float64())), ("vote", pa.int32())])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = Trigrams()

        def rows():
            for key, address, markup in table_rows(parts, "id", "url", "html"):
                found = trigram_counts(visible(markup), cache)
                logs = np.zeros(len(names))
                if len(found):
                    logs = shared.value[:, found].mean(axis=1) * min(len(found), INDEPENDENT)
                    logs -= logs.max()
                match = HOST.match(address or "")
                host = match[1].lower().rstrip(".") if match else ""
                labels = host.split(".")
                said = DECLARED.search(markup or "")
                yield (key, host, ".".join(labels[-2:]), labels[-1], said[1].lower() if said else "",
                       logs.tolist(), int(logs.argmax()) if len(found) else None)

        return batches(rows(), out, lambda row: 300)

    return inputs(pages, id=id, url=url, html=html).withColumn("id", F.col("id").cast("long")).mapInArrow(
        run, "page_id long, host string, domain string, suffix string, declared string, logs array<double>, vote int")


def identify(pages: DataFrame, texts: DataFrame, id: str = "page_id", url: str = "url", html: str = "html",
             training_rows: int = TRAINING_ROWS) -> DataFrame:
    """``page_id``, ``lang``, ``probability``, ``text_lang`` and ``declared``, one row per row of ``pages``.

    A null page or one without visible text casts no vote and is judged by the other evidence; a
    missing or odd address has the empty host. Without any labelled text there is the one language
    "und". Ties go to the first language in order of name. Repeated rows give a row each.
    """
    names, rates = train(texts, training_rows=training_rows)
    seen = stored(evidence(pages, names, rates, id, url, html), "pages")
    size = len(names)
    votes = lambda: F.array(*(F.count_if(F.col("vote") == k).cast("double") for k in range(size)))
    df = seen
    for level in ("host", "domain", "suffix", "declared"):
        df = df.join(seen.groupBy(level).agg(votes().alias(f"n_{level}")), level)
    everywhere = seen.agg(votes().alias("n")).first().n

    def others(counts: Column) -> Column:
        return F.transform(counts, lambda c, k: c - F.when(F.col("vote") == k, 1.0).otherwise(0.0))

    def smoothed(counts: Column, above: Column) -> Column:
        total = F.aggregate(counts, F.lit(0.0), lambda a, x: a + x)
        return F.zip_with(counts, above, lambda c, p: (c + SMOOTHING * p) / (total + SMOOTHING))

    whole = sum(everywhere) + size
    prior = F.array(*(F.lit((n + 1.0) / whole) for n in everywhere))
    df = df.withColumn("prior", prior)
    for level in ("suffix", "domain", "host"):
        df = df.withColumn("prior", smoothed(others(F.col(f"n_{level}")), F.col("prior")))
    # What a declaration says beyond the overall rates; pages that declare nothing say nothing.
    said = F.zip_with(smoothed(others(F.col("n_declared")), prior), prior, lambda p, q: F.log(p / q))
    df = df.withColumn("said", F.when(F.col("declared") != "", said).otherwise(F.array_repeat(F.lit(0.0), size)))
    df = df.withColumn("total", F.zip_with(F.zip_with("logs", F.transform("prior", lambda p: F.log(p)), lambda a, b: a + b), "said", lambda a, b: a + b))
    df = df.withColumn("top", F.array_max("total"))
    best = F.array_position(F.col("total"), F.col("top")).cast("int")
    known = F.array(*(F.lit(n) for n in names))
    return df.select(
        "page_id", F.get(known, best - 1).alias("lang"),
        (1 / F.aggregate("total", F.lit(0.0), lambda a, x: a + F.exp(x - F.col("top")))).alias("probability"),
        F.get(known, F.col("vote")).alias("text_lang"), "declared")
