"""Exact token counts at every prefix of a text.

The last piece of a prefix's encoding decides the rest: dropping it leaves the encoding of a
shorter prefix. So ``count[i] = count[i - len(p)] + 1`` for the one piece ``p`` that ends at ``i``
and fits the last piece of the prefix before it. The table answers any truncation or budget question without encoding
again. A text falls into units that no piece reaches over; the table of a unit is computed once and
reused wherever the unit occurs.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cinelake.llm import bpe
from cinelake.llm.text import batches, inputs, lots, table_rows

#: Units a worker remembers.
CACHED_UNITS = 500_000
#: Characters of text a task looks at together, one text at least.
LOT_CHARACTERS = 4 << 20


class UnitTable:
    """Token count of every prefix of a unit. A unit that begins like the one before reuses its entries."""

    def __init__(self, vocabulary: bpe.Pieces):
        self.vocabulary, self.unit = vocabulary, ""
        self.count, self.after = [0], [vocabulary.followers("")]

    def of(self, unit: str) -> list[int]:
        """The table, the empty prefix first. It changes with the next call."""
        ids, lengths, anywhere = self.vocabulary.id, self.vocabulary.lengths.get, (2, 1)
        followers, count, after, old = self.vocabulary.followers, self.count, self.after, self.unit
        same, most = 0, min(len(old), len(unit))
        while same < most and old[same] == unit[same]:
            same += 1
        del count[same + 1:], after[same + 1:]  # after: what may follow the last piece of each prefix
        for end in range(same + 1, len(unit) + 1):
            for size in lengths(unit[end - 3 if end > 3 else 0:end], anywhere):
                if size <= end:
                    piece = unit[end - size:end]
                    if piece in ids and after[end - size][piece]:
                        count.append(count[end - size] + 1)
                        after.append(followers(piece))
                        break
            else:
                # An unknown character becomes its bytes and takes part in no merge.
                count.append(count[-1] + len(unit[end - 1].encode("utf-8", "surrogatepass")))
                after.append(after[0])
        self.unit = unit
        return count


class UnitCounts(dict):
    """Token counts of whole units. Units are best made known in sorted lots, which share beginnings."""

    def __init__(self, vocabulary: bpe.Pieces):
        super().__init__()
        self.table = UnitTable(vocabulary)

    def learn(self, units: set[str]) -> None:
        if len(self) >= CACHED_UNITS:
            self.clear()
        of = self.table.of
        for unit in sorted(units.difference(self)):
            if len(unit) <= bpe.CACHED_LENGTH:
                self[unit] = of(bpe.marked(unit))[-1]

    def __missing__(self, unit: str) -> int:
        return self.table.of(bpe.marked(unit))[-1]


def longest_prefix(text: str | None, limit: int, counts: UnitCounts) -> int:
    """Characters of the longest prefix with at most ``limit`` tokens."""
    total, at, best = 0, -1, 0  # the leading blank is no character of the text
    for unit in bpe.units(text):
        if total >= limit:
            break
        whole = total + counts[unit]
        if whole <= limit:
            best = at + len(bpe.marked(unit))
        else:
            table = counts.table.of(bpe.marked(unit))
            best = max([best, *(at + k for k in range(1, len(table)) if total + table[k] <= limit)])
        total, at = whole, at + len(bpe.marked(unit))
    return max(best, 0)


def text_prefixes(text: str | None, unit_table: UnitTable) -> list[int]:
    """Token count of every prefix of a text, the empty one first."""
    out = [0]
    if text:
        total = 0
        for unit in bpe.units(text):
            table = unit_table.of(bpe.marked(unit))
            out.extend(total + c for c in table[1:])
            total += table[-1]
        del out[1]  # the leading blank alone is no prefix of the text
    return out


def count_tokens(docs: DataFrame, model: str, limit: int = 4096, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Bytes, tokens and the longest prefix within ``limit`` tokens, one row per row of ``docs``.

    ``model`` is the path of a SentencePiece byte-pair model on every machine. A null text counts
    as empty: no bytes, no tokens. Repeated rows and null ids give a row each; an empty table gives
    none. A text of any length is processed unit by unit; nothing is shuffled.
    """
    out = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64()),
                     ("over_limit", pa.bool_()), ("limit_chars", pa.int64())])

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = UnitCounts(bpe.pieces(model))

        def rows():
            for lot in lots(table_rows(parts, "id", "text"), LOT_CHARACTERS):
                found = [bpe.units(body) for _, body in lot]
                counts.learn(set().union(*found))
                for (key, body), own in zip(lot, found):
                    n = sum(map(counts.__getitem__, own))
                    over = n > limit
                    yield (key, len(body.encode("utf-8", "surrogatepass")) if body else 0, n, over,
                           longest_prefix(body, limit, counts) if over else len(body or ""))

        return batches(rows(), out)

    return inputs(docs, id=id, text=text).withColumn("id", F.col("id").cast("long")).mapInArrow(
        count, "doc_id long, n_bytes long, n_tokens long, over_limit boolean, limit_chars long")


def prefix_counts(docs: DataFrame, model: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The whole table per row of ``docs``: ``counts[i]`` tokens in the first ``i`` characters.

    A null or empty text has the single entry 0. Keep it where many budgets are asked of one text.
    """
    out = pa.schema([("doc_id", pa.int64()), ("counts", pa.list_(pa.int32()))])

    def tabulate(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = UnitTable(bpe.pieces(model))
        rows = ((key, text_prefixes(body, table)) for key, body in table_rows(parts, "id", "text"))
        return batches(rows, out, lambda row: 8 * len(row[1]))

    return inputs(docs, id=id, text=text).withColumn("id", F.col("id").cast("long")).mapInArrow(
        tabulate, "doc_id long, counts array<int>")


def tokens_within(counts: Column, characters: Column | int) -> Column:
    """Tokens of a prefix, from a stored table."""
    size = F.lit(characters) if isinstance(characters, int) else characters
    return F.element_at(counts, (F.least(size, F.size(counts) - 1) + 1).cast("int"))


def characters_within(counts: Column, budget: Column | int) -> Column:
    """Characters of the longest prefix within a budget, from a stored table."""
    limit = F.lit(budget) if isinstance(budget, int) else budget
    return F.array_max(F.transform(counts, lambda c, i: F.when(c <= limit, i)))
