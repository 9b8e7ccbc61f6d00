"""Arithmetic on ``array<double>`` vectors of any length.

One expression serves every length, so a result never depends on a promised width. Vectors of
different lengths cannot be multiplied: that is an error, not a null or a prefix.

``width`` names the length most vectors have. Those are worked out element by element in compiled code, in
the same order; any other takes the expression for every length.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def elements(vector: Column, width: int) -> list[Column]:
    """The first ``width`` elements, null beyond the end."""
    return [F.get(vector, F.lit(i)) for i in range(width)]


#: Longest vector that is written out; longer ones would make too much code.
WRITTEN_OUT = 64


def _by_width(width: int | None, vectors: list[Column], written_out, general: Column) -> Column:
    """``written_out`` of the elements where all ``vectors`` are ``width`` long, else ``general``."""
    if width is None or width > WRITTEN_OUT:
        return general
    fits = reduce(lambda a, b: a & b, (F.size(v) == width for v in vectors))
    return F.when(fits, written_out(*(elements(v, width) for v in vectors))).otherwise(general)


def _sum_of_products(left: list[Column], right: list[Column]) -> Column:
    return reduce(lambda total, pair: total + pair[0] * pair[1], zip(left, right, strict=True), F.lit(0.0))


def product(left: Column, right: Column) -> Column:
    """Element by element."""
    return F.zip_with(left, right, lambda a, b: a * b)


def dot(left: Column, right: Column, width: int | None = None) -> Column:
    """Sum of products; null if a vector is null, an error if the lengths differ."""
    total = F.aggregate(product(left, right), F.lit(0.0), lambda total, x: total + x)
    differ = F.concat(
        F.lit("vectors of lengths "), F.size(left).cast("string"), F.lit(" and "), F.size(right).cast("string"))
    checked = F.when(F.size(left) != F.size(right), F.raise_error(differ).cast("double")).otherwise(total)
    return _by_width(width, [left, right], _sum_of_products, checked)


def norm(vector: Column, width: int | None = None) -> Column:
    squares = F.aggregate(vector, F.lit(0.0), lambda total, x: total + x * x)
    return F.sqrt(_by_width(width, [vector], lambda v: _sum_of_products(v, v), squares))


def unit(vector: Column) -> Column:
    """The vector at length 1; a zero vector stays as it is."""
    length = norm(vector)
    return F.when(length > 0, F.transform(vector, lambda x: x / length)).otherwise(vector)


def cosine(vector: Column, direction: Column, width: int | None = None) -> Column:
    """Cosine of a vector and a unit vector as double; 0.0 for a zero vector on either side."""
    length = norm(vector, width)
    return F.when(length > 0, dot(vector, direction, width) / length).otherwise(F.lit(0.0))
