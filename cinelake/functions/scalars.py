"""Scalar expressions over dates, ratings and delimited text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from cinelake import constants as K


def calendar_year(value: Column | str) -> Column:
    """Year of a date or of date text; null where the text is no date."""
    source = F.col(value) if isinstance(value, str) else value
    return F.year(source.try_cast("date"))


def month_label(value: Column | str) -> Column:
    """``YYYY-MM`` of a date."""
    return F.date_format(value, "yyyy-MM")


def rating_floor(rating: Column | str) -> Column:
    return F.floor(rating).cast("int")


def rating_label(floor: Column) -> Column:
    """``"7-8"`` for 7; anything outside the labelled range, a full 10 included, is unknown."""
    low, high = K.RATING_FLOOR_RANGE
    label = F.concat_ws("-", floor.cast("string"), (floor + 1).cast("string"))
    return F.when(floor.between(low, high), label).otherwise(F.lit(K.UNKNOWN_RATING))


def split_tags(text: Column | str, trim: bool = False) -> Column:
    """Comma list to array; the missing-text marker gives no tags.

    Blanks around a tag are part of it unless ``trim`` is set, and empty text is one empty tag.
    """
    source = F.col(text) if isinstance(text, str) else text
    tags = F.split(source, ",")
    if trim:
        tags = F.transform(tags, lambda tag: F.trim(tag))
    none = F.array().cast("array<string>")
    return F.when(source == K.MISSING_TEXT, none).otherwise(tags)


def list_literal(text: Column | str) -> Column:
    """Text such as ``[28, 12]`` to an array of numbers; everything else to an empty array."""
    source = F.col(text) if isinstance(text, str) else text
    whole = F.when(source.rlike(r"^\s*\[[^\[\]]*\]\s*$"), source)
    return F.coalesce(F.from_json(whole, "array<bigint>"), F.array().cast("array<bigint>"))


def binary_to_text(df: DataFrame) -> DataFrame:
    """Decode every binary column as UTF-8 and leave the others as they are."""
    return df.select(*(
        F.decode(F.col(f.name), "UTF-8").alias(f.name)
        if isinstance(f.dataType, BinaryType) else F.col(f.name)
        for f in df.schema))


def interleaved(*columns: tuple[Column, float, float], bits: int = 8) -> Column:
    """Bits of where each ``(value, low, high)`` lies in its range, taken in turn, the highest first.

    Rows with near values have near numbers in most places, whatever the column. Values outside a
    range count as its ends, and nulls as the lowest.
    """
    steps = (1 << bits) - 1
    cells = []
    for value, low, high in columns:
        share = (value.cast("double") - F.lit(float(low))) / F.lit(float(high - low))
        cells.append(F.coalesce(F.floor(F.greatest(F.lit(0.0), F.least(F.lit(1.0), share)) * steps), F.lit(0)).cast("long"))
    place = F.lit(0).cast("long")
    for bit in range(bits):
        for k, cell in enumerate(cells):
            one = F.shiftright(cell, bit).bitwiseAND(F.lit(1))
            place = place.bitwiseOR(F.shiftleft(one, bit * len(cells) + len(cells) - 1 - k))
    return place
