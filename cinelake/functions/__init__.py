"""Column expressions; all of them run inside the JVM."""

from cinelake.functions.scalars import (
    binary_to_text, calendar_year, interleaved, list_literal, month_label, rating_floor, rating_label,
    split_tags,
)
from cinelake.functions.vectors import cosine, dot, elements, norm, product, unit

__all__ = [
    "binary_to_text", "calendar_year", "cosine", "dot", "elements", "interleaved", "list_literal", "month_label", "norm",
    "product", "rating_floor", "rating_label", "split_tags", "unit",
]
