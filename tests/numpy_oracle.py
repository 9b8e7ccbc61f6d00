"""Vectors and cosine of a handful of films by plain array arithmetic; a second oracle."""

from functools import lru_cache

import numpy as np
from pyspark.ml.feature import HashingTF

from cinelake.constants import FEATURE_WEIGHTS, TAG_SLOTS


@lru_cache
def slot_of(tag, slots=TAG_SLOTS):
    return HashingTF(numFeatures=slots).indexOf(tag)


def vectors_of(films, weights=FEATURE_WEIGHTS, slots=TAG_SLOTS):
    """``{id: vector}`` of complete films, fitted on all of them."""
    rows = films.select("id", "genres", *weights).collect()
    numbers = np.array([[r[name] for name in weights] for r in rows], dtype=float) * list(weights.values())
    scaled = np.zeros_like(numbers)
    varies = np.ptp(numbers, axis=0) > 0
    if varies.any():
        scaled[:, varies] = numbers[:, varies] / numbers[:, varies].std(axis=0, ddof=1)
    counts = np.zeros((len(rows), slots))
    for k, row in enumerate(rows):
        for tag in row["genres"]:
            counts[k, slot_of(tag, slots)] += 1
    frequency = np.count_nonzero(counts, axis=0)
    inverse = np.log((len(rows) + 1) / (frequency + 1))
    return {r["id"]: np.concatenate(parts) for r, *parts in zip(rows, scaled, counts * inverse)}


def numpy_cosine(user, film):
    lengths = np.linalg.norm(user) * np.linalg.norm(film)
    return float(np.dot(user, film) / lengths) if lengths else 0.0
