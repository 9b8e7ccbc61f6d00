"""Feature vectors: scaled numbers followed by TF-IDF of hashed tags.

All years are fitted in one job. A narrow aggregate, combined on the map side, yields one row of
statistics per year, which meets the films of its year without moving them; every film is turned
into its vector by plain column arithmetic.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cinelake import constants as K
from cinelake.functions import calendar_year, elements, product, split_tags
from cinelake.operators.clean import per_year
from cinelake.schemas import MOVIES_FEATURES, MY_FEATURES, YEAR_COLUMN

INPUTS = "inputs"
FACTORS = "factors"


@dataclass(frozen=True)
class VectorSpec:
    """How vectors are built. The defaults give the established results.

    ``slots``: number of hash slots for tags.
    ``weights``: weight of each number, in vector order.
    ``weights_after_scaling``: apply the weights to the scaled numbers; before scaling they
    cancel out, because the deviation they are divided by carries the same factor.
    """

    slots: int = K.TAG_SLOTS
    weights: dict[str, float] = field(default_factory=lambda: dict(K.FEATURE_WEIGHTS))
    weights_after_scaling: bool = False

    @property
    def width(self) -> int:
        return len(self.weights) + self.slots

    @property
    def input_weights(self) -> dict[str, float]:
        """Weight of each number before it is scaled."""
        return {n: 1.0 for n in self.weights} if self.weights_after_scaling else self.weights


DEFAULT = VectorSpec()


def film_features(cleaned: DataFrame, trim_tags: bool = False) -> DataFrame:
    """Feature columns of the catalogue, tags split into an array."""
    kept = [YEAR_COLUMN] if YEAR_COLUMN in cleaned.columns else []
    return cleaned.select(
        *(split_tags("genres", trim_tags).alias(c) if c == "genres" else c
          for c in MOVIES_FEATURES.fieldNames()), *kept)


def favourite_features(track: DataFrame) -> DataFrame:
    """Feature columns of the favourites."""
    return track.select(*MY_FEATURES.fieldNames())


def _with_year(features: DataFrame) -> DataFrame:
    if YEAR_COLUMN in features.columns:
        return features
    return features.withColumn(YEAR_COLUMN, calendar_year("release_date"))


def _is_complete(spec: VectorSpec) -> Column:
    complete = F.col("genres").isNotNull()
    for name in spec.weights:
        value = F.col(name).cast("double")
        complete = complete & value.isNotNull() & ~F.isnan(value)
    return complete


def incomplete_films(features: DataFrame, spec: VectorSpec = DEFAULT) -> DataFrame:
    """Per year, how many films there are and how many lack a number or their tags."""
    return _with_year(features).groupBy(YEAR_COLUMN).agg(
        F.count(F.lit(1)).alias("films"),
        F.count_if(~_is_complete(spec)).alias("incomplete"))


def complete_films(features: DataFrame, spec: VectorSpec = DEFAULT) -> DataFrame:
    """Films that have all numbers and tags, with their release year."""
    return _with_year(features).where(_is_complete(spec))


def hashed_features(features: DataFrame, spec: VectorSpec = DEFAULT) -> DataFrame:
    """Complete films as ``(id, release_year, inputs)``.

    ``inputs`` is one array: the weighted numbers, then the tag count of every slot.
    """
    hasher = HashingTF(numFeatures=spec.slots, inputCol="genres", outputCol="_tf")
    numbers = F.array(*(F.col(n).cast("double") * F.lit(w) for n, w in spec.input_weights.items()))
    return hasher.transform(complete_films(features, spec)).select(
        "id", YEAR_COLUMN, F.concat(numbers, vector_to_array("_tf")).alias(INPUTS))


def _inverse_frequency(n: Column, films_with: Column) -> Column:
    return F.log((n + 1) / (films_with + 1))


def _scale(number: Column, weight: float) -> Column:
    """Factor that brings a number to unit sample deviation, or 0.0 when it is constant.

    A merged deviation of a constant is not reliably zero, so constants are told by their range.
    """
    spread = F.stddev_samp(number)
    constant = (F.min(number) == F.max(number)) | (spread == 0)
    return F.when(constant, F.lit(0.0)).otherwise(F.lit(weight) / spread)


def _statistics(spec: VectorSpec) -> list[Column]:
    """Aggregates over hashed films: their number and one factor per input."""
    n = F.count(F.lit(1))
    weights = spec.weights.values() if spec.weights_after_scaling else [1.0] * len(spec.weights)
    inputs = elements(F.col(INPUTS), spec.width)
    numbers, counts = inputs[:len(spec.weights)], inputs[len(spec.weights):]
    factors = [_scale(x, w) for x, w in zip(numbers, weights, strict=True)]
    factors += [_inverse_frequency(n, F.count_if(x > 0)) for x in counts]
    return [n.alias("films"), F.array(*factors).alias(FACTORS)]


def fit(hashed: DataFrame, by: str | None = YEAR_COLUMN, spec: VectorSpec = DEFAULT) -> DataFrame:
    """Statistics ``(films, factors)``: one row per ``by`` group, or one over all films.

    ``factors`` holds the scale of every number, then the inverse document frequency of every
    slot. No films give no rows.
    """
    if by is None:
        return hashed.agg(*_statistics(spec)).where("films > 0")
    return hashed.groupBy(by).agg(*_statistics(spec))


def transform(
    hashed: DataFrame, stats: DataFrame, by: str | None = YEAR_COLUMN,
    output: str = "movie_vector", width: int = DEFAULT.width,
) -> DataFrame:
    """``(id, release_year, vector)``: inputs times the factors, ``width`` of them, of their group."""
    if by is None:
        fitted = hashed.withColumn(FACTORS, stats.select(FACTORS).scalar())
        fitted = fitted.where(F.col(FACTORS).isNotNull())
    else:
        fitted = hashed.join(per_year(stats.select(by, FACTORS), by, width), by)
    return fitted.select(
        "id", YEAR_COLUMN, product(F.col(INPUTS), F.col(FACTORS)).alias(output))


def fit_vectors(
    features: DataFrame, by: str | None = YEAR_COLUMN, spec: VectorSpec = DEFAULT,
    output: str = "movie_vector",
) -> DataFrame:
    """Vectors of all complete films, fitted within ``by`` (``None``: over all films at once)."""
    hashed = hashed_features(features, spec)
    return transform(hashed, fit(hashed, by, spec), by, output, spec.width)


def _means(column: str, width: int) -> Column:
    return F.array(*(F.avg(x) for x in elements(F.col(column), width)))


def mean_vector(vectors: DataFrame, column: str, width: int) -> DataFrame:
    """Element-wise mean as one row ``user_vector``; no vectors give no row."""
    return (
        vectors.agg(_means(column, width).alias("user_vector"), F.count(F.lit(1)).alias("_n"))
        .where("_n > 0").select("user_vector"))


def user_profile(features: DataFrame, spec: VectorSpec = DEFAULT) -> DataFrame:
    """Mean of the favourites' vectors, fitted on the favourites: one row ``user_vector``.

    Every element of a vector is an input times a fitted factor, so the mean vector is the mean
    input times that factor, and fitting and averaging are one aggregate over one pass.
    """
    means = _means(INPUTS, spec.width).alias("_means")
    fitted = hashed_features(features, spec).agg(*_statistics(spec), means).where("films > 0")
    return fitted.select(product(F.col("_means"), F.col(FACTORS)).alias("user_vector"))


def profile_in_catalogue_space(
    favourites: DataFrame, catalogue: DataFrame, spec: VectorSpec = DEFAULT,
) -> DataFrame:
    """Mean of the favourites' vectors under statistics fitted on the whole catalogue."""
    stats = fit(hashed_features(catalogue, spec), None, spec)
    vectors = transform(hashed_features(favourites, spec), stats, None)
    return mean_vector(vectors, "movie_vector", spec.width)
