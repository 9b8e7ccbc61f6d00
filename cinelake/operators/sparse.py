"""Vectors in sparse form, for any number of hash slots, and fits that can be merged.

A film is a list of ``(dim, x)``: its weighted numbers, then the counts of the slots its tags fall
on. Statistics are one row per year and dimension that occurs, so their size follows the tags in
use and not the number of slots. They hold counts, means and squared deviations, from which the
statistics of any set of years follow without looking at a film again.
"""

from __future__ import annotations

from pyspark.ml.feature import HashingTF
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cinelake.functions import norm, unit
from cinelake.operators.features import DEFAULT, FACTORS, VectorSpec, complete_films
from cinelake.schemas import YEAR_COLUMN, VECTOR_STATISTICS

INDICES, VALUES = "indices", "values"


def sparse_inputs(features: DataFrame, spec: VectorSpec = DEFAULT) -> DataFrame:
    """Complete films as ``(id, release_year, inputs)``, the inputs as an array of ``(dim, x)``."""
    hasher = HashingTF(numFeatures=spec.slots, inputCol="genres", outputCol="_tf")
    hashed = hasher.transform(complete_films(features, spec)).withColumn("_tf", F.unwrap_udt("_tf"))
    weights = spec.input_weights
    numbers = F.array(*(
        _entry(F.lit(dim), F.col(name).cast("double") * weight) for dim, (name, weight) in enumerate(weights.items())))
    tags = F.zip_with("_tf.indices", "_tf.values", lambda slot, count: _entry(slot + len(weights), count))
    return hashed.select("id", YEAR_COLUMN, F.concat(numbers, tags).alias("inputs"))


def _entry(dim: Column, x: Column) -> Column:
    return F.struct(dim.cast("int").alias("dim"), x.cast("double").alias("x"))


def statistics(inputs: DataFrame) -> DataFrame:
    """Mergeable statistics: one row per release year and dimension that occurs in it.

    ``n`` counts the films that have the dimension: all of them for a number, those with a tag on
    it for a slot. Films shrink to these rows before anything is shuffled.
    """
    entries = inputs.select(YEAR_COLUMN, F.inline("inputs"))
    return entries.groupBy(YEAR_COLUMN, "dim").agg(
        F.count(F.lit(1)).alias("n"), F.avg("x").alias("mean"), (F.var_pop("x") * F.count(F.lit(1))).alias("m2"),
        F.min("x").alias("low"), F.max("x").alias("high")).select(*VECTOR_STATISTICS.fieldNames(), YEAR_COLUMN)


def merged(stats: DataFrame) -> DataFrame:
    """Statistics over all years from those of each year, one row per dimension.

    The years of a dimension, at most as many rows as there are years, are merged pairwise in their
    order, so the result is the same in every run.
    """
    years = F.array_sort(F.collect_list(F.struct(YEAR_COLUMN, "n", "mean", "m2", "low", "high")))
    start = F.struct(
        F.lit(0).cast("long").alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2"),
        F.lit(float("inf")).alias("low"), F.lit(float("-inf")).alias("high"))

    def add(a: Column, b: Column) -> Column:
        n, apart = a["n"] + b["n"], b["mean"] - a["mean"]
        return F.struct(
            n.alias("n"), (a["mean"] + apart * b["n"] / n).alias("mean"),
            (a["m2"] + b["m2"] + apart * apart * a["n"] * b["n"] / n).alias("m2"),
            F.least(a["low"], b["low"]).alias("low"), F.greatest(a["high"], b["high"]).alias("high"))

    return stats.groupBy("dim").agg(F.aggregate(years, start, add).alias("all")).select("dim", "all.*")


def factors(stats: DataFrame, spec: VectorSpec = DEFAULT, by: str | None = YEAR_COLUMN) -> DataFrame:
    """``([by,] dim, n, mean, films, factor)``: the factor is the scale of a number or the inverse
    document frequency of a slot."""
    numbers = len(spec.weights)
    group = [by] if by else []
    # The dimensions of a group, as many as the spec has at most, learn how many films there are.
    own = F.collect_list(F.struct("dim", "n", "mean", "m2", "low", "high")).alias("own")
    known = stats.groupBy(*group).agg(F.max(F.when(F.col("dim") == 0, F.col("n"))).alias("films"), own)
    known = known.select(*group, "films", F.inline("own"))
    weight = F.lit(1.0)
    if spec.weights_after_scaling:
        weight = F.element_at(F.array(*map(F.lit, spec.weights.values())), F.col("dim") + 1)
    constant = (F.col("low") == F.col("high")) | (F.col("m2") == 0)
    scale = F.when(constant, F.lit(0.0)).otherwise(weight / F.sqrt(F.col("m2") / (F.col("n") - 1)))
    rarity = F.log((F.col("films") + 1) / (F.col("n") + 1))
    return known.select(
        *group, "dim", "n", "mean", "films", F.when(F.col("dim") < numbers, scale).otherwise(rarity).alias("factor"))


def factor_array(fitted: DataFrame, spec: VectorSpec = DEFAULT) -> DataFrame:
    """Merged ``factors`` as the one row ``(films, factors)`` that ``features.transform`` takes.

    A slot that no film falls on has the inverse frequency of a tag that never occurs. No films
    give no row.
    """
    known = F.map_from_entries(F.collect_list(F.struct("dim", "factor")))
    row = fitted.agg(F.max("films").alias("films"), known.alias("_known")).where("films is not null")
    every = F.transform(
        F.sequence(F.lit(0), F.lit(spec.width - 1)),
        lambda dim: F.coalesce(F.element_at("_known", dim), F.log(F.col("films") + 1)))
    return row.select("films", every.alias(FACTORS))


def transform(inputs: DataFrame, fitted: DataFrame, by: str | None = YEAR_COLUMN) -> DataFrame:
    """``(id, release_year, indices, values)``: entries that are not zero, by rising index.

    Entries meet their factors by year and dimension; the table of factors is small where tags are
    few and joined by shuffle where it is not. A film's entries come together again by id; rows
    that share an id stay apart.
    """
    entries = inputs.withColumn("_row", F.monotonically_increasing_id()).select(
        "id", YEAR_COLUMN, "_row", F.inline("inputs"))
    scaled = entries.join(fitted.select(*([by] if by else []), "dim", "factor"), [*([by] if by else []), "dim"])
    entry = F.struct("dim", (F.col("x") * F.col("factor")).alias("x"))
    # Dealt by id alone: a task that is repeated may number its rows anew, but never sends a film elsewhere.
    films = scaled.select("id", YEAR_COLUMN, "_row", entry.alias("entry")).repartition("id").groupBy(
        "id", YEAR_COLUMN, "_row").agg(F.array_sort(F.collect_list("entry")).alias("entries"))
    kept = F.filter("entries", lambda e: e["x"] != 0)
    return films.select("id", YEAR_COLUMN, kept["dim"].alias(INDICES), kept["x"].alias(VALUES))


def fit_vectors(
    features: DataFrame, by: str | None = YEAR_COLUMN, spec: VectorSpec = DEFAULT,
) -> DataFrame:
    """Sparse vectors of all complete films, fitted within ``by`` (``None``: over all films at once)."""
    inputs = sparse_inputs(features, spec)
    stats = statistics(inputs)
    return transform(inputs, factors(stats if by else merged(stats), spec, by), by)


def user_profile(features: DataFrame, spec: VectorSpec = DEFAULT) -> DataFrame:
    """Mean of the favourites' vectors, fitted on the favourites, as one dense row ``user_vector``."""
    inputs = sparse_inputs(features, spec)
    fitted = factors(merged(statistics(inputs)), spec, None)
    # The mean of a slot over all films is its mean over those that have it, times their share.
    mean = F.col("factor") * F.col("mean") * F.col("n") / F.col("films")
    row = fitted.agg(F.map_from_entries(F.collect_list(F.struct("dim", mean.alias("x")))).alias("_known"), F.count("*").alias("_n"))
    every = F.transform(
        F.sequence(F.lit(0), F.lit(spec.width - 1)), lambda dim: F.coalesce(F.element_at("_known", dim), F.lit(0.0)))
    return row.where("_n > 0").select(every.alias("user_vector"))


def sparse_dot(indices: Column, values: Column, dense: Column) -> Column:
    """Sum over the entries of a sparse vector; an index beyond the dense one is an error."""
    at = F.transform(indices, lambda i: F.element_at(dense, i + 1))
    return F.aggregate(F.zip_with(values, at, lambda a, b: a * b), F.lit(0.0), lambda total, x: total + x)


def score_films(vectors: DataFrame, user: DataFrame, as_double: bool = False) -> DataFrame:
    """``(id, cosine_similarity)`` of sparse vectors against a dense profile; 0.0 for a zero vector.

    The profile is brought to unit length once and enters as a scalar subquery: no join. Without a
    profile nothing is scored.
    """
    direction = user.select(unit(F.col("user_vector"))).scalar()
    length = norm(F.col(VALUES))
    dot = sparse_dot(F.col(INDICES), F.col(VALUES), F.col("_direction"))
    score = F.when(length > 0, dot / length).otherwise(F.lit(0.0))
    return vectors.select("id", INDICES, VALUES, direction.alias("_direction")).where(
        F.col("_direction").isNotNull()).select("id", score.cast("double" if as_double else "float").alias("cosine_similarity"))
