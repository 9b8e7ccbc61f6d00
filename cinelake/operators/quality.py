"""Data-quality checks and dataset profiles."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class KeyViolation(ValueError):
    """A published table breaks one of its key rules."""


@dataclass(frozen=True)
class Rule:
    kind: str  # "unique" or "not_null"
    column: str


def unique(column: str) -> Rule:
    return Rule("unique", column)


def not_null(column: str) -> Rule:
    return Rule("not_null", column)


def key_rules(column: str) -> tuple[Rule, Rule]:
    return unique(column), not_null(column)


MODEL_RULES = {
    "infor_rating": (unique("id"), not_null("id"), not_null("title"), not_null("vote_average")),
    "recommendations": (unique("id"), not_null("id")),
}


def _not_null_counts(columns: Iterable[str]) -> dict:
    return {c: F.count_if(F.col(c).isNull()) for c in columns}


def check(df: DataFrame, rules: Iterable[Rule]) -> DataFrame:
    """``(rule, column, violations)``, one row per rule.

    A ``unique`` rule counts the values that occur more than once and ignores nulls. The null
    counts ride along in the grouping of the first ``unique`` column, so a single key needs one
    pass and one shuffle; each further ``unique`` column adds one.
    """
    rules = list(rules)
    keys = [r.column for r in rules if r.kind == "unique"]
    columns = [r.column for r in rules if r.kind == "not_null"]
    if not keys:
        reports = [(_report(df.agg(*_named(_not_null_counts(columns))), rules))]
    else:
        reports = []
        for position, key in enumerate(keys):
            own = columns if position == 0 else []
            groups = df.groupBy(F.col(key).alias("_key")).agg(
                F.count(F.lit(1)).alias("_copies"), *_named(_not_null_counts(own)))
            totals = groups.agg(
                F.count_if((F.col("_copies") > 1) & F.col("_key").isNotNull()).alias("unique"),
                *(F.coalesce(F.sum(_null_name(c)), F.lit(0)).alias(_null_name(c)) for c in own))
            reports.append(_report(
                totals, [r for r in rules if r == unique(key) or (r.kind == "not_null" and own)]))
    result = reports[0]
    for report in reports[1:]:
        result = result.unionByName(report)
    return result


def _null_name(column: str) -> str:
    return f"_null_{column}"


def _named(counts: dict) -> list:
    return [count.alias(_null_name(column)) for column, count in counts.items()]


def _report(totals: DataFrame, rules: list[Rule]) -> DataFrame:
    lines = [
        F.struct(
            F.lit(r.kind).alias("rule"), F.lit(r.column).alias("column"),
            F.col("unique" if r.kind == "unique" else _null_name(r.column)).alias("violations"))
        for r in rules
    ]
    return totals.select(F.inline(F.array(*lines)))


def profile(df: DataFrame, table: str) -> DataFrame:
    """Row count, column count and column names of a dataset, as one row."""
    return df.agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(table).alias("table_name"), "row_count",
        F.lit(len(df.columns)).alias("column_count"),
        F.lit(",".join(df.columns)).alias("columns"))
