import math

import pytest
from pyspark.sql import functions as F

from cinelake.functions import (
    binary_to_text, calendar_year, cosine, dot, list_literal, month_label, norm, rating_floor,
    rating_label, split_tags, unit,
)


def values(spark, rows, schema, column):
    df = spark.createDataFrame([(r,) for r in rows], schema)
    return [r[0] for r in df.select(column).collect()]


def test_missing_tags_split_to_nothing_and_blanks_stay(spark):
    found = values(spark, ["nan", "A, B", "", None], "t string", split_tags("t"))
    assert found == [[], ["A", " B"], [""], None]
    assert values(spark, ["A, B"], "t string", split_tags("t", trim=True)) == [["A", "B"]]


def test_rating_labels(spark):
    label = rating_label(rating_floor("r"))
    found = values(spark, [0.0, 9.99, 10.0, -0.5, None], "r double", label)
    assert found == ["0-1", "9-10", "unknown", "unknown", "unknown"]


def test_list_literals(spark):
    found = values(spark, ["[28, 12]", "x", '{"a":1}', None, "[]", "[1, 2] junk"], "t string", list_literal("t"))
    assert found == [[28, 12], [], [], [], [], []]


def test_year_of_date_text(spark):
    found = values(
        spark, ["", "2001-02-03", None, "soon", "+12345-01-01"], "t string", calendar_year("t"))
    assert found == [None, 2001, None, None, 12345]


def test_month_label(spark):
    assert values(spark, ["2001-02-03"], "t string", month_label(F.col("t").cast("date"))) == [
        "2001-02"]


def test_only_binary_columns_are_decoded(spark):
    df = spark.createDataFrame([(1, bytearray("né".encode()), "x")], "a int, b binary, c string")
    out = binary_to_text(df)
    assert out.first() == (1, "né", "x")
    assert out.dtypes == [("a", "int"), ("b", "string"), ("c", "string")]


def test_vector_arithmetic(spark):
    a = F.array(F.lit(3.0), F.lit(4.0))
    b = F.array(F.lit(0.0), F.lit(5.0))
    zero = F.array(F.lit(0.0), F.lit(0.0))
    row = spark.range(1).select(
        dot(a, b), norm(a), cosine(a, unit(b)),
        cosine(zero, unit(b)), cosine(a, unit(zero))).first()
    assert row[0] == 20.0
    assert row[1] == 5.0
    assert math.isclose(row[2], 0.8)
    assert row[3] == 0.0
    assert row[4] == 0.0


def test_vectors_of_different_lengths_are_an_error(spark):
    df = spark.createDataFrame([([1.0, 2.0], [1.0])], "a array<double>, b array<double>")
    with pytest.raises(Exception, match="vectors of lengths 2 and 1"):
        df.select(dot(F.col("a"), F.col("b"))).collect()
    none = df.select(dot(F.col("a"), F.lit(None).cast("array<double>")).alias("d"))
    assert none.first().d is None
