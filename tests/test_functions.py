from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.errors import ArithmeticException
from pyspark.sql import functions as F

from platework.functions import documents as d
from platework.functions import numbers, text, times


def value(spark, column, **inputs):
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in inputs.items()], F.lit(0).alias("_"))
    return row.select(column.alias("v")).first()["v"]


@pytest.mark.parametrize("token, expected", [
    ("12", 12), (" 12 ", 12), ("-50", -50), ("12.7", None), ("abc", None), ("", None), (None, None), ("99999999999", None),
])
def test_to_int(spark, token, expected):
    assert value(spark, text.to_int(F.lit(token).cast("string"))) == expected


def test_bounded_cuts_and_keeps_null(spark):
    assert value(spark, text.bounded(F.lit("1234567"), 5)) == "12345"
    assert value(spark, text.bounded(F.lit(42), 5)) == "42"
    assert value(spark, text.bounded(F.lit(None).cast("string"), 5)) is None


@pytest.mark.parametrize("point, lng, lat", [
    ("POINT (-122.33 47.61)", -122.33, 47.61), ("POINT (-122.33)", -122.33, None), ("unknown", None, None),
    ("", None, None), (None, None, None), ("POINT (x 47.61)", None, 47.61),
])
def test_point(spark, point, lng, lat):
    column = F.lit(point).cast("string")
    assert value(spark, text.longitude(column)) == lng
    assert value(spark, text.latitude(column)) == lat


def test_surrogate_key_reads_null_as_empty(spark):
    none, empty = F.lit(None).cast("string"), F.lit("")
    assert value(spark, text.surrogate_key(none, F.lit("b"))) == value(spark, text.surrogate_key(empty, F.lit("b")))
    assert value(spark, text.surrogate_key(F.lit("a"), F.lit("b"))) != value(spark, text.surrogate_key(F.lit("ab"), empty))


def test_percent_rounds_ties_up_and_guards(spark):
    assert value(spark, numbers.percent(F.lit(107), F.lit(4000))) == Decimal("2.68")
    assert value(spark, numbers.percent(F.lit(9999), F.lit(10000))) == Decimal("99.99")
    assert value(spark, numbers.percent(F.lit(-107), F.lit(4000))) == Decimal("-2.68")
    assert value(spark, numbers.percent(F.lit(5), F.lit(0))) is None


def test_guarded_ratio(spark):
    assert value(spark, numbers.guarded_ratio(F.lit(3), F.lit(4))) == 0.75
    assert value(spark, numbers.guarded_ratio(F.lit(3), F.lit(0))) is None
    with pytest.raises(ArithmeticException):
        value(spark, F.lit(3) / F.lit(0))


def test_completeness_of_nothing_is_null(spark):
    rows = spark.createDataFrame([("a",), (None,), ("b",)], "v string")
    assert rows.agg(numbers.completeness("v")).first()[0] == Decimal("66.67")
    assert rows.limit(0).agg(numbers.completeness("v")).first()[0] is None


def test_minutes_count_boundaries(spark):
    start, end = datetime(2026, 1, 1, 0, 0, 59), datetime(2026, 1, 1, 0, 1, 1)
    assert value(spark, times.minutes_between("a", "b"), a=start, b=end) == 1
    assert value(spark, times.seconds_between("a", "b"), a=start, b=end) == 2


def test_rounded_integers(spark):
    for token, whole in (("12.7", 13), ("-0.6", -1), ("0.4", 0), ("7", 7), ("x", None), ("", None), ("99999999999", None)):
        assert value(spark, text.to_rounded_int("t"), t=token) == whole


def test_header_positions(spark):
    names = F.array(F.lit("a"), F.lit("b"), F.lit(None), F.lit("a"))
    assert value(spark, d.field_position(names, "a")) == 3
    assert value(spark, d.field_position(names, "z")) is None
    assert value(spark, d.missing_fields(names, ["z", "a", "y"])) == ["z", "y"]
    none = F.lit(None).cast("array<string>")
    assert value(spark, d.missing_fields(none, ["z"])) == ["z"]
