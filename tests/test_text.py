"""Reading rules for numbers and times, against Python's own."""

from datetime import datetime

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from trolley.functions import text


def column(spark, values, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("v"))).collect()]


def py_float(value):
    try:
        return float(value)
    except (TypeError, ValueError):
        return None


def py_int(value):
    try:
        number = int(float(value))
    except (TypeError, ValueError, OverflowError):
        return None
    return number if -(2**63) <= number < 2**63 else None


NUMBERS = [
    "+nan",
    "-NaN",
    "9223372036854775808",
    "-9223372036854775808",
    "5", "5.9", "-5.9", " 5 ", "1e3", "", "abc", "nan", "inf", "-Infinity", "0x10", "1.0d", "1f",
    "1_000", "1__0", "_1", "1_", ".5", "5.", ".", "+7", "--7", "1e", "1e+2", "1e300", "1e400",
    "1487580005268456287", " 5 ", "\t5\n", "5 5", "9223372036854775807", "-0.0", None,
    "Inf", "NAN", "infinit", "1,5", "1e1_0", "\x1c5", "0x1p3", "true",
]


def same(a, b):
    return a == b or (a is not None and b is not None and a != a and b != b)


def test_numbers(spark):
    doubles = column(spark, NUMBERS, text.to_double)
    for value, got in zip(NUMBERS, doubles, strict=True):
        assert same(got, py_float(value)), value
    ints = column(spark, NUMBERS, lambda c: text.double_to_bigint(text.to_double(c)))
    expected = [py_int(v) for v in NUMBERS]
    for i, value in enumerate(NUMBERS):
        assert ints[i] == expected[i], value


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text("0123456789.eE+-_ nNaAiIfF\t", max_size=8), min_size=200, max_size=400))
def test_any_number_text(spark, values):
    for value, got in zip(values, column(spark, values, text.to_double), strict=True):
        assert same(got, py_float(value)), value


TIMES = [
    "2020-01-01 00:00:00", "2020-01-01 00:00:00 UTC", " 2020-1-1 1:2:3 ", "2020-02-30 00:00:00",
    "2020-02-29 23:59:59", "2019-02-29 00:00:00", "2020-01-01", "2020-01-01T00:00:00", "",
    "2020-01-01 24:00:00", "2020-01-01 00:00:60", "2020-01-01 00:00:00.5", "20-01-01 00:00:00",
    "2020-01-01  00:00:00", "2020-01-01\t00:00:00", "0000-01-01 00:00:00", "2020-13-01 00:00:00",
    "2020-00-01 00:00:00", "a b", "a b c", "2020-01-01 00:00", " UTC", "9999-12-31 23:59:59",
    "2020-01-01 UTC00:00:00", "0001-01-01 00:00:00",
]


def py_time(value):
    try:
        return datetime.strptime(value.replace(" UTC", "").strip(), "%Y-%m-%d %H:%M:%S")
    except ValueError:
        return None


def test_times(spark):
    parsed = column(spark, TIMES, lambda c: text.to_event_ts(c).cast("timestamp_ntz"))
    assert parsed == [py_time(v) for v in TIMES]


def test_time_shape(spark):
    shapes = column(spark, TIMES + [None], text.has_time_shape)
    expected = [len(v.replace(" UTC", "").strip().split()) == 2 for v in TIMES] + [False]
    assert shapes == expected


@pytest.mark.parametrize("pad", [" ", "\t", " ", "　", "\x1f", "\r\n"])
def test_trim(spark, pad):
    assert column(spark, [f"{pad}x y{pad}"], text.trim_all) == ["x y"]


def test_ids_from_json_text(spark):
    values = ["5", "5.0", "abc", None, "9007199254740993"]
    assert column(spark, values, text.id_to_bigint) == [5, 5, None, None, 9007199254740993]
