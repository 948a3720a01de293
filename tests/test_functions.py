from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from activation_mart.functions import (
    code_needs_trusted_user,
    RunWindow,
    address_verified,
    channel_label,
    ci_eq,
    ci_like,
    exclude_patterns,
    has_all,
    hour_boundaries,
    in_window,
    month_boundaries,
    month_year,
    parse_date,
)


def values(spark, rows, schema, column):
    return [row[0] for row in spark.createDataFrame(rows, schema).select(column).collect()]


def test_window_is_half_open(spark):
    window = RunWindow.parse("12/1/2012", "1/22/2013")
    rows = [(datetime(2012, 12, 1),), (datetime(2013, 1, 22),), (datetime(2013, 1, 21, 23, 59),), (None,)]
    assert values(spark, rows, "t timestamp_ntz", in_window("t", window)) == [True, False, True, None]


def test_trailing_window_starts_at_midnight():
    window = RunWindow.trailing(30, datetime(1999, 1, 15, 9, 30, 40))
    assert window == RunWindow(datetime(1998, 12, 16), datetime(1999, 1, 15, 9, 31))


def test_ci_eq_ignores_case_and_trailing_blanks(spark):
    rows = [("APPROVED ",), ("approved",), (" approved",), (None,)]
    assert values(spark, rows, "s string", ci_eq("s", "Approved")) == [True, True, False, None]
    assert values(spark, [("a ", "A")], "a string, b string", ci_eq("a", F.col("b"))) == [True]


def test_ci_like(spark):
    assert values(spark, [("OOW Declined",), ("x",)], "s string", ci_like("s", "%oow%")) == [True, False]


def test_exclude_patterns_keeps_nulls(spark):
    rows = [(None, None), ("TESTer", "x"), ("a test", "x"), ("a", "12 sample plaza 3")]
    keep = exclude_patterns({"a": ["test%"], "b": ["%12 SAMPLE PLAZA%"]})
    assert values(spark, rows, "a string, b string", keep) == [True, False, True, False]


def test_has_all(spark):
    rows = [("x", None, "y"), (None, "x", "y"), (None, None, "y"), ("x", "x", None)]
    complete = has_all([("a", "b"), ("c",)])
    assert values(spark, rows, "a string, b string, c string", complete) == [True, True, False, False]


@pytest.mark.parametrize(
    "first, last, months",
    [(date(1994, 10, 31), date(2012, 10, 1), 216), (date(1994, 12, 31), date(1995, 1, 1), 1),
     (date(2000, 1, 1), date(2000, 1, 31), 0), (None, date(2000, 1, 1), None)],
)
def test_month_boundaries(spark, first, last, months):
    assert values(spark, [(first, last)], "a date, b date", month_boundaries("a", "b")) == [months]


def test_hour_boundaries(spark):
    rows = [(datetime(2012, 1, 1, 9, 59), datetime(2012, 1, 1, 10, 0)),
            (datetime(2012, 1, 1, 9, 0), datetime(2012, 1, 1, 9, 59)),
            (datetime(2012, 1, 1, 9, 0), datetime(2012, 1, 1, 8, 59))]
    schema = "a timestamp_ntz, b timestamp_ntz"
    assert values(spark, rows, schema, hour_boundaries("a", "b")) == [1, 0, -1]


def test_hour_boundaries_in_a_zone_with_summer_time(spark):
    rows = [(datetime(2012, 3, 11, 2, 30), datetime(2012, 3, 11, 5, 10)),
            (datetime(2012, 3, 11, 1, 10), datetime(2012, 3, 11, 2, 30)),
            (datetime(1960, 3, 11, 1, 10), datetime(1960, 3, 11, 2, 5))]
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        found = values(spark, rows, "a timestamp_ntz, b timestamp_ntz", hour_boundaries("a", "b"))
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert found == [3, 1, 1]


def test_codes_ignore_case_and_trailing_blanks(spark):
    rows = [("b5", 1), ("B5 ", 1), ("c5", 1), ("c5 ", 7), ("P1", 7)]
    test = code_needs_trusted_user("code", "user", ["B5"], "C5", [7])
    assert values(spark, rows, "code string, user int", test) == [True, True, False, True, False]


def test_month_year_and_parse_date(spark):
    rows = [("10/3/2012",), ("1/22/2013",)]
    parsed = parse_date("s")
    assert values(spark, rows, "s string", parsed) == [datetime(2012, 10, 3), datetime(2013, 1, 22)]
    assert values(spark, rows, "s string", month_year(parsed)) == [102012, 12013]


def test_channel_label(spark):
    rows = [(True,), (False,), (None,)]
    assert values(spark, rows, "b boolean", channel_label("b")) == ["Online", "Retail", "Retail"]


def test_address_verified(spark):
    rows = [("Verified", "verified"), ("Verified", None), (None, "Verified"), (None, None),
            ("Street", "Verified"), ("Verified", "Street"), ("Street", None)]
    expected = ["VERIFIED"] * 4 + [None] * 3
    assert values(spark, rows, "a string, b string", address_verified("a", "b")) == expected
