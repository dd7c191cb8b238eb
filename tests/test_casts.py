import datetime as dt

import pytest
from pyspark.sql import functions as F

from lodestone.functions.casts import date_prefix, flexible_timestamp, safe_bigint, safe_double


def one(spark, expr, value):
    return spark.createDataFrame([(value,)], "x string").select(expr(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize("text,expected", [
    ("12.5", 12.5), (" 12 ", 12.0), ("1e3", 1000.0), ("-0.5", -0.5), (".5", 0.5), ("inf", float("inf")),
    ("1d", None), ("1_0", None), ("abc", None), ("", None), (".", None), (None, None),
])
def test_safe_double_is_stricter_than_spark_cast(spark, text, expected):
    # T-7: Spark's own cast accepts '1d'; the guarded parse does not
    assert one(spark, safe_double, text) == expected


def test_safe_double_nan(spark):
    v = one(spark, safe_double, "NaN")
    assert v != v


@pytest.mark.parametrize("text,expected", [("12", 12), ("12.0", 12), ("-3", -3), ("12.5", None), ("x", None)])
def test_safe_bigint(spark, text, expected):
    assert one(spark, safe_bigint, text) == expected


@pytest.mark.parametrize("text,expected", [
    ("2026-04-08T10:11:12", dt.datetime(2026, 4, 8, 10, 11, 12)),
    ("2026-04-08 10:11:12", dt.datetime(2026, 4, 8, 10, 11, 12)),
    ("2026-04-08T10:11:12.570Z", dt.datetime(2026, 4, 8, 10, 11, 12, 570000)),
    ("2025-12-12 00:00:00+00", dt.datetime(2025, 12, 12)),
    ("2025-12-12 07:00:00+07:00", dt.datetime(2025, 12, 12, 7)),  # wall clock kept (T-13)
    ("2026-04-01", dt.datetime(2026, 4, 1)),
    ("2025-12-12 00:00:00 +0700 (WIB)", dt.datetime(2025, 12, 12)),  # VAL-6 fallback: cut at '+'
    ("2026-04", None),  # T-19: Spark's cast would accept this
    ("someday", None), (None, None),
])
def test_flexible_timestamp(spark, text, expected):
    assert one(spark, flexible_timestamp, text) == expected


def test_date_prefix_cuts_ten_chars(spark):
    assert one(spark, date_prefix, "2026-04-08T23:59:59Z") == dt.date(2026, 4, 8)


def test_date_prefix_raises_on_bad_input_under_ansi(spark):
    with pytest.raises(Exception):
        one(spark, date_prefix, "not-a-date")


FREE_FORM = [
    ("Wed Apr  8 16:00:00 2026", dt.datetime(2026, 4, 8, 16)), ("Wed Apr 8 16:00:00 UTC 2026", dt.datetime(2026, 4, 8, 16)),
    ("Wed, 8 Apr 2026 16:00:00 GMT", dt.datetime(2026, 4, 8, 16)), ("Wednesday, April 8th, 2026", dt.datetime(2026, 4, 8)),
    ("8-Apr-26", dt.datetime(2026, 4, 8)), ("08.Apr.2026", dt.datetime(2026, 4, 8)), ("2026 Apr 8", dt.datetime(2026, 4, 8)),
    ("2026/4/8 4:05", dt.datetime(2026, 4, 8, 4, 5)), ("8apr2026", dt.datetime(2026, 4, 8)), ("20260408", dt.datetime(2026, 4, 8)),
    ("260408", dt.datetime(2026, 4, 8)), ("20260408161530", dt.datetime(2026, 4, 8, 16, 15, 30)), ("202604081615", dt.datetime(2026, 4, 8, 16, 15)),
    ("April 8, 2026 at 4:05:06 pm", dt.datetime(2026, 4, 8, 16, 5, 6)), ("5 PM on 8 April 2026", dt.datetime(2026, 4, 8, 17)),
    ("12:30 a.m. 8 April 2026", dt.datetime(2026, 4, 8, 0, 30)), ("12 pm April 8 2026", dt.datetime(2026, 4, 8, 12)),
    ("16:05:06.25 8 Sept 2026", dt.datetime(2026, 9, 8, 16, 5, 6, 250000)), ("8th of April, 2026", dt.datetime(2026, 4, 8)),
    ("Apr 8 2026 16:00 +07:00", dt.datetime(2026, 4, 8, 16)),  # wall clock kept
    # ambiguous numbers, by the documented rule
    ("3/4/2026", dt.datetime(2026, 3, 4)), ("13/4/2026", dt.datetime(2026, 4, 13)), ("3/14/26", dt.datetime(2026, 3, 14)),
    ("75-3-4", dt.datetime(2075, 3, 4)), ("76-3-4", dt.datetime(1976, 3, 4)), ("1/2/3", dt.datetime(2003, 1, 2)),
    ("Apr 2026 8", dt.datetime(2026, 4, 8)), ("26 Apr 3", dt.datetime(2003, 4, 26)), ("3 26 Apr", dt.datetime(2003, 4, 26)), ("99-Jan-01", dt.datetime(1999, 1, 1)),
    # no date, or not a whole one
    ("April 2026", None), ("April 8", None), ("16:00", None), ("2026-13-40", None), ("30 Feb 2026", None), ("8 April May 2026", None), ("1 2 3 4", None),
    ("gold 8 2026", None), ("25:00 8 April 2026", None), ("13 pm 8 April 2026", None), ("", None), ("12026-04-08", None), ("20261308", None),
]


def test_free_form_dates(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(FREE_FORM)], "i int, t string")
    got = {r["i"]: r["v"] for r in df.select("i", flexible_timestamp("t").alias("v")).collect()}
    assert {t: got[i] for i, (t, _) in enumerate(FREE_FORM)} == dict(FREE_FORM)
