"""Edge rows for the scalar helpers (FIXTURES.md §3)."""

import datetime as dt

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from parcelmart.functions import scalar as X


def one(spark, expr, **cols):
    """Evaluate ``expr`` over a one-row frame built from ``cols`` (all strings unless typed)."""
    names = list(cols)
    df = spark.createDataFrame([tuple(cols[n] for n in names)], ",".join(f"{n} string" for n in names)) \
        if cols else spark.range(1)
    return df.select(expr.alias("v")).first().v


def test_has_prefix_and_blank(spark):
    assert one(spark, X.has_prefix("c", "PARTNER"), c="PARTNER-00000001-2") is True
    assert one(spark, X.has_prefix("c", "PARTNER"), c="APP-1") is False
    assert one(spark, X.has_prefix("c", "PARTNER"), c=None) is None
    assert one(spark, X.not_blank("c"), c="") is False
    assert one(spark, X.not_blank("c"), c=None) is False


@pytest.mark.parametrize("code,part", [("PARTNER-12345678-1", "12345678"), ("PARTNER", None), ("a--b", "")])
def test_split_part(spark, code, part):
    assert one(spark, X.split_part("c", "-", 2), c=code) == part


def test_strip_digits(spark):
    assert one(spark, X.strip_digits("c"), c="Old Town 2") == "Old Town "


def test_date_from_parts_accepts_unpadded(spark):
    assert one(spark, X.date_from_parts("y", "m", "d"), y="2018", m="1", d="5") == dt.date(2018, 1, 5)
    assert one(spark, X.date_from_parts("y", "m", "d"), y="2018", m=None, d="5") is None


def test_text_key_differs_from_date_when_unpadded(spark):
    # '2018-1-5' >= '2018-01-31' as text (second char of month '1' > '0') although January.
    assert one(spark, X.parts_text("y", "m", "d") >= "2018-01-31", y="2018", m="1", d="5") is True
    assert X.day_before("2018-02-01") == "2018-01-31"
    assert X.day_before("2018-03-01") == "2018-02-28"


@pytest.mark.parametrize(
    "text,expected",
    [
        ("2018-03-01T10:00:00.000Z", dt.datetime(2018, 3, 1, 10, 0, 0)),
        ("2018-03-01T10:00:00Z", dt.datetime(2018, 3, 1, 10, 0, 0)),
        ("2018-03-01T10:00:00.123Z", None),
        (None, None),
        ("garbage", None),
    ],
)
def test_parse_iso_z(spark, text, expected):
    assert one(spark, X.parse_iso_z("t"), t=text) == expected


def test_strict_parse_raises(spark):
    with pytest.raises(Exception):
        one(spark, X.parse_ts("t"), t="2018-01-01 10:00:00.123")
    assert one(spark, X.parse_ts("t", strict=False), t="2018-01-01 10:00:00.123") is None


def test_elapsed_and_minutes_truncate_toward_zero(spark):
    a, b = "2018-01-01 00:03:01", "2018-01-01 00:00:00"
    df = spark.createDataFrame([(a, b)], "a string, b string").select(
        F.to_timestamp("a").alias("a"), F.to_timestamp("b").alias("b"),
        F.to_timestamp(F.lit("2018-01-01 00:00:01.5")).alias("c"),
    )
    r = df.select(
        X.elapsed_seconds("a", "b").alias("s"), X.whole_minutes("a", "b").alias("m"),
        X.elapsed_seconds("b", "c").alias("frac"), X.elapsed_seconds("c", "b").alias("neg_frac"),
    ).first()
    assert (r.s, r.m, r.frac, r.neg_frac) == (-181, -3, 1, -1)


@pytest.mark.parametrize(
    "doc,double,integer",
    [
        ('{"k": 12}', 12.0, 12),
        ('{"k": "abc"}', None, None),
        ('{"k": null}', None, None),
        ('{"x": 1}', None, None),
        ('{"k": 12', None, None),
        ('{"k": 1.5}', 1.5, None),
    ],
)
def test_json_scalars(spark, doc, double, integer):
    assert one(spark, X.json_double("j", "$.k"), j=doc) == double
    assert one(spark, X.json_int("j", "$.k"), j=doc) == integer


def test_json_nested_path(spark):
    doc = '{"expressMeta": {"jobCard": {"jobType": 2}}}'
    assert one(spark, X.json_int("j", "$.expressMeta.jobCard.jobType"), j=doc) == 2


def test_validity_interval(spark):
    t = dt.datetime(2018, 6, 1)
    df = spark.createDataFrame(
        [
            (t, None, None),  # open start: kept
            (t, t, dt.datetime(2019, 1, 1)),  # start boundary: kept
            (t, dt.datetime(2018, 1, 1), t),  # end boundary: dropped (half-open)
            (t, dt.datetime(2018, 1, 1), None),  # NULL end with a start: NULL -> dropped
        ],
        "t timestamp, s timestamp, e timestamp",
    )
    got = [r.v for r in df.select(X.in_validity("t", "s", "e").alias("v")).collect()]
    assert got == [True, True, False, None]


def test_per_rate_zero_and_null(spark):
    df = spark.createDataFrame([(10.0, 4.0), (10.0, 0.0), (10.0, None)], "a double, r double")
    assert [r.v for r in df.select(X.per_rate("a", "r").alias("v")).collect()] == [2.5, None, None]


def test_floor_bucket_toward_negative_infinity(spark):
    df = spark.createDataFrame([(-0.1,), (0.0,), (4.99,), (5.0,), (None,)], "x double")
    got = [r.v for r in df.select(X.floor_bucket("x", 5).alias("v")).collect()]
    assert got == [-5, 0, 0, 5, None]


def test_week_and_month_start(spark):
    df = spark.createDataFrame([(dt.date(2018, 2, 7),)], "d date")
    r = df.select(X.week_start("d").alias("w"), X.month_start("d").alias("m")).first()
    assert (r.w, r.m) == (dt.date(2018, 2, 5), dt.date(2018, 2, 1))


def test_list_plus_scalar_fails_at_analysis(spark):
    """Adding a number to an array is a type error before anything runs."""
    with pytest.raises(AnalysisException):
        spark.range(1).select(F.array(F.lit(1), F.lit(2)) + F.lit(10)).schema
