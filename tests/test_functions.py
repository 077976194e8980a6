"""Truth tables for the scalar rules (text cleaning, label keys, date bounds)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from gridpull.functions import (
    clean_id,
    coerce_ts,
    is_missing,
    iso_text_fraction,
    norm_label,
    parse_bound,
    sanitize_name,
)


def _apply(spark, values, fn):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    rows = df.select("i", fn(F.col("v")).alias("o")).orderBy("i").collect()
    return [r.o for r in rows]


def test_norm_label(spark):
    vals = ["\xa0Voyage\xa0 ID ", "\x1cHeader", "Start-Date", "  Voyage ID ", "EndDate", "voyage_id", None]
    assert _apply(spark, vals, norm_label) == ["voyage_id", "header", "startdate", "voyage_id", "enddate", "voyage_id", None]
    from gridpull.functions import label_keys

    row = spark.range(1).select(*label_keys(["Voyage ID", "StartDate"])).first()
    assert tuple(row) == ("voyage_id", "startdate")


def test_is_missing(spark):
    vals = [None, "", " ", "null", "NULL", " Null ", "0", "nil", "\xa0"]
    assert _apply(spark, vals, is_missing) == [True, True, True, True, True, True, False, False, True]


def test_sanitize_name(spark):
    vals = ["Voyage-Date VoyageStart", "a - b", "USD/day", "NULL", " ", "  Voyage ID ", "rate usd", "ＡB"]
    assert _apply(spark, vals, sanitize_name) == [
        "voyage_date_voyagestart",
        "a_b",
        "usd/day",
        None,
        None,
        "voyage_id",
        "rate_usd",
        "ab",
    ]


def test_clean_id(spark):
    vals = [
        " 'X  Y' ",
        "\"'x'\"",
        "'\"x\"'",
        "' '",
        "' a '",
        "it's",
        "a\xa0b",
        "ＡＢ１",
        "ＮＵＬＬ",
        "null",
        "",
        None,
        "''",
        " '250202/CCC  DDD' ",
    ]
    assert _apply(spark, vals, clean_id) == [
        "X Y",
        "'x'",
        "x",
        " ",
        " a ",
        "it's",
        "a b",
        "AB1",
        "NULL",
        None,
        None,
        None,
        None,
        "250202/CCC DDD",
    ]


T = dt.datetime


@pytest.mark.parametrize(
    "text,start,end",
    [
        ("2025-07-03T05:06:07", T(2025, 7, 3, 5, 6, 7), T(2025, 7, 3, 5, 6, 7)),
        ("2025-07-03T05:06:07Z", T(2025, 7, 3, 5, 6, 7), T(2025, 7, 3, 5, 6, 7)),
        ("UTC 2025-07-03 05:06", T(2025, 7, 3, 5, 6), T(2025, 7, 3, 5, 6)),
        ("7/3/2025 5:06", T(2025, 7, 3, 5, 6), T(2025, 7, 3, 5, 6)),
        ("2025-7-3", T(2025, 7, 3), T(2025, 7, 3, 23, 59, 59)),
        ("12/31/2025", T(2025, 12, 31), T(2025, 12, 31, 23, 59, 59)),
        ("utc 2025-07-03", T(2025, 7, 3), T(2025, 7, 3, 23, 59, 59)),
        ("2025-07-03  05:06:07", T(2025, 7, 3, 5, 6, 7), T(2025, 7, 3, 5, 6, 7)),
        ("8/12/2025", T(2025, 8, 12), T(2025, 8, 12, 23, 59, 59)),
        ("2025-10-04T00:00:00Z", T(2025, 10, 4), T(2025, 10, 4)),
        ("UTC 2025-10-08 12:30", T(2025, 10, 8, 12, 30), T(2025, 10, 8, 12, 30)),
        ("2025-07-03 00:00", T(2025, 7, 3), T(2025, 7, 3)),
        ("7/3/25", None, None),
        ("25-7-3", None, None),
        ("2025-02-30", None, None),
        ("2025-07-03 24:00", None, None),
        ("2025-07-03 05:06:07.5", None, None),
        ("2025-07-03T05:06:07+09:00", None, None),
        ("2025-07-03ZZ", None, None),
        ("not a date", None, None),
        ("", None, None),
        ("NULL", None, None),
        ("null", None, None),
        (None, None, None),
    ],
)
def test_parse_bound(spark, text, start, end):
    df = spark.createDataFrame([(text,)], "v string")
    r = df.select(parse_bound("v").alias("s"), parse_bound("v", is_end=True).alias("e")).first()
    assert (r.s, r.e) == (start, end)


def test_iso_fraction_and_coerce(spark):
    df = spark.createDataFrame(
        [("2024-01-01 00:00:00.5",), ("2025-07-03 00:00:00",), ("bad",), ("2025-07-03",)], "v string"
    )
    rows = df.select(iso_text_fraction(coerce_ts("v")).alias("o")).collect()
    assert [r.o for r in rows] == ["2024-01-01T00:00:00.5", "2025-07-03T00:00:00", None, "2025-07-03T00:00:00"]


def test_norm_label_case_folding(spark):
    vals = ["Straße", "ﬁle ID", "ſtartDate", "HEADER", "J̌oin"]
    assert _apply(spark, vals, norm_label) == ["strasse", "file_id", "startdate", "header", "join"]
