"""Scalar functions on small literals."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerspark.functions import calendar, eventtime, keys, money


def values(spark, rows, expression, ddl="v string"):
    df = spark.createDataFrame([(row,) for row in rows], ddl)
    return [r[0] for r in df.select(expression).collect()]


def test_strict_parse_accepts_one_form_padded_or_not(spark):
    rows = ["01/31/2024 23:59:59", "1/2/2024 3:4:5", None, "2024-01-31 00:00:00",
            "13/01/2024 00:00:00", "01/31/2024", "02/30/2024 00:00:00", ""]
    assert values(spark, rows, eventtime.try_parse_strict(F.col("v"))) == [
        dt.datetime(2024, 1, 31, 23, 59, 59), dt.datetime(2024, 1, 2, 3, 4, 5),
        None, None, None, None, None, None,
    ]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_strict_parse_fails_on_a_bad_value(spark, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(Exception, match="2024-01-31"):
            values(spark, ["2024-01-31"], eventtime.parse_strict(F.col("v")))
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_parse_applies_no_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        # This wall clock does not exist in New York.
        assert values(
            spark, ["03/10/2024 02:30:00"], eventtime.parse_strict(F.col("v"))
        ) == [dt.datetime(2024, 3, 10, 2, 30)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_lenient_parse_forms(spark):
    rows = ["01/31/2024 23:59:59", "1/31/2024 23:59", "2024-01-31 10:00:00", "2024-01-31",
            "2024-01-31T10:00:00", "2024-01-31T10:00:00.25", "2024-01-31T10:00:00+05:00",
            "20240131", "20240131T101112", " 2024-01-31 ", "2024", "2024-13-01", "31/31/2024 1:1",
            "next week", "20241399", "20240131T256060"]
    day = dt.datetime(2024, 1, 31)
    ten = day.replace(hour=10)
    assert values(spark, rows, eventtime.parse_lenient(F.col("v"))) == [
        day.replace(hour=23, minute=59, second=59), day.replace(hour=23, minute=59), ten, day,
        ten, ten.replace(microsecond=250000), ten, day,
        day.replace(hour=10, minute=11, second=12), day, None, None, None, None, None, None,
    ]


def test_file_name_dates(spark):
    rows = ["a/premium_2024_01_31.json", "premium_20240131_copy.json", "x_20250101_2024_02_03.json",
            "premium_120240131.json", "feed.json", "20240131/feed.json", "p_2024_99_99.json"]
    found = eventtime.file_name_date(F.col("v"))
    assert [None if r is None else tuple(r) for r in values(spark, rows, found)] == [
        (2024, 1, 31), (2024, 1, 31), (2024, 2, 3), None, None, None, (2024, 99, 99),
    ]


def test_calendar_features(spark):
    rows = [dt.datetime(2024, 12, 30), dt.datetime(2024, 1, 7, 23), dt.datetime(2024, 1, 8),
            dt.datetime(2021, 1, 3), None]
    df = spark.createDataFrame([(r,) for r in rows], "ts timestamp_ntz")
    result = calendar.add_calendar_features(df, "ts").drop("ts").collect()
    assert [tuple(r) for r in result] == [
        ("Monday", 1, True), ("Sunday", 1, True), ("Monday", 2, False), ("Sunday", 53, True),
        (None, None, None),
    ]


def test_month_start_and_date_key(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 2, 29, 23, 59),), (None,)], "ts timestamp_ntz")
    result = df.select(calendar.month_start(F.col("ts")), calendar.date_key(F.col("ts")))
    assert [tuple(r) for r in result.collect()] == [(dt.date(2024, 2, 1), 20240229), (None, None)]
    assert result.dtypes[1][1] == "bigint"


def test_month_predicate(spark):
    rows = [(2023, 12), (2024, 1), (2024, 2), (None, None)]
    df = spark.createDataFrame(rows, "year int, month int")

    def kept(months):
        return [tuple(r) for r in df.where(calendar.month_predicate(months)).collect()]

    assert calendar.month_predicate([]) is None
    assert kept([202401, 202312]) == [(2023, 12), (2024, 1)]
    assert kept([0]) == [(None, None)]
    negated = df.where(~calendar.month_predicate([202401])).collect()
    assert len(negated) == 3, "undated rows are in one of the two halves"


def test_surrogate_key_marks_nulls_and_may_collide(spark):
    df = spark.createDataFrame(
        [("a-b", "c"), ("a", "b-c"), (None, "c"), ("a", None)], "x string, y string"
    )
    found = [r[0] for r in df.select(keys.surrogate_key("x", "y")).collect()]
    assert found[0] == found[1]
    expected = spark.sql(
        "select md5('_dbt_utils_surrogate_key_null_-c'), md5('a-_dbt_utils_surrogate_key_null_')"
    ).first()
    assert found[2:] == list(expected)


def test_fx(spark):
    df = spark.createDataFrame(
        [(10.0, "EUR"), (0.8466166015625, "GBP"), (5.0, "USD"), (5.0, None)],
        "a double, c string",
    )
    assert [r[0] for r in df.select(money.to_eur(F.col("a"), F.col("c"))).collect()] == [
        10.0, 1.0, None, None,
    ]
    usd = money.to_eur(F.col("a"), F.col("c"), {"USD": 2.0})
    assert [r[0] for r in df.select(usd).collect()] == [10.0, None, 2.5, None]


def test_rounding_is_half_away_from_zero(spark):
    rows = [2.675, -0.125, 0.005, None]
    assert values(spark, rows, money.round_total(F.col("v")), "v double") == [
        Decimal("2.68"), Decimal("-0.13"), Decimal("0.01"), None,
    ]


def test_packed_keys_are_short_and_come_back_as_they_were(spark):
    digest = "0123456789abcdef" * 2
    texts = [None, "", "a", digest, digest.upper(), digest + "\n", digest[:30], digest[:16], digest[:15], "ä" * 8, "\0" * 17]
    rows = spark.createDataFrame([(t,) for t in texts], "key string").select("key", keys.pack(F.col("key")).alias("packed"))
    found = rows.select("key", "packed", keys.unpack(F.col("packed")).alias("back")).collect()
    assert [r["back"] for r in found] == texts
    packed = [None if r["packed"] is None else bytes(r["packed"]) for r in found]
    assert len(set(packed)) == len(texts)
    assert [t for t, p in zip(texts, packed) if p is not None and len(p) == 16] == [digest]
