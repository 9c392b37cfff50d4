from __future__ import annotations

import hashlib
from datetime import date, datetime, timezone
from decimal import Decimal

from pyspark.sql import functions as F

from tests.conftest import plan_of
from wanderlake.fixed_values import (
    CLEANING_TRUE_TEXT,
    CONTINENT_BY_DESTINATION,
    ISO_CODE_BY_COUNTRY,
    STANDARD_TRUE_TEXT,
    SURROGATE_NULL,
)
from wanderlake.functions import numbers, text, times


def values(spark, rows, ddl, expression):
    df = spark.createDataFrame(rows, ddl)
    return [row[0] for row in df.select(expression).collect()]


def one_column(spark, items, kind, expression):
    return values(spark, [(i,) for i in items], f"x {kind}", expression)


def test_decimal_or_null(spark):
    items = ["1.005", "abc", "", None, "123456789.00", "-12.505", " 7.1 ", "1e2"]
    assert one_column(spark, items, "string", numbers.decimal_or_null(F.col("x"), 10, 2)) == [
        Decimal("1.01"), None, None, None, None, Decimal("-12.51"), Decimal("7.10"), Decimal("100.00"),
    ]


def test_whole_number_rounds(spark):
    assert one_column(spark, [12.5, -12.5, 12.4, None], "double", numbers.whole_number(F.col("x"))) == [
        13, -13, 12, None,
    ]


def test_ratio_and_percentage(spark):
    rows = [(1, 3), (2, 0), (None, 4)]
    ratio = numbers.percent_of(F.col("a"), F.col("b"))
    assert values(spark, rows, "a bigint, b bigint", ratio) == [33.33, None, None]
    assert one_column(spark, [0.1234], "double", numbers.percentage(F.col("x"))) == [Decimal("12.34")]
    earned = numbers.commission(F.col("a"), F.col("b"))
    assert values(spark, [(Decimal("10.05"), 0.1)], "a decimal(10,2), b double", earned) == [1.01]


def test_timestamp_text(spark):
    items = [
        "2024-05-01T10:20:30+05:00", "2024-05-01", "garbage", None, "1700000000", "1700000000000",
        "1700000000000000", "1700000000000000000", "2024-05-01 10:20:30.123456",
    ]
    epoch = datetime(2023, 11, 14, 22, 13, 20)
    assert one_column(spark, items, "string", times.parse_timestamp_text(F.col("x"))) == [
        datetime(2024, 5, 1, 10, 20, 30), datetime(2024, 5, 1), None, None, epoch, epoch, epoch, epoch,
        datetime(2024, 5, 1, 10, 20, 30, 123456),
    ]


def test_timestamp_text_does_not_depend_on_the_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        got = one_column(spark, ["1700000000"], "string", times.parse_timestamp_text(F.col("x")))
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert got == [datetime(2023, 11, 14, 22, 13, 20)]


def test_timestamp_of_leaves_timestamps_alone(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 1), "x")], "a timestamp_ntz, b string")
    assert "cast" not in plan_of(df.select(times.timestamp_of(df, "a").alias("a")))


def test_age(spark):
    items = [date(1990, 12, 31), date(2030, 1, 1), None, date(2024, 12, 31)]
    ages = one_column(spark, items, "date", times.age_in_years(F.col("x"), datetime(2025, 1, 1)))
    assert ages == [35, 0, None, 1]


def test_true_text(spark):
    items = ["true", "TRUE", "1", "yes", "no", "0", "True", None]
    cleaned = text.is_true_text(F.col("x"), CLEANING_TRUE_TEXT, ignore_case=True)
    assert one_column(spark, items, "string", cleaned) == [True, True, True, True, False, False, True, False]
    standard = text.is_true_text(F.col("x"), STANDARD_TRUE_TEXT, ignore_case=False)
    assert one_column(spark, items, "string", standard) == [True, True, True, False, False, False, False, False]
    assert one_column(spark, [True, False, None], "boolean", standard) == [True, False, False]
    assert one_column(spark, [1, 0], "int", cleaned) == [True, False]


def test_calendar(spark):
    days = [date(2023, 1, 1), date(2024, 2, 29), date(2025, 12, 31), date(2023, 1, 2), date(2023, 1, 7), None]
    assert one_column(spark, days, "date", times.weekday_number(F.col("x"))) == [0, 4, 3, 1, 6, None]
    assert one_column(spark, days, "date", times.is_weekend(F.col("x"))) == [True, False, False, False, True, None]
    assert one_column(spark, days, "date", times.month_start(F.col("x")))[1] == date(2024, 2, 1)


def test_bucket_cuts_toward_zero_and_keeps_null(spark):
    items = [datetime(1970, 1, 1, 0, 0, 59), datetime(1969, 12, 31, 23, 59, 50), None]
    assert one_column(spark, items, "timestamp_ntz", times.bucket_number(F.col("x"), 30)) == [1, 0, None]
    assert one_column(spark, items, "timestamp_ntz", times.bucket_start(F.col("x"), 30))[0] == datetime(1970, 1, 1, 0, 0, 30)


def test_text_rules(spark):
    assert values(spark, [(" a ", " b"), (None, "b")], "a string, b string",
                  text.full_name(F.col("a"), F.col("b"))) == ["a b", None]
    assert one_column(spark, ["  ", " x ", "\t", None], "string", text.blank_to_null(F.col("x"))) == [
        None, "x", "\t", None,
    ]
    df = spark.createDataFrame([(" a ", 1, "\tb ")], "s string, n int, t string")
    assert text.trim_strings(df).first() == ("a", 1, "\tb")
    assert text.upper_names(df).columns == ["S", "N", "T"]


def test_lookup_tables(spark):
    assert len(ISO_CODE_BY_COUNTRY) == 20
    assert len(CONTINENT_BY_DESTINATION) == 10
    iso = text.mapped(F.col("x"), ISO_CODE_BY_COUNTRY, "UN")
    assert one_column(spark, ["FRANCE", "france", "ATLANTIS", None], "string", iso) == ["FR", "UN", "UN", "UN"]


def test_surrogate_key(spark):
    assert one_column(spark, [1], "bigint", text.surrogate_key(F.col("x"))) == [hashlib.md5(b"1").hexdigest()]
    pair = text.surrogate_key(F.col("a"), F.col("b"))
    wanted = hashlib.md5(f"x-{SURROGATE_NULL}".encode()).hexdigest()
    assert values(spark, [("x", None)], "a string, b string", pair) == [wanted]


def test_wall_clock_rules_do_not_depend_on_the_zone(spark):
    skipped_hour = datetime(2024, 3, 10, 2, 30, 15, 120_000)  # not a time in New York
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.createDataFrame([(skipped_hour,)], "x timestamp_ntz")
        start, text_, now = df.select(
            times.bucket_start(F.col("x"), 30), times.iso_text(F.col("x")), times.utc_now()
        ).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert start == datetime(2024, 3, 10, 2, 30)
    assert text_ == skipped_hour.isoformat()
    assert abs((datetime.now(timezone.utc).replace(tzinfo=None) - now).total_seconds()) < 120
