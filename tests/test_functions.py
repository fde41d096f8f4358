import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark import functions as tf

ZONE = "America/Los_Angeles"


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()[0]


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("the oak-view", "The Oak-View"),
        ("o'hara plan II", "O'hara Plan Ii"),
        ("a_b.c/d(e)", "A_B.C/D(E)"),
        ("", ""),
        (None, None),
    ],
)
def test_capitalise_words(spark, text, expected):
    assert one(spark, tf.capitalise_words(F.lit(text).cast("string"))) == expected


def test_first_group_is_null_without_match(spark):
    assert one(spark, tf.first_group(F.lit("Patient/7"), "Patient/(.*)")) == "7"
    assert one(spark, tf.first_group(F.lit("Device/7"), "Patient/(.*)")) is None


@pytest.mark.parametrize(
    ("text", "expected"),
    [("450000", 450000.0), ("450000.50", 450000.5), ("1f", None), ("NaN", None), ("Under Contract", None), (None, None)],
)
def test_try_double(spark, text, expected):
    assert one(spark, tf.try_double(F.lit(text).cast("string"))) == expected


def test_decimals_round_and_overflow_to_null(spark):
    assert one(spark, tf.try_decimal(F.lit("2.25"))) == Decimal("2.3")
    assert one(spark, tf.try_decimal(F.lit("1234567"))) is None
    assert one(spark, tf.number_or_null(F.lit("1.5"))) == 2
    assert one(spark, tf.number_or_null(F.lit("two"))) is None


def test_rounded_long_goes_away_from_zero(spark):
    assert [one(spark, tf.rounded_long(F.lit(x))) for x in (2.5, -2.5, 2.4)] == [3, -3, 2]


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("2024-01-02T03:04:05Z", dt.datetime(2024, 1, 2, 3, 4, 5)),
        ("2024-01-02T03:04:05.250+02:00", dt.datetime(2024, 1, 2, 1, 4, 5, 250000)),
        ("2024-01-02", None),
        ("2024-01-02T25:00:00Z", None),
        ("2024-01-02T03:04:05", None),
        (None, None),
    ],
)
def test_parse_instant(spark, text, expected):
    assert one(spark, tf.parse_instant(F.lit(text).cast("string"))) == expected


def test_local_time_follows_daylight_saving(spark):
    summer, winter = F.lit("2024-07-01 06:30:00").cast("timestamp"), F.lit("2024-01-01 07:30:00").cast("timestamp")
    assert one(spark, tf.local_date(summer, ZONE)) == dt.date(2024, 6, 30)
    assert one(spark, tf.local_datetime(winter, ZONE)) == dt.datetime(2023, 12, 31, 23, 30)
    assert one(spark, tf.local_noon(F.lit("2024-07-01"), ZONE)) == dt.datetime(2024, 7, 1, 19)
    assert one(spark, tf.local_noon(F.lit("2024-01-01"), ZONE)) == dt.datetime(2024, 1, 1, 20)
