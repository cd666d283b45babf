import math

import pytest
from pyspark.sql import functions as F

from almanack import functions as X


def value(spark, column):
    return spark.range(1).select(column).first()[0]


@pytest.mark.parametrize("year, key", [(2018, "Y18_W2"), (2001, "Y1_W2"), (1999, "Y999_W2")])
def test_season_week_key_is_not_padded(spark, year, key):
    assert value(spark, X.season_week_key(F.lit(year), F.lit(2))) == key


def test_underscored_is_null_if_a_part_is(spark):
    assert value(spark, X.underscored(F.lit("a"), F.lit("b"), F.lit("c"))) == "a_b_c"
    assert value(spark, X.underscored(F.lit("a"), F.lit(None).cast("string"))) is None


def test_mean_fahrenheit(spark):
    assert value(spark, X.mean_fahrenheit(F.lit(300.0), F.lit(100.0))) == pytest.approx(68.0)


@pytest.mark.parametrize("text, number", [("1.5", 1.5), (" 2 ", 2.0), ("T", -1.0), ("", -1.0)])
def test_number_or_default(spark, text, number):
    assert value(spark, X.number_or(F.lit(text))) == number


def test_drop_ends(spark):
    assert value(spark, X.drop_ends(F.lit("LAUCN2700503"), 3, 2)) == "CN27005"
    assert value(spark, X.drop_ends(F.lit("abcd"), 3, 2)) == ""
    assert value(spark, X.drop_ends(F.lit("M10"), 1)) == "10"


def test_char_range_counts_from_zero(spark):
    assert value(spark, X.char_range(F.lit("0123456789"), 2, 5)) == "234"


def test_decade(spark):
    assert [value(spark, X.decade(F.lit(y))) for y in (1990, 1999, 2000)] == [1990, 1990, 2000]


def test_day_angle_turns_once_in_365_days(spark):
    date = F.to_date(F.lit("2017-12-31"))
    assert value(spark, X.day_angle(date)) == pytest.approx(2 * math.pi)
