import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from riskloom.functions import (
    active_on, as_date, days_between, div0, earned_fraction, month_start, null_if_zero, prorate, ratio)


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()[0]


def money(text):
    return F.lit(text).cast("decimal(18,2)")


def date(text):
    return F.lit(text).cast("date")


@pytest.mark.parametrize("a, b, expected", [
    ("1", "3", 0.333333), ("1", "0", 0.0), (None, "0", 0.0), (None, "2", None), ("1", None, None),
    ("-2", "3", -0.666667),
])
def test_division_is_safe(spark, a, b, expected):
    assert value(spark, ratio(money(a), money(b))) == expected
    plain = value(spark, div0(money(a), money(b)))
    assert (None if plain is None else round(float(plain), 6)) == expected


def test_zero_denominator_becomes_null_when_asked(spark):
    assert value(spark, ratio(money("1"), null_if_zero(money("0")))) is None


def test_days_run_from_start_to_end(spark):
    assert value(spark, days_between(date("2024-01-01"), date("2024-03-01"))) == 60


def test_month_start_is_a_date(spark):
    assert value(spark, month_start(date("2024-02-29"))) == dt.date(2024, 2, 1)


@pytest.mark.parametrize("as_of, clamp, expected", [
    ("2024-07-01", False, "0.497268"),    # 182 of 366 days
    ("2025-06-01", False, "1.000000"),    # expired: fully earned
    ("2023-12-31", False, "-0.002732"),   # not started: negative
    ("2023-12-31", True, "0.000000"),
])
def test_earned_fraction(spark, as_of, clamp, expected):
    share = earned_fraction(date("2024-01-01"), date("2025-01-01"), date(as_of), clamp)
    assert value(spark, share) == Decimal(expected)


def test_prorated_premium_keeps_eight_decimals(spark):
    earned = prorate(money("1234.57"), date("2024-01-01"), date("2025-01-01"), date("2024-07-01"))
    assert value(spark, earned) == Decimal("1234.57") * Decimal("0.497268")


@pytest.mark.parametrize("on, expected", [
    ("2024-01-01", True), ("2025-01-01", True), ("2025-01-02", False), ("2023-12-31", False)])
def test_term_includes_both_ends(spark, on, expected):
    assert value(spark, active_on(date(on), date("2024-01-01"), date("2025-01-01"))) is expected


def test_report_date_defaults_to_today(spark):
    assert value(spark, as_date(None)) == value(spark, F.current_date())
