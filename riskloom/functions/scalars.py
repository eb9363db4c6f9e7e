"""Scalar column helpers. All are plain Column expressions inside codegen."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.schemas import EARNED, FRACTION, MONEY

RATIO_SCALE = 6


def as_date(value: dt.date | Column | None) -> Column:
    """The reporting date as a Column; None means the day the query runs."""
    if value is None:
        return F.current_date()
    return value if isinstance(value, Column) else F.lit(value).cast("date")


def div0(numerator: Column, denominator: Column) -> Column:
    """Division giving 0 for a zero denominator and NULL for a NULL one."""
    return F.when(denominator == 0, F.lit(0)).otherwise(numerator / denominator)


def null_if_zero(value: Column) -> Column:
    return F.when(value != 0, value)


def ratio(numerator: Column, denominator: Column) -> Column:
    """:func:`div0` as a double with six decimals.

    Going through double keeps the six decimals whatever the decimal widths are.
    """
    quotient = F.round(numerator.cast("double") / denominator.cast("double"), RATIO_SCALE)
    return F.when(denominator == 0, F.lit(0.0)).otherwise(quotient)


def exceeds(numerator: Column, denominator: Column, limit: Decimal) -> Column:
    """Whether :func:`div0` of the two is above a limit that is not negative.

    Compares products, which are exact, where a rounded quotient might meet the limit.
    """
    top, bottom = limit.as_integer_ratio()
    left, right = numerator * F.lit(Decimal(bottom)), denominator * F.lit(Decimal(top))
    return (F.when(denominator == 0, F.when(numerator.isNotNull(), False))
            .when(denominator > 0, left > right).otherwise(left < right))


def falls_short(numerator: Column, denominator: Column, limit: Decimal) -> Column:
    """Whether :func:`div0` of the two is below a positive limit, exactly."""
    top, bottom = limit.as_integer_ratio()
    left, right = numerator * F.lit(Decimal(bottom)), denominator * F.lit(Decimal(top))
    return (F.when(denominator == 0, True)
            .when(denominator > 0, left < right).otherwise(left > right))


def days_between(start: Column, end: Column) -> Column:
    return F.datediff(end, start)


def month_start(date: Column) -> Column:
    """First day of the month, as a DATE."""
    return F.trunc(date, "month")


def earned_fraction(effective: Column, expiration: Column, as_of: Column,
                    clamp: bool = False) -> Column:
    """Elapsed share of the policy term on ``as_of``, with six decimals.

    The share is 1 from the expiration date on. Before the effective date it is
    negative, unless ``clamp`` asks for 0.
    """
    whole = T.DecimalType(10, 0)
    elapsed = days_between(effective, F.least(as_of, expiration)).cast(whole)
    term = days_between(effective, expiration).cast(whole)
    share = F.round(div0(elapsed, term), 6).cast(FRACTION)
    return F.greatest(share, F.lit(0).cast(FRACTION)) if clamp else share


def prorate(premium: Column, effective: Column, expiration: Column, as_of: Column,
            clamp: bool = False) -> Column:
    """Premium earned by ``as_of``, with eight decimals."""
    share = earned_fraction(effective, expiration, as_of, clamp)
    return (premium.cast(MONEY) * share).cast(EARNED)


def active_on(as_of: Column, effective: Column, expiration: Column) -> Column:
    """True when ``as_of`` lies in the term, both ends included."""
    return as_of.between(effective, expiration)


def total(value: Column, dtype: T.DecimalType) -> Column:
    """SUM held to a fixed decimal type (NULL when there is nothing to add)."""
    return F.sum(value).cast(dtype)
