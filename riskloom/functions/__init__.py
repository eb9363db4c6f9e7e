"""Column helpers shared by every plan."""

from riskloom.functions.scalars import (
    RATIO_SCALE,
    active_on,
    as_date,
    days_between,
    div0,
    earned_fraction,
    exceeds,
    falls_short,
    month_start,
    null_if_zero,
    prorate,
    ratio,
    total,
)

__all__ = [
    "RATIO_SCALE",
    "active_on",
    "as_date",
    "days_between",
    "div0",
    "earned_fraction",
    "exceeds",
    "falls_short",
    "month_start",
    "null_if_zero",
    "prorate",
    "ratio",
    "total",
]
