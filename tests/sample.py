"""A hand-made book of policies: one row per rule that needs an example."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from riskloom.plans.portfolio import Portfolio
from riskloom.schemas import stored

AS_OF = dt.date(2025, 1, 1)
START = dt.date(2024, 5, 1)
LOADED = dt.datetime(2025, 1, 1, 6)


def d(text: str | None) -> dt.date | None:
    return dt.date.fromisoformat(text) if text else None


def m(text: str | None) -> Decimal | None:
    return Decimal(text) if text is not None else None


CUSTOMERS = [
    (1, "Ash, Birch and Co", "TX", "Retail"),
    (2, "Cedar Ltd", "NY", "Marine"),
    (3, "Doubled", "IL", "Retail"),
    (3, "Doubled", "IL", "Retail"),
    (4, "Elm", "NY", None),          # no industry
    (5, "Fir", "CA", "Farming"),
    (6, "Gum", "CA", "Farming"),
    (None, "Nobody", "CA", "Farming"),
]
POLICIES = [
    # id, customer, type, effective, expiration, premium
    (1, 1, "Auto", "2024-01-01", "2025-01-01", "1200.00"),
    (2, 1, "Auto", "2024-07-01", "2025-07-01", "730.00"),
    (3, 2, "Marine", "2024-02-01", "2025-02-01", "0.00"),        # zero premium: out, untagged
    (4, 2, "Marine", "2024-02-01", "2025-02-01", None),          # INVALID_AMOUNT
    (5, 2, "Marine", "2024-02-01", "2025-02-01", "-5.00"),       # INVALID_AMOUNT
    (6, 2, "Marine", "2024-02-01", "2024-02-01", "100.00"),      # INVALID_DATES (equal)
    (7, 2, "Marine", None, "2025-02-01", "100.00"),              # no date: out, untagged
    (8, 99, "Auto", "2024-02-01", "2025-02-01", "100.00"),       # ORPHAN_FK
    (9, None, "Auto", "2024-02-01", "2025-02-01", "100.00"),     # no customer: out, untagged
    (10, 2, "Marine", "2024-03-01", "2025-03-01", "400.00"),     # twin below is invalid: stays
    (10, 2, "Marine", "2024-03-01", "2025-03-01", "-1.00"),
    (11, 2, "Marine", "2024-03-01", "2025-03-01", "500.00"),     # duplicate: both out
    (11, 2, "Marine", "2024-03-01", "2025-03-01", "500.00"),
    (12, 3, "Auto", "2024-03-01", "2025-03-01", "500.00"),       # repeated customer: out
    (13, 4, "Property", "2024-06-01", "2025-06-01", "365.00"),   # customer without industry
    (14, 5, "Property", "2025-03-01", "2026-03-01", "365.00"),   # starts after the report date
    (15, 6, "Property", "2024-01-01", "2024-12-31", "100.00"),   # zero adjusted premium
    (16, 5, "Auto", "2024-01-01", "2024-07-01", "50.00"),        # neither claims nor payments
]
CLAIMS = [
    (1, 1, "2024-05-10", "100.00", "Closed"),
    (2, 1, "2024-06-10", "50.00", "Open"),
    (3, 2, "2024-08-01", "25.00", "Pending"),
    (4, 2, "2024-08-02", "10.00", "Disputed"),   # state outside the known three
    (5, 1, "2024-05-11", "999.00", "Open"),      # duplicate key, both out
    (5, 777, "2024-05-11", "999.00", "Open"),
    (6, 4, "2024-05-11", "12.00", "Open"),       # policy was excluded
    (None, 1, "2024-05-12", "13.00", "Open"),    # no key
    (None, 1, "2024-05-13", "14.00", "Open"),
    (7, 10, "2024-04-30", "7.00", "Closed"),     # before the calendar
    (8, 13, "2024-07-01", "20.00", "Open"),      # segment without industry
    (9, 15, "2024-09-01", "40.00", "Open"),
    (10, None, "2024-09-01", "41.00", "Open"),   # no policy
    (11, 8, "2024-05-11", "3.00", "Open"),       # rejected twice over, identical rows
    (11, 8, "2024-05-11", "3.00", "Open"),
]
PAYMENTS = [
    (1, 1, "2024-05-20", "300.00"),
    (2, 1, "2025-02-01", "10.00"),       # after expiration and after the calendar
    (3, 2, "2024-08-20", "-30.00"),      # credit: kept
    (4, 4, "2024-05-20", "5.00"),        # policy was excluded
    (5, 10, "2024-06-01", "200.00"),
    (6, 13, "2024-06-15", "365.00"),
    (7, 15, "2024-12-01", "1.00"),
    (7, 15, "2024-12-02", "2.00"),       # payments may repeat a key
    (8, None, "2024-12-02", "9.00"),
]
ENDORSEMENTS = [
    ("-20.00", "2024-06-01", 1, "Coverage Increase", 1),     # contradicts its type
    ("15.00", "2024-06-01", 2, "Coverage Reduction", 2),     # contradicts its type
    ("5.00", "2024-06-01", 3, "Coverage Increase", 2),
    ("-100.00", "2024-11-01", 4, "Cancellation", 15),        # brings adjusted premium to zero
    ("1.00", "2024-11-20", 5, "Cancellation", 15),
    ("-1.00", "2024-11-20", 6, "Coverage Reduction", 15),
    ("9.00", "2024-11-20", 7, "Coverage Reduction", 4),      # policy was excluded
]

CLEAN_POLICIES = {1, 2, 10, 13, 14, 15, 16}
CLEAN_CLAIMS = {1, 2, 3, 4, 7, 8, 9}


def portfolio(spark, **parameters) -> Portfolio:
    def frame(table, rows):
        return spark.createDataFrame([(*r, LOADED) for r in rows], stored(table)).coalesce(1)

    parameters = {"as_of": AS_OF, "spine_start": START, **parameters}
    return Portfolio({
        "customers": frame("customers", CUSTOMERS),
        "policies": frame("policies", [
            (i, c, t, d(a), d(b), m(p)) for i, c, t, a, b, p in POLICIES]),
        "claims": frame("claims", [(i, p, d(on), m(a), s) for i, p, on, a, s in CLAIMS]),
        "payments": frame("payments", [(i, p, d(on), m(a)) for i, p, on, a in PAYMENTS]),
        "endorsements": frame("endorsements", [
            (m(a), d(on), i, t, p) for a, on, i, t, p in ENDORSEMENTS]),
    }, **parameters)
