"""Fixed schemas of the five tables and the decimal types used on top of them.

Decimal widths are chosen so that no sum, product or difference in the marts
outgrows 38 digits, which would make Spark silently drop fractional digits.
"""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)
MONEY_TOTAL = T.DecimalType(26, 2)
FRACTION = T.DecimalType(18, 6)
EARNED = T.DecimalType(26, 8)
EARNED_TOTAL = T.DecimalType(32, 8)

LOADED_AT = "_insrt_ts"


def _table(*columns: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in columns])


# Table layouts, in the column order consumers rely on.
CUSTOMERS = _table(
    ("customer_id", T.LongType()),
    ("customer_name", T.StringType()),
    ("state", T.StringType()),
    ("industry", T.StringType()),
)
POLICIES = _table(
    ("policy_id", T.LongType()),
    ("customer_id", T.LongType()),
    ("policy_type", T.StringType()),
    ("effective_date", T.DateType()),
    ("expiration_date", T.DateType()),
    ("premium", MONEY),
)
CLAIMS = _table(
    ("claim_id", T.LongType()),
    ("policy_id", T.LongType()),
    ("claim_date", T.DateType()),
    ("claim_amount", MONEY),
    ("claim_status", T.StringType()),
)
PAYMENTS = _table(
    ("payment_id", T.LongType()),
    ("policy_id", T.LongType()),
    ("payment_date", T.DateType()),
    ("payment_amount", MONEY),
)
ENDORSEMENTS = _table(
    ("endorsement_amount", MONEY),
    ("endorsement_date", T.DateType()),
    ("endorsement_id", T.LongType()),
    ("endorsement_type", T.StringType()),
    ("policy_id", T.LongType()),
)

TABLES = {
    "customers": CUSTOMERS,
    "policies": POLICIES,
    "claims": CLAIMS,
    "payments": PAYMENTS,
    "endorsements": ENDORSEMENTS,
}


def stored(table: str) -> T.StructType:
    """Schema of a loaded table: the file columns plus the load time."""
    fields = TABLES[table].fields + [T.StructField(LOADED_AT, T.TimestampNTZType(), True)]
    return T.StructType(fields)
