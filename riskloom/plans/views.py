"""Named views, for use from SQL."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession

from riskloom.plans import findings, marts
from riskloom.plans.portfolio import Portfolio


def view_plans(book: Portfolio) -> dict[str, Callable[[], DataFrame]]:
    """Every raw table, clean view, audit view and mart by its name."""
    return {
        # The view names.
        "customers": lambda: book.customers,
        "policies": lambda: book.policies,
        "claims": lambda: book.claims,
        "payments": lambda: book.payments,
        "endorsements": lambda: book.endorsements,
        "customers_v": book.clean_customers,
        "policies_v": book.clean_policies,
        "claims_v": book.clean_claims,
        "payments_v": book.clean_payments,
        "endorsements_v": book.clean_endorsements,
        "policies_tagged_v": lambda: findings.tagged_policies(book),
        "claims_tagged_v": lambda: findings.tagged_claims(book),
        "payments_tagged_v": lambda: findings.tagged_payments(book),
        "customers_tagged_v": lambda: findings.tagged_customers(book),
        "endorsements_tagged_v": lambda: findings.tagged_endorsements(book),
        "claims_dq_v": book.rejected_claims,
        "payments_dq_v": book.rejected_payments,
        "policy_totals_v": lambda: marts.policy_totals(book),
        "payment_claims_trend_v": lambda: marts.payment_claims_trend(book),
        "customer_risk_v": lambda: marts.customer_risk(book),
        "profitability_monitor_v": lambda: marts.profitability_monitor(book),
    }


def register(spark: SparkSession, book: Portfolio, prefix: str = "",
             names: Iterable[str] | None = None) -> list[str]:
    """Create temporary views, all or the named ones; nothing runs until queried."""
    plans = view_plans(book)
    chosen = list(plans if names is None else names)
    for name in chosen:
        plans[name]().createOrReplaceTempView(f"{prefix}{name}")
    return [f"{prefix}{name}" for name in chosen]
