"""Reconciliations between layers, and invariants that return offending rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.functions import exceeds, prorate, ratio
from riskloom.operators.fingerprints import compare_parts, differing_keys
from riskloom.operators.observe import LoadMetrics
from riskloom.operators.reconcile import figures, reconcile
from riskloom.plans import marts
from riskloom.plans.portfolio import Portfolio
from riskloom.schemas import MONEY_TOTAL

TOLERANCE = 0.01


def reconcile_totals(book: Portfolio) -> DataFrame:
    """Sums of the per-policy, per-customer and monthly marts against the clean views."""
    totals = marts.policy_totals(book)
    customers = marts.customer_rollup(book)
    months = marts.profitability_monthly(book)
    policies = book.insured_policies()
    earned = prorate(F.col("premium"), F.col("effective_date"), F.col("expiration_date"), book.today)
    claims = F.sum("claim_amount")
    payments = F.sum("payment_amount")
    return reconcile([
        figures(totals, "left", {
            "policy_totals.claims": (F.coalesce(F.sum("closed_claim_total"), F.lit(0))
                                     + F.coalesce(F.sum("op_claim_total"), F.lit(0))),
            "policy_totals.payments": F.sum("payment_total"),
            "policy_totals.endorsements": F.sum("endorsement_total"),
            "policy_totals.premium": F.sum("premium"),
            "policy_totals.prorated_premium": F.sum("prorated_premium"),
        }),
        figures(customers, "left", {
            "customer_risk.claims": F.sum("total_claims"),
            "customer_risk.payments": F.sum("total_payments_collected"),
        }),
        figures(months, "left", {
            "profitability.premium": F.sum("premium"),
            "profitability.claims": F.sum("total_claims"),
        }),
        figures(policies, "right", {
            "policy_totals.premium": F.sum("premium"),
            "policy_totals.prorated_premium": F.sum(earned),
            "profitability.premium": F.sum("premium"),
        }),
        figures(book.clean_claims(), "right", {
            "policy_totals.claims": claims,
            "customer_risk.claims": claims,
            "profitability.claims": claims,
        }),
        figures(book.clean_payments(), "right", {
            "policy_totals.payments": payments,
            "customer_risk.payments": payments,
        }),
        figures(book.clean_endorsements(), "right", {
            "policy_totals.endorsements": F.sum("endorsement_amount"),
        }),
    ])


# What each written table is observed for, and the pairs of figures that have to agree.
def load_measures(book: Portfolio) -> dict[str, dict[str, Column]]:
    """Sums taken of each table of a build as it is written."""
    earned = prorate(F.col("premium"), F.col("effective_date"), F.col("expiration_date"), book.today)
    return {
        "policies": {"premium": F.sum("premium"), "earned": F.sum(earned)},
        "claims": {"amount": F.sum("claim_amount")},
        "payments": {"amount": F.sum("payment_amount")},
        "endorsements": {"amount": F.sum("endorsement_amount")},
        "policy_totals": {
            "claims": (F.coalesce(F.sum("closed_claim_total"), F.lit(0))
                       + F.coalesce(F.sum("op_claim_total"), F.lit(0))),
            "payments": F.sum("payment_total"), "endorsements": F.sum("endorsement_total"),
            "premium": F.sum("premium"), "earned": F.sum("prorated_premium")},
        "customer_rollup": {"claims": F.sum("total_claims"),
                            "payments": F.sum("total_payments_collected")},
        "profitability": {"premium": F.sum("premium"), "claims": F.sum("total_claims")},
    }


OBSERVED_PAIRS = {
    "policy_totals.claims": (("policy_totals", "claims"), ("claims", "amount")),
    "policy_totals.payments": (("policy_totals", "payments"), ("payments", "amount")),
    "policy_totals.endorsements": (("policy_totals", "endorsements"), ("endorsements", "amount")),
    "policy_totals.premium": (("policy_totals", "premium"), ("policies", "premium")),
    "policy_totals.prorated_premium": (("policy_totals", "earned"), ("policies", "earned")),
    "customer_risk.claims": (("customer_rollup", "claims"), ("claims", "amount")),
    "customer_risk.payments": (("customer_rollup", "payments"), ("payments", "amount")),
    "profitability.premium": (("profitability", "premium"), ("policies", "premium")),
    "profitability.claims": (("profitability", "claims"), ("claims", "amount")),
}


def reconcile_observed(spark: SparkSession, metrics: LoadMetrics,
                       tolerance: float = 0.0) -> DataFrame:
    """The figures of :func:`reconcile_totals` from what was observed while writing.

    Nothing is read: the figures lie with the driver, or beside the tables.
    """
    rows = []
    for name, (left, right) in OBSERVED_PAIRS.items():
        one, two = metrics.value(*left), metrics.value(*right)
        rows.append((name, one, two, one - two, abs(one - two) <= tolerance))
    return spark.createDataFrame(
        rows, "check_name string, left_value decimal(36,8), right_value decimal(36,8), "
              "difference decimal(36,8), passed boolean")


def reconcile_fingerprints(spark: SparkSession, book: Portfolio,
                           totals: DataFrame | None = None) -> DataFrame:
    """Marts against sums of the clean facts, key by key.

    Gives ``check_name, left_rows, right_rows, differing_keys, passed``. Errors that cancel
    each other in a total are found; only parts of the key space that differ are looked at
    closely.
    """
    totals = marts.policy_totals(book) if totals is None else totals
    status, amount = F.col("claim_status"), F.col("claim_amount")
    closed = F.sum(F.when(status == marts.CLOSED, amount)).cast(MONEY_TOTAL)
    unresolved = F.sum(F.when(status.isin(*marts.UNRESOLVED), amount)).cast(MONEY_TOTAL)
    claims = book.clean_claims().groupBy("policy_id").agg(
        closed.alias("closed_claim_total"), unresolved.alias("op_claim_total"))
    claimed = "closed_claim_total IS NOT NULL OR op_claim_total IS NOT NULL"
    payments = book.clean_payments().groupBy("policy_id").agg(
        F.sum("payment_amount").cast(MONEY_TOTAL).alias("payment_total"))
    owners = book.insured_policies().select("policy_id", "customer_id")
    per_customer = claims.filter(claimed).join(owners, "policy_id").groupBy("customer_id").agg(
        F.sum(F.coalesce("closed_claim_total", F.lit(0)) + F.coalesce("op_claim_total", F.lit(0)))
        .cast(MONEY_TOTAL).alias("total_claims"))
    rollup = marts.customer_rollup(book).filter(
        "total_closed_claims IS NOT NULL OR total_open_claims IS NOT NULL")
    pairs = {
        "policy_totals.claims": (totals.filter(claimed), claims.filter(claimed), "policy_id",
                                 ["closed_claim_total", "op_claim_total"]),
        "policy_totals.payments": (totals.filter("payment_total IS NOT NULL"), payments,
                                   "policy_id", ["payment_total"]),
        "customer_risk.claims": (rollup, per_customer, "customer_id", ["total_claims"]),
    }
    rows = []
    for name, (left, right, key, columns) in pairs.items():
        # At most as many rows as there are parts of the key space.
        parts = compare_parts(left, right, key, columns).collect()
        wrong = [p.part for p in parts if not p.passed]
        keys = differing_keys(left, right, key, columns, wrong).count() if wrong else 0
        rows.append((name, sum(p.left_rows for p in parts), sum(p.right_rows for p in parts),
                     keys, not wrong))
    return spark.createDataFrame(rows, "check_name string, left_rows bigint, right_rows bigint, "
                                       "differing_keys bigint, passed boolean")


def reconcile_trend(book: Portfolio) -> DataFrame:
    """Sums of the trend against the clean facts.

    Fails, as it should, when facts fall outside the calendar.
    """
    return reconcile([
        figures(marts.payment_claims_trend(book), "left", {
            "trend.claims": F.sum("claim_total"),
            "trend.payments": F.sum("payment_total"),
        }),
        figures(book.clean_claims(), "right", {"trend.claims": F.sum("claim_amount")}),
        figures(book.clean_payments(), "right", {"trend.payments": F.sum("payment_amount")}),
    ])


def grain(book: Portfolio) -> DataFrame:
    """Row counts of the marts against the entities they stand for."""
    policies = book.insured_policies()
    # Both sides are reduced to distinct keys before they meet.
    insured = book.clean_customers().select("customer_id").distinct().join(
        policies.select("customer_id").distinct(), "customer_id", "left_semi")
    return reconcile([
        figures(marts.customer_risk(book), "left", {
            "customer_risk.customers": F.count(F.lit(1)),
        }),
        figures(insured, "right", {
            "customer_risk.customers": F.count_distinct("customer_id"),
        }),
        figures(marts.profitability_monthly(book), "left", {
            "profitability.policies": F.sum("policy_count"),
        }),
        figures(policies, "right", {"profitability.policies": F.count(F.lit(1))}),
    ])


def negative_loss_ratio(book: Portfolio) -> DataFrame:
    """Number of policies with a loss ratio below zero."""
    claims = F.col("closed_claim_total") + F.col("op_claim_total")
    adjusted = F.col("prorated_premium") + F.coalesce(F.col("endorsement_total"), F.lit(0))
    return marts.policy_totals(book).agg(
        F.count_if(ratio(claims, adjusted) < 0).alias("invalid_loss_ratios"))


def date_coverage(book: Portfolio) -> DataFrame:
    """First and last date of the trend calendar, the clean claims and the clean payments."""

    def span(df: DataFrame, column: str, source: str) -> DataFrame:
        return df.agg(F.min(column).alias("first_date"), F.max(column).alias("last_date")).select(
            F.lit(source).alias("source"), "first_date", "last_date")

    return reduce(DataFrame.unionByName, [
        span(marts.payment_claims_trend(book), "month_start", "trend"),
        span(book.clean_claims(), "claim_date", "claims"),
        span(book.clean_payments(), "payment_date", "payments"),
    ])


def flag_domain(book: Portfolio, risk: DataFrame | None = None) -> DataFrame:
    """Customers of a risk mart with a flag other than 0 or 1. Expected: none."""
    flags = ["flag_open_exposure", "flag_collection", "flag_negative_position",
             "flag_high_frequency"]
    outside = reduce(lambda a, b: a | b, [~F.col(f).isin(0, 1) for f in flags])
    return (marts.customer_risk(book) if risk is None else risk).filter(outside)


def status_thresholds(book: Portfolio, monitor: DataFrame | None = None) -> DataFrame:
    """Months of a monitor whose status contradicts their loss ratio. Expected: none."""
    status = F.col("profitability_status")
    above = {limit: F.coalesce(exceeds(F.col("total_claims"), F.col("adjusted_premium"), limit),
                               F.lit(False))
             for limit in (marts.UNPROFITABLE_ABOVE, marts.AT_RISK_ABOVE)}
    wrong = (
        ((status == "Unprofitable") & ~above[marts.UNPROFITABLE_ABOVE])
        | ((status == "At Risk") & ~above[marts.AT_RISK_ABOVE])
        | ((status == "Healthy") & above[marts.AT_RISK_ABOVE])
    )
    return (marts.profitability_monitor(book) if monitor is None else monitor).filter(wrong)


def profit_identity(book: Portfolio, monitor: DataFrame | None = None) -> DataFrame:
    """Months of a monitor whose profit is not adjusted premium less claims. Expected: none."""
    gap = F.col("underwriting_profit") - (F.col("adjusted_premium") - F.col("total_claims"))
    return (marts.profitability_monitor(book) if monitor is None else monitor).filter(
        F.abs(gap) > TOLERANCE)


def table_row_counts(book: Portfolio) -> DataFrame:
    """Rows per raw table."""
    tables = {
        "CUSTOMERS": book.customers,
        "POLICIES": book.policies,
        "CLAIMS": book.claims,
        "PAYMENTS": book.payments,
        "ENDORSEMENTS": book.endorsements,
    }
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts).orderBy(F.col("table_name").asc_nulls_last())
