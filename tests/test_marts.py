import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from tests import sample
from riskloom.functions import exceeds, falls_short
from riskloom.plans import checks, marts


def by(df, *keys):
    return {tuple(r[k] for k in keys) if len(keys) > 1 else r[keys[0]]: r for r in df.collect()}


@pytest.fixture(scope="module")
def book(spark):
    return sample.portfolio(spark)


# -- policy totals -----------------------------------------------------------------

def test_policy_totals(book):
    df = marts.policy_totals(book)
    assert df.columns == marts.POLICY_TOTALS
    got = by(df, "policy_id")
    assert set(got) == sample.CLEAN_POLICIES
    first = got[1]
    assert (first.closed_claim_total, first.op_claim_total) == (D("100.00"), D("50.00"))
    assert (first.payment_total, first.endorsement_total) == (D("310.00"), D("-20.00"))
    assert first.prorated_premium == D("1200")
    # An unknown claim state counts in neither total; no fact of a kind means NULL.
    assert (got[2].closed_claim_total, got[2].op_claim_total) == (None, D("25.00"))
    assert got[2].prorated_premium == D("730.00") * D("0.504110")
    assert got[10].endorsement_total is None and got[10].op_claim_total is None
    assert [got[16][c] for c in marts.POLICY_TOTALS[:4]] == [None] * 4
    assert got[14].prorated_premium == D("365.00") * D("-0.161644")


def test_proration_can_be_clamped(book):
    got = by(marts.policy_totals(book, clamp=True), "policy_id")
    assert got[14].prorated_premium == 0 and got[1].prorated_premium == D("1200")
    assert by(marts.prorated_premium(book), "policy_id")[14].prorated_premium < 0


def test_loss_ratio_by_type(book):
    got = by(marts.loss_ratio_by_type(book), "policy_type")
    assert got["Marine"].total_claims == D("7.00")
    assert got["Marine"].loss_ratio == round(7 / 335.3424, 6)
    ordered = [r.loss_ratio for r in marts.loss_ratio_by_type(book).collect()]
    assert ordered == sorted(ordered, reverse=True)


# -- trend --------------------------------------------------------------------------

def test_trend(book):
    df = marts.payment_claims_trend(book)
    assert df.columns == marts.TREND
    rows = df.collect()
    assert len(rows) == 9 * marts.policy_segments(book).count() == 45
    months = by(df, "policy_type", "industry", "state", "month_start")
    may = months[("Auto", "Retail", "TX", dt.date(2024, 5, 1))]
    assert (may.claim_count, may.claim_total, may.closed_claim_total) == (1, 100, 100)
    assert (may.payment_count, may.payment_total) == (1, 300)
    august = months[("Auto", "Retail", "TX", dt.date(2024, 8, 1))]
    # The disputed claim is in the total but in neither state.
    assert (august.claim_count, august.claim_total, august.open_claim_total) == (2, 35, 25)
    last = months[("Auto", "Retail", "TX", dt.date(2025, 1, 1))]
    assert (last.claim_total, last.rolling_claim_total, last.rolling_payment_total) == (0, 185, 270)
    # A fact before the calendar and facts of a segment with a NULL drop out.
    assert months[("Marine", "Marine", "NY", dt.date(2025, 1, 1))].rolling_claim_total == 0
    assert months[("Property", None, "NY", dt.date(2025, 1, 1))].rolling_payment_total == 0
    assert months[("Property", "Farming", "CA", dt.date(2024, 12, 1))].payment_count == 2


def test_trend_is_ordered(book):
    rows = [tuple((v is None, v) for v in (r.policy_type, r.industry, r.state)) + (r.month_start,)
            for r in marts.payment_claims_trend(book).collect()]
    assert rows == sorted(rows)


def test_monthly_facts(book):
    claims = by(marts.monthly_claims(book), "policy_type", "industry", "claim_month")
    assert claims[("Marine", "Marine", dt.date(2024, 4, 1))].claim_count == 1
    assert claims[("Property", None, dt.date(2024, 7, 1))].open_claim_total == 20
    payments = by(marts.monthly_payments(book), "policy_type", "industry", "payment_month")
    assert payments[("Auto", "Retail", dt.date(2025, 2, 1))].payment_total == 10
    assert payments[("Auto", "Retail", dt.date(2024, 8, 1))].payment_total == -30


# -- customer risk --------------------------------------------------------------------

FLAGS = ["flag_open_exposure", "flag_collection", "flag_negative_position", "flag_high_frequency"]


def test_customer_risk(book):
    df = marts.customer_risk(book)
    assert df.columns == marts.CUSTOMER_RISK
    got = by(df, "customer_id")
    assert {c: ([r[f] for f in FLAGS], r.risk_tier) for c, r in got.items()} == {
        1: ([0, 1, 0, 1], "Medium"),
        2: ([0, 0, 0, 1], "Medium"),
        4: ([1, 0, 0, 1], "High"),
        5: ([0, 0, 1, 0], "Low"),        # no payments: no collection flag
        6: ([1, 1, 1, 1], "High"),
    }
    first = got[1]
    assert (first.total_policy_count, first.active_policy_count) == (2, 2)
    assert first.total_adjusted_premium == D("1568.0003")
    assert (first.total_claims, first.total_payments_collected) == (175, 280)
    assert first.loss_ratio == round(175 / 1568.0003, 6)
    assert first.open_exposure_ratio == round(75 / 1568.0003, 6)
    assert first.avg_claims_per_policy == 87.5
    assert first.total_net_position == D("1930.00") - 175
    assert (got[5].collection_ratio, got[5].collection_gap) == (None, None)
    assert (got[6].loss_ratio, got[6].collection_ratio) == (0.0, 0.0)


def test_customer_risk_by_claim_count(book):
    got = by(marts.customer_risk(book, frequency="count"), "customer_id")
    assert [got[c].flag_high_frequency for c in (1, 2, 4, 5, 6)] == [0, 0, 0, 0, 0]
    with pytest.raises(ValueError):
        marts.customer_risk(book, frequency="often")


def test_customer_risk_order(book):
    rows = marts.customer_risk(book).collect()
    assert [r.customer_id for r in rows] == [6, 4, 1, 2, 5]


def test_counting_rows_counts_distinct_policies(book):
    totals = marts.policy_totals(book)
    distinct = {r.customer_id: r.n for r in totals.groupBy("customer_id").agg(
        F.count_distinct("policy_id").alias("n")).collect()}
    assert {r.customer_id: r.total_policy_count
            for r in marts.customer_rollup(book).collect()} == distinct


def test_tier_distribution(book):
    assert {tuple(r) for r in marts.tier_distribution(book).collect()} == {
        ("High", 2), ("Medium", 2), ("Low", 1)}


# -- profitability ----------------------------------------------------------------------

def test_profitability(book):
    df = marts.profitability_monitor(book)
    assert df.columns == marts.PROFITABILITY
    got = by(df, "policy_type", "effective_month")
    january = got[("Auto", dt.date(2024, 1, 1))]
    assert (january.policy_count, january.premium, january.adjusted_premium) == (2, 1250, 1230)
    assert (january.total_claims, january.underwriting_profit) == (150, 1080)
    assert (january.collected_premium, january.collection_gap) == (310, 940)
    july = got[("Auto", dt.date(2024, 7, 1))]
    assert july.rolling_underwriting_profit == D("1443.0003")
    assert july.rolling_loss_ratio == round(175 / 1618.0003, 6)
    zero = got[("Property", dt.date(2024, 1, 1))]
    assert (zero.loss_ratio, zero.rolling_loss_ratio) == (0.0, None)
    assert zero.profitability_status == "Healthy"
    future = got[("Property", dt.date(2025, 3, 1))]
    assert (future.collected_premium, future.rolling_collected_premium) == (None, 368)
    assert future.collection_gap == 365


def test_dense_profitability_has_no_gaps(book):
    got = by(marts.profitability_dense(book), "policy_type", "effective_month")
    auto = sorted(month for kind, month in got if kind == "Auto")
    assert len(auto) == 13 and auto[-1] == dt.date(2025, 1, 1)
    quiet = got[("Auto", dt.date(2024, 3, 1))]
    assert (quiet.policy_count, quiet.premium, quiet.loss_ratio) == (0, 0, 0.0)
    assert quiet.rolling_underwriting_profit == 1080
    sparse = by(marts.profitability_monitor(book), "policy_type", "effective_month")
    for key, row in sparse.items():
        assert got[key].rolling_underwriting_profit == row.rolling_underwriting_profit


def test_accident_years_add_up_to_earned_premium(book):
    years = marts.accident_year_loss_ratio(book).collect()
    earned = sum(r.earned_premium for r in years)
    begun = sum(r.prorated_premium for r in marts.prorated_premium(book).collect()
                if r.prorated_premium > 0)
    assert abs(earned - begun) < D("0.01")
    assert sum(r.claim_total for r in years) == 252
    assert {r.accident_year for r in years} == {2024}


# -- checks -------------------------------------------------------------------------------

def test_totals_reconcile_except_for_excluded_endorsements(book):
    got = {r.check_name: r for r in checks.reconcile_totals(book).collect()}
    failed = [name for name, row in got.items() if not row.passed]
    # The disputed claim is in no policy total; one endorsement is on an excluded policy.
    assert sorted(failed) == ["customer_risk.claims", "policy_totals.claims",
                              "policy_totals.endorsements", "profitability.claims"]
    assert got["policy_totals.claims"].difference == -10
    assert got["policy_totals.endorsements"].difference == -9


def test_trend_check_finds_facts_outside_the_calendar(book):
    got = {r.check_name: r for r in checks.reconcile_trend(book).collect()}
    assert got["trend.claims"].difference == -(7 + 20)
    assert got["trend.payments"].difference == -(10 + 365)


def test_grain(book):
    assert all(r.passed for r in checks.grain(book).collect())


def test_checks_find_doctored_rows(book):
    risk, monitor = marts.customer_risk(book), marts.profitability_monitor(book)
    assert checks.flag_domain(book, risk.withColumn("flag_collection", F.lit(2))).count() == risk.count()
    sound = monitor.filter("profitability_status <> 'Unprofitable'").count()
    assert checks.status_thresholds(
        book, monitor.withColumn("profitability_status", F.lit("Unprofitable"))).count() == sound > 0
    assert checks.profit_identity(book, monitor.withColumn(
        "underwriting_profit", F.col("underwriting_profit") + 1)).count() == monitor.count()


def test_limits_are_met_exactly(spark):
    """Quotients that a rounding to six decimals would put on the limit."""
    rows = spark.createDataFrame([
        (D("5000003.00"), D("10000000.00")),
        (D("4999997.00"), D("10000000.00")),
        (D("5000000.00"), D("10000000.00")),
        (D("1.00"), D("0.00")), (D("-1.00"), D("-1.00")),
    ], "n decimal(26,2), d decimal(32,8)")
    half = D("0.5")
    got = rows.select(exceeds(F.col("n"), F.col("d"), half),
                      falls_short(F.col("n"), F.col("d"), half)).collect()
    assert [tuple(r) for r in got] == [(True, False), (False, True), (False, False),
                                       (False, True), (True, False)]


def test_invariants_hold(book):
    for check in (checks.flag_domain, checks.status_thresholds, checks.profit_identity):
        assert check(book).count() == 0
    assert checks.negative_loss_ratio(book).first()[0] == 0


def test_date_coverage(book):
    got = by(checks.date_coverage(book), "source")
    assert (got["trend"].first_date, got["trend"].last_date) == (
        dt.date(2024, 5, 1), dt.date(2025, 1, 1))
    assert got["claims"].first_date == dt.date(2024, 4, 30)
    assert got["payments"].last_date == dt.date(2025, 2, 1)


def test_row_counts(book):
    assert [tuple(r) for r in checks.table_row_counts(book).collect()] == [
        ("CLAIMS", 15), ("CUSTOMERS", 8), ("ENDORSEMENTS", 7), ("PAYMENTS", 9), ("POLICIES", 18)]
