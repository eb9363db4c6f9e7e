"""The analytic marts. Each returns exact decimals in its contracted column order."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions import (
    active_on,
    days_between,
    exceeds,
    falls_short,
    month_start,
    null_if_zero,
    prorate,
    ratio,
    total,
)
from riskloom.operators.bitmaps import distinct_counts, distinct_state, merge_distinct
from riskloom.operators.quantiles import merge_quantiles, quantile_state, quantiles
from riskloom.operators.spine import calendar, densify, running, running_totals, spine
from riskloom.plans.portfolio import FACT_MONTH, Portfolio
from riskloom.schemas import EARNED, EARNED_TOTAL, MONEY, MONEY_TOTAL

# Claim states, thresholds and labels of the marts.
CLOSED = "Closed"
UNRESOLVED = ("Open", "Pending")
OPEN_EXPOSURE_ABOVE = Decimal("0.5")
COLLECTION_BELOW = Decimal("0.5")
FREQUENCY_ABOVE = Decimal(2)
MEDIUM_SHARE = Decimal("0.5")
UNPROFITABLE_ABOVE = Decimal(1)
AT_RISK_ABOVE = Decimal("0.7")

# Columns of the marts, in their contracted order.
SEGMENT = ["policy_type", "industry", "state"]

POLICY_TOTALS = [
    "closed_claim_total", "op_claim_total", "payment_total", "endorsement_total",
    "prorated_premium", "policy_id", "customer_id", "policy_type", "effective_date",
    "expiration_date", "premium", "customer_name", "state", "industry",
]
TREND = [
    "month_start", "policy_type", "industry", "state", "claim_count", "claim_total",
    "closed_claim_total", "open_claim_total", "payment_count", "payment_total",
    "rolling_claim_total", "rolling_payment_total",
]
CUSTOMER_RISK = [
    "customer_id", "customer_name", "state", "industry", "total_policy_count",
    "active_policy_count", "total_premium", "total_prorated_premium",
    "total_payments_collected", "total_endorsements", "total_adjusted_premium",
    "total_closed_claims", "total_open_claims", "total_claims",
    "total_prorated_net_position", "total_net_position", "loss_ratio",
    "open_exposure_ratio", "collection_ratio", "avg_claims_per_policy", "collection_gap",
    "flag_open_exposure", "flag_collection", "flag_negative_position",
    "flag_high_frequency", "risk_score", "risk_tier",
]
PROFITABILITY = [
    "effective_month", "policy_type", "policy_count", "premium", "prorated_premium",
    "adjusted_premium", "collected_premium", "collection_gap", "closed_claims",
    "open_claims", "total_claims", "underwriting_profit", "rolling_underwriting_profit",
    "rolling_total_claims", "rolling_collected_premium", "loss_ratio",
    "rolling_loss_ratio", "profitability_status",
]


CUSTOMER = ["customer_id", "customer_name", "state", "industry"]
# Sums of the customer and month marts and the columns of the policy totals they add up.
CUSTOMER_MONEY = {
    "total_premium": "premium",
    "total_payments_collected": "payment_total",
    "total_endorsements": "endorsement_total",
    "total_closed_claims": "closed_claim_total",
    "total_open_claims": "op_claim_total",
}
MONTH_MONEY = {
    "premium": "premium",
    "collected_premium": "payment_total",
    "endorsement_total": "endorsement_total",
    "closed_claims": "closed_claim_total",
    "open_claims": "op_claim_total",
}


def _or_zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(0))


def _measures(df: DataFrame, keys: Sequence[str], values: Mapping[str, Column],
              all_names: Sequence[str]) -> DataFrame:
    """Keys and the given measures, with a typed NULL for every other measure."""
    return df.select(*keys, *[
        (values[n] if n in values else F.lit(None)).cast(MONEY).alias(n) for n in all_names
    ])


# -- policy totals -----------------------------------------------------------

FACT_TOTALS = ["closed_claim_total", "op_claim_total", "payment_total", "endorsement_total"]


def _fact_measures(book: Portfolio) -> list[tuple[DataFrame, dict[str, Column]]]:
    """Each fact table with the totals that its rows add to."""
    status, amount = F.col("claim_status"), F.col("claim_amount")
    claims = book.sound_claims(
        "policy_id",
        F.when(status == CLOSED, amount).alias("closed_claim_total"),
        F.when(status.isin(*UNRESOLVED), amount).alias("op_claim_total"),
    )
    return [
        (claims, {n: F.col(n) for n in FACT_TOTALS[:2]}),
        (book.sound_payments(), {"payment_total": F.col("payment_amount")}),
        (book.clean_endorsements(), {"endorsement_total": F.col("endorsement_amount")}),
    ]


def _per_policy(rows: DataFrame, names: Sequence[str]) -> DataFrame:
    return rows.filter(F.col("policy_id").isNotNull()).groupBy("policy_id").agg(
        *[total(F.col(n), MONEY_TOTAL).alias(n) for n in names])


def policy_facts(book: Portfolio) -> DataFrame:
    """Claims, payments and endorsements of each policy, in one aggregation.

    All three fact tables are stacked and summed together, so they cost one
    shuffle of partial sums. A policy without a kind of fact has NULL there.
    """
    parts = [_measures(rows, ["policy_id"], values, FACT_TOTALS)
             for rows, values in _fact_measures(book)]
    return _per_policy(parts[0].unionByName(parts[1]).unionByName(parts[2]), FACT_TOTALS)


def _with_facts(book: Portfolio) -> DataFrame:
    """Clean policies with their fact totals.

    Tables in buckets are summed and joined one by one where they lie: stacking would give
    up their layout.
    """
    policies = book.insured_policies()
    if not book.buckets:
        return policies.join(policy_facts(book), "policy_id", "left")
    for rows, values in _fact_measures(book):
        sums = _per_policy(_measures(rows, ["policy_id"], values, list(values)), list(values))
        policies = policies.join(sums, "policy_id", "left")
    return policies


def policy_totals(book: Portfolio, clamp: bool = False) -> DataFrame:
    """One row per clean policy: fact totals, earned premium and attributes.

    Facts are summed per policy before the join, so nothing fans out, and both
    sides arrive partitioned by ``policy_id``.
    """
    if "policy_totals" in book.written and not clamp:
        return book.written["policy_totals"]
    earned = prorate(F.col("premium"), F.col("effective_date"), F.col("expiration_date"),
                     book.today, clamp)
    return _with_facts(book).withColumn("prorated_premium", earned).select(*POLICY_TOTALS)


def prorated_premium(book: Portfolio, clamp: bool = False) -> DataFrame:
    """Earned premium of every clean policy."""
    earned = prorate(F.col("premium"), F.col("effective_date"), F.col("expiration_date"),
                     book.today, clamp)
    return book.insured_policies().select("policy_id", "premium", earned.alias("prorated_premium"))


def loss_ratio_by_type(book: Portfolio) -> DataFrame:
    """Claims over earned premium plus endorsements, per policy type."""
    sums = policy_totals(book).groupBy("policy_type").agg(
        (_or_zero(total(F.col("closed_claim_total"), MONEY_TOTAL))
         + _or_zero(total(F.col("op_claim_total"), MONEY_TOTAL))).alias("total_claims"),
        (total(F.col("prorated_premium"), EARNED_TOTAL)
         + _or_zero(total(F.col("endorsement_total"), MONEY_TOTAL))).alias("adjusted_premium"),
    )
    return sums.withColumn(
        "loss_ratio", ratio(F.col("total_claims"), F.col("adjusted_premium"))
    ).orderBy(F.col("loss_ratio").desc_nulls_first())


# -- claims and payments trend -------------------------------------------------

CLAIM_MEASURES = {
    "claim_count": "bigint",
    "claim_total": "decimal(26,2)",
    "closed_claim_total": "decimal(26,2)",
    "open_claim_total": "decimal(26,2)",
}
PAYMENT_MEASURES = {"payment_count": "bigint", "payment_total": "decimal(26,2)"}


def _claim_rows(book: Portfolio) -> DataFrame:
    status, amount = F.col("claim_status"), F.col("claim_amount")
    return book.sound_claims(
        "policy_id",
        book.month_of("claims").alias("month_start"),
        amount.alias("claim_total"),
        F.when(status == CLOSED, amount).otherwise(0).alias("closed_claim_total"),
        F.when(status.isin(*UNRESOLVED), amount).otherwise(0).alias("open_claim_total"),
    ).withColumn("claim_count", F.lit(1)).drop("claim_id")


def _payment_rows(book: Portfolio, payments: DataFrame | None = None) -> DataFrame:
    return (book.sound_payments() if payments is None else payments).select(
        "policy_id",
        book.month_of("payments").alias("month_start"),
        F.when(F.col("payment_id").isNotNull(), 1).otherwise(0).alias("payment_count"),
        F.col("payment_amount").alias("payment_total"),
    )


def policy_months(rows: DataFrame, measures: Mapping[str, str]) -> DataFrame:
    """Sums per policy and month.

    They leave a policy with at most one row per month, so a policy holding much
    of the table is small before it is joined.
    """
    return rows.filter(F.col("policy_id").isNotNull()).groupBy("policy_id", "month_start").agg(
        *[F.sum(m).cast(dtype).alias(m) for m, dtype in measures.items()])


def _segment_months(policies: DataFrame, sums: DataFrame, measures: Mapping[str, str],
                    how: str) -> DataFrame:
    """Policy-month sums added up per month and segment of their clean policy."""
    joined = policies.select("policy_id", *SEGMENT).join(sums, "policy_id", how)
    return _per_segment(joined, measures)


def _per_segment(joined: DataFrame, measures: Mapping[str, str]) -> DataFrame:
    return joined.groupBy("month_start", *SEGMENT).agg(
        *[F.sum(m).cast(dtype).alias(m) for m, dtype in measures.items()])


def _monthly(book: Portfolio, rows: DataFrame, measures: Mapping[str, str],
             month: str) -> DataFrame:
    sums = policy_months(rows, measures)
    return (
        _segment_months(book.insured_policies(), sums, measures, "inner")
        .withColumnRenamed("month_start", month)
        .select(month, *measures, *SEGMENT)
    )


def monthly_claims(book: Portfolio) -> DataFrame:
    """Claim count and sums per month, policy type, industry and state."""
    return _monthly(book, _claim_rows(book), CLAIM_MEASURES, "claim_month")


def monthly_payments(book: Portfolio) -> DataFrame:
    """Payment count and sum per month, policy type, industry and state."""
    return _monthly(book, _payment_rows(book), PAYMENT_MEASURES, "payment_month")


def policy_segments(book: Portfolio) -> DataFrame:
    """Distinct policy type, industry and state of the clean policies."""
    return book.insured_policies().select(*SEGMENT).distinct()


def calendar_spine(book: Portfolio) -> DataFrame:
    """Every segment in every month of the calendar."""
    return spine(policy_segments(book), book.start, book.today)


TREND_MEASURES = {**CLAIM_MEASURES, **PAYMENT_MEASURES}
TREND_TOTALS = {"rolling_claim_total": "claim_total", "rolling_payment_total": "payment_total"}


def activity(book: Portfolio) -> DataFrame:
    """Claims and payments as rows of one shape, by policy and month."""
    return _claim_rows(book).unionByName(_payment_rows(book), allowMissingColumns=True)


def _in_calendar(book: Portfolio) -> tuple[DataFrame, DataFrame]:
    """Claims and payments of the calendar alone: by the stored month where facts are laid out
    by it, and payments by their date, so that the scan can leave others out."""
    inside = F.col("month_start").between(book.start, F.trunc(book.today, "month"))
    paid = book.sound_payments()
    if FACT_MONTH not in paid.columns:
        after = F.add_months(F.trunc(book.today, "month"), 1)
        paid = paid.filter((F.col("payment_date") >= book.start) & (F.col("payment_date") < after))
    return _claim_rows(book).filter(inside), _payment_rows(book, paid).filter(inside)


def _trend_cells(book: Portfolio) -> DataFrame:
    """Month sums of every segment that has policies, those without facts with a NULL month."""
    claims, payments = _in_calendar(book)
    policies = book.insured_policies()
    if not book.buckets:
        rows = claims.unionByName(payments, allowMissingColumns=True)
        return _segment_months(policies, policy_months(rows, TREND_MEASURES), TREND_MEASURES, "left")
    # Tables in buckets meet their policies one by one where they lie.
    named = policies.select("policy_id", *SEGMENT)
    claimed = named.join(policy_months(claims, CLAIM_MEASURES), "policy_id", "left")
    paid = named.join(policy_months(payments, PAYMENT_MEASURES), "policy_id")
    return _per_segment(claimed.unionByName(paid, allowMissingColumns=True), TREND_MEASURES)


def complete_segment() -> Column:
    """Facts of a segment with a NULL belong to no series."""
    complete = F.lit(True)
    for key in SEGMENT:
        complete = complete & F.col(key).isNotNull()
    return complete


def finish_trend(rolled: DataFrame) -> DataFrame:
    order = [F.col(c).asc_nulls_last() for c in [*SEGMENT, "month_start"]]
    return rolled.select(*TREND).orderBy(*order)


def payment_claims_trend(book: Portfolio) -> DataFrame:
    """Dense month x segment series of claims and payments with running totals.

    Policies without facts stay in the join, so that every segment is there.
    """
    series = _trend_cells(book).withColumn(
        "month_start", F.when(complete_segment(), F.col("month_start")))
    dense = densify(series, SEGMENT, "month_start", list(TREND_MEASURES),
                    calendar(book.start, book.today))
    return finish_trend(running_totals(dense, SEGMENT, "month_start", TREND_TOTALS))


# -- customer risk -------------------------------------------------------------

def customer_rollup(book: Portfolio) -> DataFrame:
    """Policy totals summed per customer.

    Policy totals have one row per policy, so counting rows counts distinct
    policies; a distinct aggregation would shuffle them a second time.
    """
    active = active_on(book.today, F.col("effective_date"), F.col("expiration_date"))
    sums = policy_totals(book).groupBy(*CUSTOMER).agg(
        F.count("policy_id").alias("total_policy_count"),
        F.count(F.when(active, F.col("policy_id"))).alias("active_policy_count"),
        total(F.col("prorated_premium"), EARNED_TOTAL).alias("total_prorated_premium"),
        *[total(F.col(c), MONEY_TOTAL).alias(name) for name, c in CUSTOMER_MONEY.items()],
    )
    return finish_rollup(sums)


def finish_rollup(sums: DataFrame) -> DataFrame:
    """The customer's figures that follow from counts and sums."""
    endorsed = _or_zero(F.col("total_endorsements"))
    claimed = (_or_zero(F.col("total_closed_claims")) + _or_zero(F.col("total_open_claims"))
               ).cast(MONEY_TOTAL)
    adjusted = F.col("total_prorated_premium") + endorsed
    derived = {
        "total_adjusted_premium": adjusted,
        "total_claims": claimed,
        "total_prorated_net_position": adjusted - claimed,
        "total_net_position": F.col("total_premium") + endorsed - claimed,
    }
    return sums.withColumns(derived).select(*CUSTOMER_RISK[:16])


def _flag(condition: Column) -> Column:
    return F.when(condition, 1).otherwise(0)


def customer_risk(book: Portfolio, frequency: str = "amount",
                  rollup: DataFrame | None = None) -> DataFrame:
    """Ratios, four 0/1 flags, score and tier of every customer.

    ``frequency="amount"`` flags customers by claimed amount per policy, which is
    how the mart is defined; ``"count"`` uses the number of claims per policy.
    ``rollup`` may hand in the customers' sums.
    """
    rollup = customer_rollup(book) if rollup is None else rollup
    per_policy = ratio(F.col("total_claims"), null_if_zero(F.col("total_policy_count")))
    if frequency == "count":
        claims = _claims_per_customer(book)
        rollup = rollup.join(claims, "customer_id", "left")
        claimed = _or_zero(F.col("_claim_count"))
    elif frequency == "amount":
        claimed = F.col("total_claims")
    else:
        raise ValueError("frequency is 'amount' or 'count'")

    adjusted = F.col("total_adjusted_premium")
    rated = rollup.withColumns({
        "loss_ratio": ratio(F.col("total_claims"), adjusted),
        "open_exposure_ratio": ratio(F.col("total_open_claims"), adjusted),
        "collection_ratio": ratio(F.col("total_payments_collected"), adjusted),
        "avg_claims_per_policy": per_policy,
        "collection_gap": adjusted - F.col("total_payments_collected"),
    })
    flagged = rated.withColumns({
        "flag_open_exposure": _flag(exceeds(
            F.col("total_open_claims"), null_if_zero(F.col("total_claims")), OPEN_EXPOSURE_ABOVE)),
        "flag_collection": _flag(falls_short(
            F.col("total_payments_collected"), adjusted, COLLECTION_BELOW)),
        "flag_negative_position": _flag(F.col("total_prorated_net_position") < 0),
        "flag_high_frequency": _flag(exceeds(
            claimed, null_if_zero(F.col("total_policy_count")), FREQUENCY_ABOVE)),
    })
    scored = flagged.withColumn("risk_score", (
        F.col("flag_open_exposure") + F.col("flag_collection")
        + F.col("flag_negative_position") + F.col("flag_high_frequency")
    ))
    score, policies = F.col("risk_score"), F.col("total_policy_count")
    tiers = [
        (score > policies, "High", 3),
        (score > policies * F.lit(MEDIUM_SHARE), "Medium", 2),
        (score > 0, "Low", 1),
    ]
    label, rank = F.lit("No Risk"), F.lit(0)
    for condition, name, position in reversed(tiers):
        label = F.when(condition, F.lit(name)).otherwise(label)
        rank = F.when(condition, F.lit(position)).otherwise(rank)
    return scored.withColumns({"risk_tier": label, "_rank": rank}).orderBy(
        F.col("_rank").desc_nulls_first(),
        F.col("risk_score").desc_nulls_first(),
        F.col("loss_ratio").desc_nulls_first(),
        # Ties are common at the low end; the key lets the sort split them.
        F.col("customer_id"),
    ).select(*CUSTOMER_RISK)


def _claims_per_customer(book: Portfolio) -> DataFrame:
    per_policy = book.sound_claims("policy_id").filter(F.col("policy_id").isNotNull()).groupBy(
        "policy_id").agg(F.count(F.lit(1)).alias("_claim_count"))
    owners = book.insured_policies().select("policy_id", "customer_id")
    return per_policy.join(owners, "policy_id").groupBy("customer_id").agg(
        F.sum("_claim_count").alias("_claim_count"))


def tier_distribution(book: Portfolio) -> DataFrame:
    """Customers per risk tier."""
    counts = customer_risk(book).groupBy("risk_tier").agg(
        F.count(F.lit(1)).alias("customer_count"))
    return counts.orderBy(F.col("customer_count").desc_nulls_first())


# -- profitability -------------------------------------------------------------

def profitability_monthly(book: Portfolio) -> DataFrame:
    """Totals per effective month and policy type."""
    # The month is named first: a summed column shares its name with a source one.
    totals = policy_totals(book).withColumn("effective_month", month_start(F.col("effective_date")))
    return finish_months(totals.groupBy("effective_month", "policy_type").agg(
        F.count("policy_id").alias("policy_count"),
        total(F.col("prorated_premium"), EARNED_TOTAL).alias("prorated_premium"),
        *[total(F.col(c), MONEY_TOTAL).alias(name) for name, c in MONTH_MONEY.items()],
    ))


def finish_months(sums: DataFrame) -> DataFrame:
    """The month's figures that follow from counts and sums."""
    claimed = (_or_zero(F.col("closed_claims")) + _or_zero(F.col("open_claims"))).cast(MONEY_TOTAL)
    adjusted = F.col("prorated_premium") + _or_zero(F.col("endorsement_total"))
    return sums.withColumns({
        "adjusted_premium": adjusted,
        "total_claims": claimed,
        "underwriting_profit": adjusted - claimed,
        "collection_gap": F.col("premium") - _or_zero(F.col("collected_premium")),
    }).select(*PROFITABILITY[:12])


# Running sums of the monitor; the adjusted premium's is only needed for the ratio.
MONITOR_TOTALS = {
    "rolling_underwriting_profit": "underwriting_profit",
    "rolling_total_claims": "total_claims",
    "rolling_collected_premium": "collected_premium",
    "rolling_adjusted_premium": "adjusted_premium",
}


def rolled_months(monthly: DataFrame) -> DataFrame:
    """Monthly totals with their running sums per policy type."""
    return running_totals(monthly, ["policy_type"], "effective_month", MONITOR_TOTALS)


def finish_monitor(rolled: DataFrame) -> DataFrame:
    """Ratios and status of months with running sums, in the mart's order."""
    rated = rolled.withColumns({
        "loss_ratio": ratio(F.col("total_claims"), F.col("adjusted_premium")),
        "rolling_loss_ratio": ratio(F.col("rolling_total_claims"),
                                    null_if_zero(F.col("rolling_adjusted_premium"))),
    })
    status = (
        F.when(exceeds(F.col("total_claims"), F.col("adjusted_premium"), UNPROFITABLE_ABOVE),
               "Unprofitable")
        .when(exceeds(F.col("total_claims"), F.col("adjusted_premium"), AT_RISK_ABOVE), "At Risk")
        .otherwise("Healthy")
    )
    return rated.withColumn("profitability_status", status).select(*PROFITABILITY).orderBy(
        F.col("policy_type").asc_nulls_last(), F.col("effective_month").asc_nulls_last())


def _monitor(monthly: DataFrame) -> DataFrame:
    return finish_monitor(rolled_months(monthly))


def profitability_monitor(book: Portfolio) -> DataFrame:
    """Monthly and cumulative profit, loss ratios and status per policy type."""
    return _monitor(profitability_monthly(book))


def rolling_loss_ratio(book: Portfolio) -> DataFrame:
    """Cumulative claims over cumulative adjusted premium, per policy type."""
    return _monitor(profitability_monthly(book)).select(
        "policy_type", "effective_month", "rolling_loss_ratio")


def profitability_dense(book: Portfolio) -> DataFrame:
    """The monitor without gaps: each type from its first month to the reporting date.

    A month without policies has zero sums and carries the running totals on.
    """
    last = F.greatest("_last", "_first", month_start(book.today))
    months = F.sequence("_first", last, F.expr("interval 1 month"))
    return _monitor(densify(profitability_monthly(book), ["policy_type"], "effective_month",
                            PROFITABILITY[2:12], months))


# -- accident year -------------------------------------------------------------

def accident_year_loss_ratio(book: Portfolio) -> DataFrame:
    """Claims by year of loss over the premium earned in that year, per type.

    A policy's premium is split by the days of its term that fall in each year,
    up to the reporting date.
    """
    policies = book.insured_policies().select(
        "policy_id", "policy_type", "effective_date", "expiration_date", "premium")
    until = F.least(book.today, F.col("expiration_date"))
    year = F.col("accident_year")
    opened = F.greatest(F.make_date(year, F.lit(1), F.lit(1)), F.col("effective_date"))
    closed = F.least(F.make_date(year + 1, F.lit(1), F.lit(1)), until)
    whole = "decimal(10,0)"
    share = F.round(
        days_between(opened, closed).cast(whole)
        / days_between(F.col("effective_date"), F.col("expiration_date")).cast(whole), 6
    ).cast("decimal(18,6)")
    earned = (
        policies.filter(F.col("effective_date") < until)
        .withColumn("accident_year", F.explode(
            F.sequence(F.year("effective_date"), F.year(F.date_sub(until, 1)))))
        .select("accident_year", "policy_type",
                (F.col("premium").cast(MONEY) * share).cast(EARNED).alias("earned_premium"),
                F.lit(None).cast(MONEY_TOTAL).alias("claim_total"))
    )
    losses = (
        book.sound_claims("policy_id", "claim_date", "claim_amount")
        .filter(F.col("policy_id").isNotNull() & F.col("claim_date").isNotNull())
        .groupBy("policy_id", F.year("claim_date").alias("accident_year"))
        .agg(total(F.col("claim_amount"), MONEY_TOTAL).alias("claim_total"))
        .join(policies.select("policy_id", "policy_type"), "policy_id")
        .select("accident_year", "policy_type",
                F.lit(None).cast(EARNED).alias("earned_premium"), "claim_total")
    )
    years = earned.unionByName(losses).groupBy("accident_year", "policy_type").agg(
        _or_zero(total(F.col("earned_premium"), EARNED_TOTAL)).alias("earned_premium"),
        _or_zero(total(F.col("claim_total"), MONEY_TOTAL)).alias("claim_total"),
    )
    return years.withColumn("loss_ratio", ratio(F.col("claim_total"), F.col("earned_premium"))
                            ).orderBy("accident_year", F.col("policy_type").asc_nulls_last())


# -- distinct counts and quantiles at several grains -------------------------------

DISTINCT = ("policies_with_claims", "policies_with_open_claims", "policies_with_payments")


def policy_bitmaps(book: Portfolio) -> DataFrame:
    """Bitmaps of the policies with claims, open claims and payments per segment and month.

    Facts collapse to one row per policy and month before they meet the policies.
    """
    status = F.col("claim_status")
    claims = book.sound_claims(
        "policy_id", book.month_of("claims").alias("month_start"),
        F.coalesce(status.isin(*UNRESOLVED), F.lit(False)).alias("open")).select(
        "policy_id", "month_start", F.lit(True).alias("claim"), "open",
        F.lit(False).alias("payment"))
    payments = book.sound_payments().select(
        "policy_id", book.month_of("payments").alias("month_start"), F.lit(False).alias("claim"),
        F.lit(False).alias("open"), F.lit(True).alias("payment"))
    months = claims.unionByName(payments).filter(F.col("policy_id").isNotNull()).groupBy(
        "policy_id", "month_start").agg(*[F.max(c).alias(c) for c in ("claim", "open", "payment")])
    placed = book.insured_policies().select("policy_id", *SEGMENT).join(months, "policy_id")
    return distinct_state(placed, [*SEGMENT, "month_start"], "policy_id", dict(zip(
        DISTINCT, (F.col("claim"), F.col("open"), F.col("payment")))))


def distinct_policies(book: Portfolio, state: DataFrame | None = None) -> DataFrame:
    """Distinct policies with facts per segment and month, per policy type and in all.

    The coarser counts come from the finer bitmaps alone.
    """
    state = policy_bitmaps(book) if state is None else state
    columns = [*SEGMENT, "month_start"]
    parts = []
    for level, keys in (("cell", columns), ("policy_type", ["policy_type"]), ("all", [])):
        merged = state if keys == columns else merge_distinct(state, keys, DISTINCT)
        counts = distinct_counts(merged, keys, DISTINCT)
        parts.append(counts.select(F.lit(level).alias("level"), *[
            F.col(c) if c in keys else F.lit(None).cast(state.schema[c].dataType).alias(c)
            for c in columns], *DISTINCT))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


CALIBRATED = ("loss_ratio", "open_exposure_ratio", "collection_ratio", "avg_claims_per_policy")
PROBABILITIES = (0.25, 0.5, 0.75, 0.9, 0.95)


def threshold_calibration(book: Portfolio, risk: DataFrame | None = None,
                          probabilities: Sequence[float] = PROBABILITIES) -> DataFrame:
    """Quantiles of the ratios behind the risk flags, to set their thresholds by loss history.

    Per industry and state, per industry and in all; the coarser sketches are merged from the
    finer ones. See :mod:`riskloom.operators.quantiles` for the error.
    """
    risk = customer_risk(book) if risk is None else risk
    cells = F.array(*[F.struct(F.lit(m).alias("measure"), F.col(m).cast("double").alias("ratio"))
                      for m in CALIBRATED])
    rows = risk.select("industry", "state", F.explode(cells).alias("c")).select(
        "industry", "state", "c.*")
    columns = ["industry", "state"]
    state = quantile_state(rows, [*columns, "measure"], F.col("ratio"))
    parts = []
    for level, keys in (("segment", columns), ("industry", ["industry"]), ("all", [])):
        merged = state if keys == columns else merge_quantiles(state, [*keys, "measure"])
        found = quantiles(merged, [*keys, "measure"], probabilities)
        parts.append(found.select(F.lit(level).alias("level"), *[
            F.col(c) if c in keys else F.lit(None).cast(risk.schema[c].dataType).alias(c)
            for c in columns], "measure", "probability", "value_count", "value"))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])
