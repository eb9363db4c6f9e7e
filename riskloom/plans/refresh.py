"""Marts that keep up with arrivals: only the policies that changed are worked out again.

A refresh compares two small portfolios, the touched policies before and after the arrivals.
Their policy totals are the images that leave and enter the marts: customer and month sums
take them as signed changes, the monitor's and the trend's running sums go on from the last
row before the first changed one. Facts of other policies are not looked at.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.functions import active_on, month_start, prorate
from riskloom.operators.deltas import (
    SIGN,
    merge_state,
    resume_totals,
    settled,
    signed,
    state_of,
)
from riskloom.operators.skew import lookup_join
from riskloom.operators.spine import calendar, densify
from riskloom.plans import marts
from riskloom.plans.portfolio import Portfolio
from riskloom.schemas import EARNED_TOTAL, MONEY_TOTAL, TABLES
from riskloom.sources.tables import VersionedTable


def touched_policies(book: Portfolio, policies: DataFrame | None = None,
                     customers: DataFrame | None = None, claims: DataFrame | None = None,
                     payments: DataFrame | None = None,
                     endorsements: DataFrame | None = None) -> DataFrame:
    """Keys of the policies whose totals newly arrived rows can change.

    ``book`` already holds the arrivals. A new claim also touches the policies of
    older claims with the same key, which it turns into duplicates, and a customer
    touches all of its policies. Write the result before refreshing with it: it is
    used several times.
    """
    parts = [df.select("policy_id") for df in (policies, claims, payments, endorsements)
             if df is not None]
    if claims is not None:
        twins = lookup_join(book.claims.select("claim_id", "policy_id"),
                            claims.select("claim_id").distinct(), "claim_id", "left_semi",
                            book.hot_rows)
        parts.append(twins.select("policy_id"))
    if customers is not None:
        owned = lookup_join(book.policies.select("customer_id", "policy_id"),
                            customers.select("customer_id").distinct(), "customer_id",
                            "left_semi", book.hot_rows)
        parts.append(owned.select("policy_id"))
    keys = reduce(DataFrame.unionByName, parts)
    return keys.filter(F.col("policy_id").isNotNull()).distinct()


def part_of(book: Portfolio, touched: DataFrame) -> Portfolio:
    """The portfolio of the touched policies alone."""
    def of_touched(df: DataFrame) -> DataFrame:
        return lookup_join(df, touched, "policy_id", "left_semi", book.hot_rows)

    # Every raw claim that shares a key with a claim of a touched policy is needed
    # to tell which keys are unique.
    claim_keys = of_touched(book.claims.select("claim_id", "policy_id")).select(
        "claim_id").distinct()
    return book.with_tables(
        policies=of_touched(book.policies),
        claims=lookup_join(book.claims, claim_keys, "claim_id", "left_semi", book.hot_rows),
        payments=of_touched(book.payments),
        endorsements=of_touched(book.endorsements),
    )


def refresh_policy_totals(previous: DataFrame, book: Portfolio, touched: DataFrame) -> DataFrame:
    """Policy totals of ``book``, recomputed for the touched policies only.

    Earned premium moves with the reporting date, so it is computed anew for the
    carried rows too; that needs nothing but the row itself.
    """
    carried = previous.join(touched, "policy_id", "left_anti").withColumn(
        "prorated_premium",
        prorate(F.col("premium"), F.col("effective_date"), F.col("expiration_date"), book.today))
    return carried.select(*marts.POLICY_TOTALS).unionByName(
        marts.policy_totals(part_of(book, touched)))


# -- signed images -------------------------------------------------------------

def changed_images(before: Portfolio, after: Portfolio, previous: DataFrame | None = None,
                   touched: DataFrame | None = None) -> DataFrame:
    """Policy totals of touched policies as they leave (-1) and enter (1) the marts.

    ``before`` and ``after`` hold the touched policies only. When the reporting date moves
    on, policies in their term earn on: ``previous``, the totals as of the old date, then
    gives the images of those that are not ``touched``, again without their facts. It cannot
    move back, as policies that expired between the dates would have to be looked for.
    """
    def images(book: Portfolio, day) -> DataFrame:
        return marts.policy_totals(book).withColumn("_active", active_on(
            day, F.col("effective_date"), F.col("expiration_date")))

    moved = signed(images(before, before.today), images(after, after.today))
    if before.as_of == after.as_of:
        return moved
    if before.as_of is None or after.as_of is None or after.as_of < before.as_of:
        raise ValueError("the reporting date can only move on, from one given date to another")
    if previous is None or touched is None:
        raise ValueError("a moved reporting date needs the previous totals and the touched keys")
    running = previous.join(touched, "policy_id", "left_anti").filter(
        F.col("expiration_date") >= before.today).select(*marts.POLICY_TOTALS)
    term = F.col("effective_date"), F.col("expiration_date")
    aged = running.withColumn("prorated_premium", prorate(F.col("premium"), *term, after.today))
    return moved.unionByName(signed(
        running.withColumn("_active", active_on(before.today, *term)),
        aged.withColumn("_active", active_on(after.today, *term))))


# -- customers -----------------------------------------------------------------

def customer_state(images: DataFrame) -> DataFrame:
    """Additive state of the customer rollup, or its change by signed images."""
    sums = {"total_prorated_premium": (F.col("prorated_premium"), EARNED_TOTAL)}
    sums |= {name: (F.col(c), MONEY_TOTAL) for name, c in marts.CUSTOMER_MONEY.items()}
    return state_of(images, marts.CUSTOMER, sums, {
        "total_policy_count": F.col("policy_id").isNotNull(),
        "active_policy_count": F.col("_active")})


def customer_state_of(book: Portfolio) -> DataFrame:
    """The state from scratch; write it, and refresh it from then on."""
    return customer_state(marts.policy_totals(book).withColumn("_active", active_on(
        book.today, F.col("effective_date"), F.col("expiration_date"))))


def refresh_customers(state: DataFrame, images: DataFrame) -> DataFrame:
    """The state after the images: write it as the next one."""
    return merge_state(state, customer_state(images), marts.CUSTOMER)


def customer_risk_of(book: Portfolio, state: DataFrame) -> DataFrame:
    """The customer risk mart from a state."""
    return marts.customer_risk(book, rollup=marts.finish_rollup(settled(state)))


# -- months ----------------------------------------------------------------------

MONTH = ["effective_month", "policy_type"]


def month_state(images: DataFrame) -> DataFrame:
    """Additive state of the profitability months, or its change by signed images."""
    named = images.withColumn("effective_month", month_start(F.col("effective_date")))
    sums = {name: (F.col(f"_{c}"), MONEY_TOTAL) for name, c in marts.MONTH_MONEY.items()}
    sums["prorated_premium"] = (F.col("_prorated_premium"), EARNED_TOTAL)
    # A sum may be named like the column it adds up.
    source = named.select(*MONTH, "policy_id", *[c for c in (SIGN,) if c in named.columns],
                          F.col("prorated_premium").alias("_prorated_premium"),
                          *[F.col(c).alias(f"_{c}") for c in marts.MONTH_MONEY.values()])
    return state_of(source, MONTH, sums, {"policy_count": F.col("policy_id").isNotNull()})


def month_state_of(book: Portfolio) -> DataFrame:
    return month_state(marts.policy_totals(book))


def refresh_months(state: DataFrame, images: DataFrame) -> DataFrame:
    return merge_state(state, month_state(images), MONTH)


def monitor_rows(state: DataFrame) -> DataFrame:
    """Months with running sums, from a state: the table that the monitor is read from."""
    return marts.rolled_months(marts.finish_months(settled(state)))


def refresh_monitor(previous: DataFrame, state: DataFrame, images: DataFrame) -> DataFrame:
    """Months with running sums after the images.

    ``previous`` are the :func:`monitor_rows` before, ``state`` the month state after. Running
    sums are redone from the first touched month of each policy type on.
    """
    firsts = month_state(images).groupBy("policy_type").agg(
        F.min("effective_month").alias("_first"))
    months = marts.finish_months(settled(state))
    changed = firsts.select(F.col("policy_type").alias("_type"), F.col("_first").alias("_from"))
    fresh = months.join(changed, F.col("policy_type").eqNullSafe(F.col("_type"))
                        & (F.col("effective_month") >= F.col("_from"))).select(*months.columns)
    return resume_totals(previous, fresh, firsts, ["policy_type"], "effective_month",
                         marts.MONITOR_TOTALS)


# -- trend -------------------------------------------------------------------------

CELL = [*marts.SEGMENT, "month_start"]


def _segment_facts(book: Portfolio) -> DataFrame:
    """A row for each policy, without a month, and one for each of its months with facts."""
    policies = book.insured_policies().select("policy_id", *marts.SEGMENT)
    months = marts.policy_months(marts.activity(book), marts.TREND_MEASURES)
    facts = policies.join(months, "policy_id").filter(F.col("month_start").isNotNull())
    alone = policies.withColumn("month_start", F.lit(None).cast("date"))
    return facts.filter(marts.complete_segment()).unionByName(alone, allowMissingColumns=True)


def _cells(facts: DataFrame) -> DataFrame:
    return state_of(facts, CELL, {n: (F.col(n), kind) for n, kind in marts.TREND_MEASURES.items()})


def trend_state_of(book: Portfolio) -> DataFrame:
    """Segment and month cells of all facts, also of months outside the calendar, and a row
    without a month for each segment that has policies."""
    return _cells(_segment_facts(book))


def trend_change(before: Portfolio, after: Portfolio) -> DataFrame:
    """The change of the cells that the touched policies make."""
    return _cells(signed(_segment_facts(before), _segment_facts(after)))


def refresh_cells(state: DataFrame, change: DataFrame) -> DataFrame:
    return merge_state(state, change, CELL)


def refresh_trend(previous: DataFrame, state: DataFrame, change: DataFrame,
                  book: Portfolio) -> DataFrame:
    """The trend after a change of its cells.

    ``previous`` is the trend before, ``state`` holds the cells after. A segment is redone
    from its first changed month on, a new one from the start, and every one from the month
    after the last that ``previous`` has, if the calendar went on. Segments without policies
    leave the trend.
    """
    held = previous.groupBy(*marts.SEGMENT).agg(F.max("month_start").alias("_last"))
    renamed = {k: F.col(k).alias(f"_s{i}") for i, k in enumerate(marts.SEGMENT)}
    same = reduce(lambda a, b: a & b,
                  [F.col(k).eqNullSafe(F.col(f"_s{i}")) for i, k in enumerate(marts.SEGMENT)])
    touched = change.filter(F.col("month_start") >= book.start).groupBy(*marts.SEGMENT).agg(
        F.min("month_start").alias("_changed")).select(*renamed.values(), "_changed")
    known = held.select(*renamed.values(), "_last")
    segments = state.filter(F.col("month_start").isNull()).select(*marts.SEGMENT)
    begun = (segments.join(known, same, "left").select(*marts.SEGMENT, "_last")
             .join(touched, same, "left"))
    start = F.when(F.col("_last").isNull(), book.start).otherwise(
        F.least(F.add_months("_last", 1), F.coalesce("_changed", F.add_months("_last", 1))))
    present = begun.select(*marts.SEGMENT, start.alias("_first")).filter(
        F.col("_first") <= book.today)
    gone = held.join(segments.select(*renamed.values()), same, "left_anti").select(
        *marts.SEGMENT, F.lit("0001-01-01").cast("date").alias("_first"))
    starts = present.select(*renamed.values(), "_first")
    rows = settled(state.filter(F.col("month_start").isNull() | F.col("month_start").between(
        book.start, book.today)))
    facts = rows.join(starts, same).select(
        *marts.SEGMENT, "_first", *marts.TREND_MEASURES,
        F.when(F.col("month_start") >= F.col("_first"), F.col("month_start")).alias("month_start"))
    # The first month is one of the keys: it is the same for all rows of a segment.
    dense = densify(facts.withColumnRenamed("_first", "_from"), [*marts.SEGMENT, "_from"],
                    "month_start", list(marts.TREND_MEASURES),
                    calendar(F.col("_from"), book.today)).drop("_from")
    rolled = resume_totals(previous, dense, present.unionByName(gone), marts.SEGMENT,
                           "month_start", marts.TREND_TOTALS)
    return marts.finish_trend(rolled)


# -- tables dealt by the keys that refreshes look up ------------------------------

# Table and key of each: facts and policies by policy, and two narrow tables by which the
# policies of a claim key and of a customer are found.
_HELD = {"customers": "customer_id", "policies": "policy_id", "claims": "policy_id",
         "payments": "policy_id", "endorsements": "policy_id",
         "claim_keys": "claim_id", "owners": "customer_id"}


@dataclass
class HeldBook:
    """Raw tables from which the rows of a few policies are read without the others.

    Every table is a :class:`VersionedTable` in buckets of the key that refreshes look rows
    up by; only buckets that a touched key falls into are read or written.
    """

    tables: Mapping[str, VersionedTable]
    as_of: dt.date
    spine_start: dt.date

    @classmethod
    def create(cls, spark: SparkSession, path: str, book: Portfolio) -> HeldBook:
        """Write all rows of ``book``."""
        held = cls({name: VersionedTable(spark, f"{path.rstrip('/')}/{name}", key)
                    for name, key in _HELD.items()}, book.as_of, book.spine_start)
        for name in TABLES:
            held.tables[name].replace(book.table(name))
        held.tables["claim_keys"].replace(book.claims.select("claim_id", "policy_id"))
        held.tables["owners"].replace(book.policies.select("customer_id", "policy_id"))
        return held

    def _near(self, name: str, keys: DataFrame, column: str) -> DataFrame:
        """Rows of a table whose key is among ``keys``, from their buckets only."""
        table = self.tables[name]
        # At most as many rows as the table has buckets.
        buckets = keys.select(table.bucket_of(F.col(column)).alias("b")).distinct().collect()
        wanted = keys.select(F.col(column).alias(table.key)).distinct()
        return table.read([r.b for r in buckets]).join(wanted, table.key, "left_semi")

    def touched_by(self, arrivals: Mapping[str, DataFrame]) -> DataFrame:
        """Policies that arrivals (rows by table) can change, looked up before they are added."""
        parts = [rows.select("policy_id") for name, rows in arrivals.items()
                 if name != "customers"]
        if "claims" in arrivals:
            parts.append(self._near("claim_keys", arrivals["claims"], "claim_id")
                         .select("policy_id"))
        if "customers" in arrivals:
            parts.append(self._near("owners", arrivals["customers"], "customer_id")
                         .select("policy_id"))
        keys = reduce(DataFrame.unionByName, parts)
        return keys.filter(F.col("policy_id").isNotNull()).distinct()

    def part(self, touched: DataFrame) -> Portfolio:
        """The portfolio of the touched policies, as it is now.

        Claims of other policies that share a key with theirs come as bare keys: they only
        tell that the key is not unique.
        """
        policies = self._near("policies", touched, "policy_id")
        claims = self._near("claims", touched, "policy_id")
        twins = self._near("claim_keys", claims, "claim_id").join(
            touched, "policy_id", "left_anti")
        return Portfolio({
            "customers": self._near("customers", policies, "customer_id"),
            "policies": policies,
            "claims": claims.unionByName(twins, allowMissingColumns=True),
            "payments": self._near("payments", touched, "policy_id"),
            "endorsements": self._near("endorsements", touched, "policy_id"),
        }, self.as_of, self.spine_start)

    def add(self, arrivals: Mapping[str, DataFrame]) -> None:
        """Append rows to their tables; portfolios taken before still read the old versions."""
        more = dict(arrivals)
        if "claims" in more:
            more["claim_keys"] = more["claims"].select("claim_id", "policy_id")
        if "policies" in more:
            more["owners"] = more["policies"].select("customer_id", "policy_id")
        for name, rows in more.items():
            table = self.tables[name]
            buckets = rows.select(table.bucket_of(F.col(table.key)).alias("b")).distinct().collect()
            table.rewrite([r.b for r in buckets], lambda old, rows=rows: old.unionByName(rows))
