"""The five raw tables and the clean views derived from them."""

from __future__ import annotations

import datetime as dt
import math
import uuid
from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.functions import as_date, month_start
from riskloom.operators.keys import keep_unique
from riskloom.operators.sets import set_difference
from riskloom.operators.skew import key_counts, lookup_join

# Stored month of a staged fact, and the date it is the month of.
FACT_MONTH = "fact_month"
FACT_DATES = {"claims": "claim_date", "payments": "payment_date"}

# Rows of the largest table that a bucket of a staged book holds, about. Tasks that join and sum
# a bucket take some 500 bytes of memory a row.
BUCKET_ROWS = 2_000_000

# Fixed value: first month of the trend calendar.
SPINE_START = dt.date(2024, 5, 1)


class Portfolio:
    """Raw tables plus the parameters every plan shares.

    ``tables`` holds customers, policies, claims, payments and endorsements, each
    as a DataFrame or as a function giving one, called when first needed. The
    clean views are lazy plans over the raw tables until :meth:`staged` writes
    them; afterwards the same methods read what was written. ``hot_rows`` makes the
    lookups spread keys with more rows themselves; by default that is left to
    adaptive execution.
    """

    def __init__(self, tables: Mapping[str, DataFrame | Callable[[], DataFrame]],
                 as_of: dt.date | None = None, spine_start: dt.date = SPINE_START,
                 hot_rows: int | None = None, written: Mapping[str, DataFrame] | None = None,
                 buckets: int | None = None):
        self._tables = dict(tables)
        self.as_of = as_of
        self.spine_start = spine_start
        self.hot_rows = hot_rows
        self.written = dict(written or {})
        #: Buckets per written table where these lie in buckets of the policy key.
        self.buckets = buckets if self.written else None

    def table(self, name: str) -> DataFrame:
        table = self._tables[name]
        if not isinstance(table, DataFrame):
            table = self._tables[name] = table()
        return table

    @property
    def customers(self) -> DataFrame:
        return self.table("customers")

    @property
    def policies(self) -> DataFrame:
        return self.table("policies")

    @property
    def claims(self) -> DataFrame:
        return self.table("claims")

    @property
    def payments(self) -> DataFrame:
        return self.table("payments")

    @property
    def endorsements(self) -> DataFrame:
        return self.table("endorsements")

    @property
    def today(self) -> Column:
        return as_date(self.as_of)

    @property
    def start(self) -> Column:
        """First day of the month in which the calendar starts."""
        return month_start(as_date(self.spine_start))

    # -- clean views ---------------------------------------------------------

    def clean_customers(self) -> DataFrame:
        return self.customers

    def clean_endorsements(self) -> DataFrame:
        return self.written.get("endorsements", self.endorsements)

    def insured_policies(self) -> DataFrame:
        """Clean policies with their customer's name, state and industry.

        A policy is clean when its premium is positive, its dates are in order,
        its customer exists and its key is unique among the rows that pass.
        Repeated customers are counted, not multiplied out, and a policy row
        weighs as many copies as its customer has. The result is partitioned by
        ``policy_id``, which is how every mart goes on to join it.
        """
        if "policies" in self.written:
            return self.written["policies"]
        eligible = self.policies.filter(
            (F.col("premium") > 0) & (F.col("effective_date") < F.col("expiration_date"))
        )
        profile = ["customer_name", "state", "industry"]
        customers = self.customers.filter(F.col("customer_id").isNotNull()).groupBy(
            "customer_id"
        ).agg(F.count(F.lit(1)).alias("_customers"), *[F.max(c).alias(c) for c in profile])
        insured = lookup_join(eligible, customers, "customer_id", "inner", self.hot_rows)
        unique = keep_unique(insured, "policy_id", weight=F.col("_customers"))
        return unique.select(*self.policies.columns, *profile)

    def clean_policies(self) -> DataFrame:
        return self.insured_policies().select(*self.policies.columns)

    def sound_claims(self, *columns: Column | str) -> DataFrame:
        """Claims whose key is unique among all raw claims, parent not looked at.

        Enough for a plan that joins the clean policies anyway; elsewhere use
        :meth:`clean_claims`. ``columns`` are computed before duplicates are
        removed: with fixed-width results that step is a hash aggregation, where
        carrying the status text along would make it sort.
        """
        picked = ["claim_id", *(columns or [c for c in self.claims.columns if c != "claim_id"])]
        if "claims" in self.written:
            return self.written["claims"].select(*picked)
        return keep_unique(self.claims.select(*picked), "claim_id", drop_null_keys=True)

    def sound_payments(self) -> DataFrame:
        """Payments before the parent check; negative ones stay, as credits."""
        return self.written.get("payments", self.payments)

    def month_of(self, name: str) -> Column:
        """Month of a fact: the stored one if the staged table is laid out by it."""
        if name in self.written and FACT_MONTH in self.written[name].columns:
            return F.col(FACT_MONTH)
        return month_start(F.col(FACT_DATES[name]))

    def clean_claims(self) -> DataFrame:
        """Claims with a unique key and a clean policy."""
        return self._with_clean_policy("claims", self.sound_claims()).select(*self.claims.columns)

    def clean_payments(self) -> DataFrame:
        """Payments with a clean policy."""
        return self._with_clean_policy("payments", self.sound_payments()).select(
            *self.payments.columns)

    def _with_clean_policy(self, name: str, facts: DataFrame) -> DataFrame:
        if name in self.written:
            return facts
        parents = self.insured_policies().select("policy_id")
        counts = key_counts(self.table(name), ["policy_id"]) if self.hot_rows else None
        return lookup_join(facts, parents, "policy_id", "left_semi", self.hot_rows, counts)

    # -- reject audits -------------------------------------------------------

    def rejected_claims(self) -> DataFrame:
        return set_difference(self.claims, self.clean_claims())

    def rejected_payments(self) -> DataFrame:
        return set_difference(self.payments, self.clean_payments())

    # -- materialisation -----------------------------------------------------

    def staged(self, spark: SparkSession, path: str, buckets: int | None = None,
               by_month: bool = False,
               watch: Callable[[str, DataFrame], DataFrame] | None = None) -> Portfolio:
        """Write the clean views under ``path`` and return a portfolio reading them.

        Worth it when several marts are built from one load: cleaning then runs
        once, and a lost executor costs a re-read instead of a recomputation.

        ``buckets`` lays the tables out by policy, in that many buckets each and sorted, as
        tables of the session's catalog: marts then join and sum them without a shuffle.
        Give as many as the cluster has cores, or more. Larger books get a multiple, so that
        a bucket has no more than ``BUCKET_ROWS`` rows of a table on average: it is read by
        one task. A policy with a large share of the facts is better left unbucketed, where
        adaptive execution may split it. ``by_month`` keeps the facts in a folder for each month, of
        which a mart with a calendar reads those it needs. ``watch`` may observe the rows of
        a table as they are written.
        """
        book = self.with_written({})
        views = {"policies": Portfolio.insured_policies, "claims": Portfolio.clean_claims,
                 "payments": Portfolio.clean_payments}
        if buckets or watch:
            views["endorsements"] = Portfolio.clean_endorsements
        if buckets:
            largest = _most_rows([self.table(name) for name in views])
            buckets *= max(1, math.ceil(largest / (BUCKET_ROWS * buckets)))
        for name, view in views.items():
            target = f"{path.rstrip('/')}/{name}"
            rows = view(book)
            if watch:
                rows = watch(name, rows)
            # The claims and payments are checked against the written policies.
            table = _write_staged(spark, rows, name, target, buckets, by_month)
            book = book.with_written({**book.written, name: table}, buckets)
        return book

    def with_written(self, written: Mapping[str, DataFrame],
                     buckets: int | None = None) -> Portfolio:
        return Portfolio(self._tables, self.as_of, self.spine_start, self.hot_rows, written,
                         buckets or self.buckets)

    def with_tables(self, **tables: DataFrame) -> Portfolio:
        """The same portfolio over other raw tables."""
        return Portfolio({**self._tables, **tables}, self.as_of, self.spine_start, self.hot_rows)


def _most_rows(tables: Sequence[DataFrame]) -> int:
    """Rows of the largest table; a count reads next to no columns."""
    counts = reduce(DataFrame.unionByName, [t.agg(F.count(F.lit(1)).alias("n")) for t in tables])
    return counts.agg(F.max("n")).first()[0]


def _write_staged(spark: SparkSession, rows: DataFrame, name: str, target: str,
                  buckets: int | None, by_month: bool) -> DataFrame:
    monthly = by_month and name in FACT_DATES
    if monthly:
        rows = rows.withColumn(FACT_MONTH, month_start(F.col(FACT_DATES[name])))
    if buckets:
        rows = rows.repartition(buckets, "policy_id")
    elif monthly:
        rows = rows.repartition(FACT_MONTH, F.pmod(F.xxhash64("policy_id"), F.lit(8)))
    writer = rows.write.mode("overwrite")
    if monthly:
        writer = writer.partitionBy(FACT_MONTH)
    if not buckets:
        writer.parquet(target)
        return spark.read.schema(rows.schema).parquet(target)
    table = f"riskloom_{name}_{uuid.uuid4().hex}"
    writer.format("parquet").bucketBy(buckets, "policy_id").sortBy("policy_id").option(
        "path", target).saveAsTable(table)
    return spark.table(table)
