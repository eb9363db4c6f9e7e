"""Data-quality findings: tagged tables and reports of suspicious rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.operators.keys import duplicate_keys, with_key_count
from riskloom.operators.quality import Rule, missing_values, tag
from riskloom.operators.skew import key_counts, lookup_join
from riskloom.plans.portfolio import Portfolio

# Reasons attached to invalid rows.
INVALID_AMOUNT = "INVALID_AMOUNT"
INVALID_DATES = "INVALID_DATES"
ORPHAN_FK = "ORPHAN_FK"
DUPLICATE_PK = "DUPLICATE_PK"
NULL_PK = "NULL_PK"

# Endorsement types.
INCREASE = "Coverage Increase"
REDUCTION = "Coverage Reduction"
CANCELLATION = "Cancellation"


def _with_parent(book: Portfolio, df: DataFrame, parents: DataFrame, key: str) -> DataFrame:
    """Add ``_parent``: true where ``key`` has a row in ``parents`` (unique keys)."""
    return lookup_join(df, parents.select(key, F.lit(True).alias("_parent")), key, "left",
                       book.hot_rows)


def _customer_keys(book: Portfolio) -> DataFrame:
    return book.customers.select("customer_id").filter(F.col("customer_id").isNotNull()).distinct()


def _clean_policy_keys(book: Portfolio) -> DataFrame:
    return book.insured_policies().select("policy_id").filter(F.col("policy_id").isNotNull())


def tagged_policies(book: Portfolio) -> DataFrame:
    """Raw policies with the first reason that makes them invalid.

    Looser than the clean view: a zero premium, a missing date or a missing
    customer key carries no tag, and duplicates are counted among all raw rows.
    """
    columns = book.policies.columns
    counted = with_key_count(book.policies, "policy_id", "_copies", book.hot_rows)
    marked = lookup_join(
        counted, _customer_keys(book).withColumn("_parent", F.lit(True)), "customer_id", "left",
        book.hot_rows, key_counts(book.policies, ["customer_id"]) if book.hot_rows else None)
    rules = [
        Rule(INVALID_AMOUNT, F.col("premium").isNull() | (F.col("premium") < 0)),
        Rule(INVALID_DATES, F.col("effective_date") >= F.col("expiration_date")),
        Rule(ORPHAN_FK, F.col("customer_id").isNotNull() & F.col("_parent").isNull()),
        Rule(DUPLICATE_PK, F.col("_copies") > 1),
    ]
    return tag(marked, rules).select(*columns, "dq_reason")


def tagged_claims(book: Portfolio) -> DataFrame:
    """Raw claims with a reason; the rows without one are exactly the clean claims."""
    columns = book.claims.columns
    counted = with_key_count(book.claims, "claim_id", "_copies", book.hot_rows)
    marked = lookup_join(
        counted, _clean_policy_keys(book).withColumn("_parent", F.lit(True)), "policy_id", "left",
        book.hot_rows, key_counts(book.claims, ["policy_id"]) if book.hot_rows else None)
    rules = [
        Rule(NULL_PK, F.col("claim_id").isNull()),
        Rule(ORPHAN_FK, F.col("_parent").isNull()),
        Rule(DUPLICATE_PK, F.col("_copies") > 1),
    ]
    return tag(marked, rules).select(*columns, "dq_reason")


def tagged_payments(book: Portfolio) -> DataFrame:
    """Raw payments with a reason; the rows without one are exactly the clean payments."""
    marked = _with_parent(book, book.payments, _clean_policy_keys(book), "policy_id")
    return tag(marked, [Rule(ORPHAN_FK, F.col("_parent").isNull())]).select(
        *book.payments.columns, "dq_reason")


def tagged_customers(book: Portfolio) -> DataFrame:
    """Raw customers with a reason to look at them; the clean view keeps all."""
    counted = with_key_count(book.customers, "customer_id", "_copies", book.hot_rows)
    rules = [
        Rule(NULL_PK, F.col("customer_id").isNull()),
        Rule(DUPLICATE_PK, F.col("_copies") > 1),
    ]
    return tag(counted, rules).select(*book.customers.columns, "dq_reason")


def tagged_endorsements(book: Portfolio) -> DataFrame:
    """Raw endorsements with a reason to look at them; the clean view keeps all.

    Contradictory signs are reported on their own.
    """
    counted = with_key_count(book.endorsements, "endorsement_id", "_copies", book.hot_rows)
    marked = _with_parent(book, counted, _clean_policy_keys(book), "policy_id")
    rules = [
        Rule(NULL_PK, F.col("endorsement_id").isNull()),
        Rule(ORPHAN_FK, F.col("_parent").isNull()),
        Rule(DUPLICATE_PK, F.col("_copies") > 1),
    ]
    return tag(marked, rules).select(*book.endorsements.columns, "dq_reason")


def policy_key_counts(book: Portfolio) -> DataFrame:
    """Raw policies with the number of rows sharing their key."""
    return with_key_count(book.policies, "policy_id", "pk_count", book.hot_rows)


def repeated_claim_keys(book: Portfolio) -> DataFrame:
    """Claim keys that occur more than once among the raw claims."""
    return duplicate_keys(book.claims, "claim_id")


def orphans(book: Portfolio) -> DataFrame:
    """Rows whose parent is missing, or was itself excluded from the clean view."""
    no_customer = lookup_join(
        book.policies.select("policy_id", "customer_id").filter(F.col("customer_id").isNotNull()),
        _customer_keys(book), "customer_id", "left_anti", book.hot_rows)
    parents = _clean_policy_keys(book)

    def without_policy(df: DataFrame, key: str, table: str) -> DataFrame:
        rows = lookup_join(df.select(key, "policy_id"), parents, "policy_id", "left_anti",
                           book.hot_rows)
        return rows.select(F.lit(table).alias("table_name"), F.col(key).alias("row_key"),
                           F.col("policy_id").alias("parent_key"))

    return reduce(DataFrame.unionByName, [
        no_customer.select(F.lit("policies").alias("table_name"),
                           F.col("policy_id").alias("row_key"),
                           F.col("customer_id").alias("parent_key")),
        without_policy(book.claims, "claim_id", "claims"),
        without_policy(book.payments, "payment_id", "payments"),
    ])


def missing(book: Portfolio) -> DataFrame:
    """NULLs per column of every raw table."""
    tables = {
        "customers": book.customers,
        "policies": book.policies,
        "claims": book.claims,
        "payments": book.payments,
        "endorsements": book.endorsements,
    }
    return reduce(DataFrame.unionByName, [missing_values(df, t) for t, df in tables.items()])


def negative_amounts(book: Portfolio) -> DataFrame:
    """Rows of policies, claims and payments with an amount below zero."""
    amounts = [
        ("policies", book.policies, "policy_id", "premium"),
        ("claims", book.claims, "claim_id", "claim_amount"),
        ("payments", book.payments, "payment_id", "payment_amount"),
    ]
    return reduce(DataFrame.unionByName, [
        df.filter(F.col(amount) < 0).select(
            F.lit(table).alias("table_name"), F.col(key).alias("row_key"),
            F.col(amount).alias("amount"))
        for table, df, key, amount in amounts
    ])


def contradictory_endorsements(book: Portfolio) -> DataFrame:
    """Endorsements whose sign contradicts their type."""
    kind, amount = F.col("endorsement_type"), F.col("endorsement_amount")
    contradiction = (
        F.when((kind == INCREASE) & (amount < 0), "NEGATIVE_INCREASE")
        .when((kind == REDUCTION) & (amount > 0), "POSITIVE_REDUCTION")
    )
    return (
        book.endorsements.withColumn("issue", contradiction)
        .filter(F.col("issue").isNotNull())
        .select("endorsement_id", "policy_id", "endorsement_type", "endorsement_amount", "issue")
    )


def payments_after_expiration(book: Portfolio) -> DataFrame:
    """Payments on clean policies dated after the policy's expiration."""
    terms = book.insured_policies().select("policy_id", "expiration_date")
    paid = lookup_join(book.sound_payments(), terms, "policy_id", "inner", book.hot_rows)
    return paid.filter(F.col("payment_date") > F.col("expiration_date")).select(
        "payment_id", "policy_id", "payment_date", "payment_amount", "expiration_date")


def payments_after_cancellation(book: Portfolio) -> DataFrame:
    """Payments on clean policies dated after the policy's first cancellation."""
    cancelled = (
        book.clean_endorsements()
        .filter((F.col("endorsement_type") == CANCELLATION) & F.col("policy_id").isNotNull())
        .groupBy("policy_id").agg(F.min("endorsement_date").alias("cancelled_on"))
    )
    on_clean = cancelled.join(_clean_policy_keys(book), "policy_id", "left_semi")
    paid = lookup_join(book.sound_payments(), on_clean, "policy_id", "inner", book.hot_rows)
    return paid.filter(F.col("payment_date") > F.col("cancelled_on")).select(
        "payment_id", "policy_id", "payment_date", "payment_amount", "cancelled_on")
