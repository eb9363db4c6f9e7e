from collections import Counter

from tests import sample
from riskloom.plans import findings


def keys(df, column):
    return Counter(r[0] for r in df.select(column).collect())


def reasons(df, key):
    return Counter((r[0], r[1]) for r in df.select(key, "dq_reason").collect())


def test_clean_policies(spark):
    book = sample.portfolio(spark)
    assert keys(book.clean_policies(), "policy_id") == Counter(sample.CLEAN_POLICIES)
    assert book.clean_policies().columns == book.policies.columns


def test_clean_claims_drop_every_copy_of_a_repeated_key(spark):
    book = sample.portfolio(spark)
    assert keys(book.clean_claims(), "claim_id") == Counter(sample.CLEAN_CLAIMS)
    assert book.clean_claims().columns == book.claims.columns


def test_clean_payments_keep_credits_and_repeats(spark):
    book = sample.portfolio(spark)
    assert keys(book.clean_payments(), "payment_id") == Counter([1, 2, 3, 5, 6, 7, 7])


def test_customers_and_endorsements_pass_through(spark):
    book = sample.portfolio(spark)
    assert book.clean_customers().count() == len(sample.CUSTOMERS)
    assert book.clean_endorsements().count() == len(sample.ENDORSEMENTS)


def test_rejects_are_distinct_rows(spark):
    book = sample.portfolio(spark)
    assert keys(book.rejected_claims(), "claim_id") == Counter(
        {5: 2, 6: 1, None: 2, 10: 1, 11: 1})
    assert keys(book.rejected_payments(), "payment_id") == Counter([4, 8])


def test_policy_tags(spark):
    got = reasons(findings.tagged_policies(sample.portfolio(spark)), "policy_id")
    expected = Counter({(i, None): 1 for i in (1, 2, 3, 7, 9, 12, 13, 14, 15, 16)})
    expected.update({
        (4, "INVALID_AMOUNT"): 1, (5, "INVALID_AMOUNT"): 1, (6, "INVALID_DATES"): 1,
        (8, "ORPHAN_FK"): 1, (10, "DUPLICATE_PK"): 1, (10, "INVALID_AMOUNT"): 1,
        (11, "DUPLICATE_PK"): 2,
    })
    assert got == expected


def test_untagged_claims_and_payments_are_the_clean_ones(spark):
    book = sample.portfolio(spark)
    claims = reasons(findings.tagged_claims(book), "claim_id")
    assert {k for k, reason in claims if reason is None} == sample.CLEAN_CLAIMS
    assert claims[(None, "NULL_PK")] == 2
    assert claims[(5, "DUPLICATE_PK")] == 1 and claims[(5, "ORPHAN_FK")] == 1
    assert claims[(11, "ORPHAN_FK")] == 2 and claims[(10, "ORPHAN_FK")] == 1
    payments = reasons(findings.tagged_payments(book), "payment_id")
    assert payments == Counter({
        (1, None): 1, (2, None): 1, (3, None): 1, (5, None): 1, (6, None): 1, (7, None): 2,
        (4, "ORPHAN_FK"): 1, (8, "ORPHAN_FK"): 1})


def test_a_low_hot_row_limit_changes_nothing(spark):
    plain, salted = sample.portfolio(spark), sample.portfolio(spark, hot_rows=1)
    for plan in (findings.tagged_policies, findings.tagged_claims, findings.tagged_payments,
                 findings.orphans, findings.payments_after_expiration,
                 findings.payments_after_cancellation, type(plain).clean_policies,
                 type(plain).clean_claims, type(plain).clean_payments):
        assert Counter(plan(plain).collect()) == Counter(plan(salted).collect())


def test_written_views_equal_the_lazy_ones(spark, tmp_path):
    book = sample.portfolio(spark)
    staged = book.staged(spark, str(tmp_path))
    for view in ("clean_policies", "clean_claims", "clean_payments", "rejected_claims"):
        lazy, read = getattr(book, view)(), getattr(staged, view)()
        assert lazy.columns == read.columns
        assert Counter(lazy.collect()) == Counter(read.collect())


# -- findings ------------------------------------------------------------------------

def test_duplicates(spark):
    book = sample.portfolio(spark)
    assert {tuple(r) for r in findings.repeated_claim_keys(book).collect()} == {
        (5, 2), (11, 2), (None, 2)}
    counts = {(r.policy_id, r.pk_count) for r in findings.policy_key_counts(book).collect()}
    assert {(10, 2), (11, 2), (1, 1)} <= counts


def test_orphans_are_transitive(spark):
    got = Counter(tuple(r) for r in findings.orphans(sample.portfolio(spark)).collect())
    assert got == Counter({
        ("policies", 8, 99): 1, ("claims", 5, 777): 1, ("claims", 6, 4): 1,
        ("claims", 10, None): 1, ("claims", 11, 8): 2,
        ("payments", 4, 4): 1, ("payments", 8, None): 1})


def test_missing_values(spark):
    got = {(r.table_name, r.column_name): r.missing_count
           for r in findings.missing(sample.portfolio(spark)).collect()}
    assert got[("policies", "premium")] == 1 and got[("policies", "effective_date")] == 1
    assert got[("claims", "claim_id")] == 2 and got[("customers", "industry")] == 1
    assert got[("endorsements", "policy_id")] == 0 and len(got) == 29


def test_negative_amounts(spark):
    got = {tuple(r)[:2] for r in findings.negative_amounts(sample.portfolio(spark)).collect()}
    assert got == {("policies", 5), ("policies", 10), ("payments", 3)}


def test_contradictory_endorsements(spark):
    got = {(r.endorsement_id, r.issue)
           for r in findings.contradictory_endorsements(sample.portfolio(spark)).collect()}
    assert got == {(1, "NEGATIVE_INCREASE"), (2, "POSITIVE_REDUCTION"), (7, "POSITIVE_REDUCTION")}


def test_late_payments(spark):
    book = sample.portfolio(spark)
    assert keys(findings.payments_after_expiration(book), "payment_id") == Counter([2])
    assert keys(findings.payments_after_cancellation(book), "payment_id") == Counter([7, 7])
