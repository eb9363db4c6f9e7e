"""Staged layouts, observed loads, fingerprints and mergeable states."""

import datetime as dt
import math
import re
from collections import Counter, defaultdict
from decimal import Decimal as D

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from riskloom.operators import bitmaps, changes, fingerprints, quantiles
from riskloom.operators.observe import LoadMetrics
from riskloom.plans import checks, marts, portfolio
from riskloom.plans.pipeline import observed_build
from riskloom.streaming.loads import append_dedup, landing_stream
from tests import sample

few = settings(max_examples=6, deadline=None,
               suppress_health_check=[HealthCheck.function_scoped_fixture])


def bag(df):
    return Counter(tuple(r) for r in df.collect())


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def book(spark):
    return sample.portfolio(spark)


# -- staged layouts ------------------------------------------------------------

@pytest.fixture(scope="module")
def bucketed(spark, book, tmp_path_factory):
    return book.staged(spark, str(tmp_path_factory.mktemp("bucketed")), buckets=4, by_month=True)


MARTS = {"policy_totals": marts.policy_totals, "monthly_claims": marts.monthly_claims,
         "payment_claims_trend": marts.payment_claims_trend}


@pytest.mark.parametrize("name", MARTS)
def test_bucketed_tables_are_not_shuffled_by_policy(spark, book, bucketed, name):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = MARTS[name](bucketed)
        exchanges = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan_of(df))
        assert not [e for e in exchanges if "policy_id" in e]
        assert "Bucketed: true" in plan_of(df)
        plain = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan_of(MARTS[name](book)))
        assert [e for e in plain if "policy_id" in e]
        assert bag(df) == bag(MARTS[name](book))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_larger_book_gets_a_multiple_of_its_buckets(spark, book, tmp_path, monkeypatch):
    """A task reads a bucket, so rows of a bucket must not grow with the book."""
    monkeypatch.setattr(portfolio, "BUCKET_ROWS", 2)
    rows = max(df.count() for df in (book.policies, book.claims, book.payments, book.endorsements))
    assert rows > 6
    staged = book.staged(spark, str(tmp_path / "many"), buckets=3)
    assert staged.buckets == 3 * math.ceil(rows / 6)
    for name, df in staged.written.items():
        # An empty bucket has no file.
        files = {re.search(r"_(\d{5})\.", f)[1] for f in df.inputFiles()}
        assert len(files) <= staged.buckets and (name != "policies" or max(map(int, files)) >= 3)
    for name, mart in MARTS.items():
        assert bag(mart(staged)) == bag(mart(book)), name
    monkeypatch.undo()
    assert book.staged(spark, str(tmp_path / "few"), buckets=3).buckets == 3


def test_the_calendar_prunes_months_of_facts(spark, book, tmp_path):
    staged = book.staged(spark, str(tmp_path), by_month=True)
    assert {c for c in staged.written["claims"].columns} > {"fact_month"}
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        plan = plan_of(marts.payment_claims_trend(staged))
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    filters = re.findall(r"PartitionFilters: \[([^\]]*)\]", plan)
    assert sum("fact_month" in f and ">=" in f for f in filters) == 2
    assert bag(marts.payment_claims_trend(staged)) == bag(marts.payment_claims_trend(book))
    assert staged.clean_claims().columns == book.claims.columns
    assert staged.clean_payments().columns == book.payments.columns
    assert bag(staged.clean_payments()) == bag(book.clean_payments())


def test_payments_outside_the_calendar_are_left_to_the_scan(spark, book, tmp_path):
    book.payments.write.parquet(str(tmp_path / "payments"))
    held = book.with_tables(payments=spark.read.parquet(str(tmp_path / "payments")))
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        plan = plan_of(marts.payment_claims_trend(held))
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(payment_date,", plan)
    assert re.search(r"PushedFilters: \[[^\]]*LessThan\(payment_date,2025-02-01\)", plan)


# -- observed loads ----------------------------------------------------------------

def test_observed_figures_need_no_scan(spark, book, tmp_path):
    staged, metrics = observed_build(spark, book, str(tmp_path))
    observed = checks.reconcile_observed(spark, metrics)
    assert "FileScan" not in plan_of(observed) and "Scan parquet" not in plan_of(observed)
    want = {r.check_name: (r.left_value, r.right_value, r.passed)
            for r in checks.reconcile_totals(book).collect()}
    assert {r.check_name: (r.left_value, r.right_value, r.passed)
            for r in observed.collect()} == want
    assert metrics.value("claims") == len(sample.CLEAN_CLAIMS)
    kept = LoadMetrics.kept(spark, str(tmp_path))
    assert bag(kept.table(spark)) == bag(metrics.table(spark))
    assert bag(checks.reconcile_observed(spark, kept)) == bag(observed)
    assert bag(staged.written["customer_rollup"]) == bag(marts.customer_rollup(book))


def test_an_observed_write_reads_its_source_once(spark, tmp_path):
    spark.range(100).write.parquet(str(tmp_path / "in"))
    metrics = LoadMetrics({"t": {"sum": F.sum("id"), "none": F.sum(F.lit(None).cast("int"))}})
    rows = metrics.watch("t", spark.read.parquet(str(tmp_path / "in")))
    assert plan_of(rows).count("FileScan") == 1
    rows.write.parquet(str(tmp_path / "out"))
    assert (metrics.value("t"), metrics.value("t", "sum"), metrics.value("t", "none")) == (100, 4950, 0)


# -- fingerprints --------------------------------------------------------------------

ROWS = st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 3)),
                          st.one_of(st.none(), st.integers(0, 2)),
                          st.one_of(st.none(), st.integers(0, 2))), max_size=10)


@few
@given(left=ROWS, right=ROWS, same=st.booleans())
def test_fingerprints_tell_multisets_apart(spark, left, right, same):
    right = list(reversed(left)) if same else right

    def frame(rows):
        return spark.createDataFrame(rows, "k int, v int, w int").repartition(3)

    parts = fingerprints.compare_parts(frame(left), frame(right), "k", ["v", "w"], 4).collect()
    assert all(p.passed for p in parts) == (Counter(left) == Counter(right))
    assert sum(p.left_rows for p in parts) == len(left)
    one, two = defaultdict(Counter), defaultdict(Counter)
    for rows, sides in ((left, one), (right, two)):
        for r in rows:
            sides[r[0]][r] += 1
    wrong = [p.part for p in parts if not p.passed]
    keys = fingerprints.differing_keys(frame(left), frame(right), "k", ["v", "w"], wrong, 4)
    assert {r.k for r in keys.collect()} == {k for k in {*one, *two} if one[k] != two[k]}


def test_errors_that_cancel_are_found(spark, book):
    totals = marts.policy_totals(book)
    off = F.when(F.col("policy_id") == 1, 5).when(F.col("policy_id") == 2, -5).otherwise(0)
    doctored = totals.withColumn("op_claim_total", (F.col("op_claim_total") + off).cast("decimal(26,2)"))
    assert totals.agg(F.sum("op_claim_total")).first() == doctored.agg(F.sum("op_claim_total")).first()
    found = {r.check_name: r for r in checks.reconcile_fingerprints(spark, book, doctored).collect()}
    assert found["policy_totals.claims"].differing_keys == 2
    assert not found["policy_totals.claims"].passed
    assert found["policy_totals.payments"].passed and found["customer_risk.claims"].passed
    assert all(r.passed for r in checks.reconcile_fingerprints(spark, book).collect())


def test_parts_send_few_rows(spark):
    """Tasks aggregate before they send anything."""
    rows = spark.range(10000).selectExpr("id AS k", "id AS v")
    plan = plan_of(fingerprints.compare_parts(rows, rows, "k", ["v"]))
    assert plan.count("Exchange") == 1 and "partial_sum" in plan


# -- snapshots -----------------------------------------------------------------------

def test_unchanged_rows_travel_as_key_and_hash(spark, tmp_path):
    """At most 40 bytes of an unchanged row are shuffled, however wide it is."""
    wide = spark.range(20000).selectExpr("id AS k", "repeat(md5(string(id)), 20) AS text",
                                         "id * 2 AS v")
    wide.write.parquet(str(tmp_path / "old"))
    old = spark.read.parquet(str(tmp_path / "old"))
    new = old.withColumn("v", F.when(F.col("k") == 7, -1).otherwise(F.col("v")))
    got = changes.snapshot_diff(old, new, "k")
    assert sorted((r._action, r._is_update, r.k, r.v) for r in got.collect()) == [
        ("DELETE", True, 7, 14), ("INSERT", True, 7, -1)]
    keys = changes.changed_keys(old, new, "k", ["text", "v"])
    keys.collect()
    plan = keys._jdf.queryExecution().executedPlan().toString()
    # What crosses the exchange: key, two hashes and one counter of eight bytes each.
    crossing = re.search(r"Exchange hashpartitioning.*\n.*?HashAggregate\(keys=\[k[^\]]*\], "
                         r"functions=\[([^\]]*)\]", plan)[1]
    assert crossing.count("partial_") == 3 and "text" not in crossing.replace("xxhash64", "")


# -- bitmaps and quantiles -----------------------------------------------------------

@few
@given(rows=st.lists(st.tuples(st.sampled_from([None, "a", "b"]), st.integers(0, 2), st.one_of(
    st.none(), st.sampled_from([1, 2, 32768, 32769, 70000, -5]))), max_size=20))
def test_distinct_counts_merge_exactly(spark, rows):
    df = spark.createDataFrame(rows, "g string, h int, i long")
    state = bitmaps.distinct_state(df, ["g", "h"], "i", {"every": F.lit(True), "some": F.col("h") > 0})
    for keys in (["g", "h"], ["g"], []):
        got = bitmaps.distinct_counts(bitmaps.merge_distinct(state, keys, ["every", "some"]),
                                      keys, ["every", "some"])
        want = defaultdict(lambda: (set(), set()))
        for g, h, i in rows:
            if i is not None:
                key = tuple({"g": g, "h": h}[k] for k in keys)
                want[key][0].add(i)
                if h > 0:
                    want[key][1].add(i)
        if not keys and not want:
            want[()]
        assert bag(got) == Counter((*k, len(a), len(b)) for k, (a, b) in want.items())


def test_a_state_is_no_larger_than_its_ids(spark, tmp_path):
    """Ids spread thinly over groups take a few words, and merging shuffles no state."""
    rows = spark.range(20000).selectExpr("id % 50 AS g", "id * 7 AS i")
    state = bitmaps.distinct_state(rows, ["g"], "i", {"every": F.lit(True)})
    state.write.parquet(str(tmp_path / "state"))
    held = spark.read.parquet(str(tmp_path / "state"))
    assert held.count() <= 20000 and dict(held.dtypes)["every"] == "bigint"
    merged = bitmaps.merge_distinct(state, [], ["every"])
    assert plan_of(merged).count("Exchange") == 1
    assert merged.count() == 20000 * 7 // 64 + 1
    assert [tuple(r) for r in bitmaps.distinct_counts(merged, [], ["every"]).collect()] == [(20000,)]


def test_quantiles_stay_within_the_stated_rank_error(spark):
    rows = spark.range(200000).selectExpr("id % 16 AS g", "id * 48271 % 200003 AS x")
    state = quantiles.quantile_state(rows, ["g"], F.col("x"))
    points = [0.01, 0.25, 0.5, 0.9, 0.99]
    found = quantiles.quantiles(quantiles.merge_quantiles(state, []), [], points).collect()
    ordered = sorted(i * 48271 % 200003 for i in range(200000))
    for r in found:
        rank = sum(x <= r.value for x in ordered) / len(ordered)
        assert r.value_count == 200000 and abs(rank - r.probability) <= quantiles.RANK_ERROR
    none = spark.createDataFrame([(1, None)], "g int, x double")
    assert not quantiles.quantiles(quantiles.quantile_state(none, ["g"], F.col("x")), ["g"], [.5]).collect()


# -- appends without repeats -----------------------------------------------------------

def test_a_key_is_appended_once_across_deliveries_and_restarts(spark, tmp_path):
    rows = [(1, 1, dt.date(2024, 1, 1), D("5")), (2, 1, dt.date(2024, 1, 2), D("6"))]
    columns = "payment_id long, policy_id long, payment_date date, payment_amount decimal(18,2)"
    landing, target, checkpoint = (str(tmp_path / n) for n in ("landing", "target", "checkpoint"))

    def deliver(some):
        spark.createDataFrame(some, columns).coalesce(1).write.mode("append").parquet(landing)
        stream = landing_stream(spark, landing, "payments")
        append_dedup(stream, target, checkpoint, "payment_id").awaitTermination()
        return sorted((r.payment_id is not None, r.payment_id or 0)
                      for r in spark.read.parquet(target).collect())

    assert deliver([rows[0], rows[0], rows[1]]) == [(True, 1), (True, 2)]
    # A repeated row, a row much older than the others, and rows without a key.
    late = (3, 1, dt.date(1999, 1, 1), D("1"))
    keyless = (None, 1, dt.date(2024, 1, 1), D("1"))
    want = [(False, 0), (False, 0), (True, 1), (True, 2), (True, 3)]
    assert deliver([rows[1], late, keyless, keyless]) == want
    assert deliver([late, rows[0]]) == want


def test_keys_are_remembered_for_the_stated_time_only(spark, tmp_path):
    """State is bounded by the watermark: a key far beyond it is appended again."""
    columns = "payment_id long, policy_id long, payment_date date, payment_amount decimal(18,2)"
    landing, target, checkpoint = (str(tmp_path / n) for n in ("landing", "target", "checkpoint"))
    for key, day in ((1, "2024-01-01"), (1, "2024-01-05"), (2, "2024-03-01"), (3, "2024-03-02"),
                     (1, "2024-03-03")):
        spark.createDataFrame([(key, 1, dt.date.fromisoformat(day), D("1"))], columns).write.mode(
            "append").parquet(landing)
        append_dedup(landing_stream(spark, landing, "payments"), target, checkpoint, "payment_id",
                     "10 days", F.col("payment_date").cast("timestamp")).awaitTermination()
    kept = sorted((r.payment_id, r.payment_date.isoformat()) for r in spark.read.parquet(target).collect())
    assert kept == [(1, "2024-01-01"), (1, "2024-03-03"), (2, "2024-03-01"), (3, "2024-03-02")]
