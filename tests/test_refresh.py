"""Refreshed marts against a full rebuild, for every kind of arrival."""

import datetime as dt
import re
from collections import Counter
from decimal import Decimal as D

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import __spark_entry__ as registry
from riskloom.operators import deltas
from riskloom.plans import marts, refresh
from tests import sample

few = settings(max_examples=6, deadline=None,
               suppress_health_check=[HealthCheck.function_scoped_fixture])


def bag(df):
    return Counter(tuple(r) for r in df.collect())


# Arrivals by table: which rows of the sample were not there before.
ARRIVALS = {
    "facts, one of them a twin that takes a claim out": {
        "claims": "claim_id IN (3, 9) OR claim_id = 5 AND policy_id = 777",
        "payments": "payment_id IN (3, 7)", "endorsements": "endorsement_id IN (3, 4)"},
    "a duplicate takes a policy out, a segment comes up": {
        "policies": "policy_id IN (2, 14, 15) OR policy_id = 11 AND customer_id = 2",
        "customers": "customer_id = 6"},
    "nothing": {"payments": "false"},
}
KEEP = ARRIVALS["facts, one of them a twin that takes a claim out"]


@pytest.fixture(scope="module")
def now(spark):
    return sample.portfolio(spark)


def cut(now, arrivals):
    """The book before, and the arrivals."""
    before, late = {}, {}
    for name, condition in arrivals.items():
        arrives = F.coalesce(F.expr(condition), F.lit(False))
        before[name] = now.table(name).filter(~arrives)
        late[name] = now.table(name).filter(arrives)
    return now.with_tables(**before), late


def refreshed(before, now, touched, keep, previous=None):
    """Customer risk, monitor and trend, each from what was kept before."""
    parts = [refresh.part_of(book, touched) for book in (before, now)]
    parts = [p.with_tables(**{n: keep(p.table(n)) for n in ("policies", "claims", "payments")})
             for p in parts]
    images = keep(refresh.changed_images(*parts, previous, touched))
    customers = refresh.refresh_customers(keep(refresh.customer_state_of(before)), images)
    months = keep(refresh.month_state_of(before))
    monitor = refresh.refresh_monitor(keep(refresh.monitor_rows(months)),
                                      keep(refresh.refresh_months(months, images)), images)
    change = keep(refresh.trend_change(*parts))
    cells = keep(refresh.refresh_cells(keep(refresh.trend_state_of(before)), change))
    trend = refresh.refresh_trend(keep(marts.payment_claims_trend(before)), cells, change, now)
    return (refresh.customer_risk_of(now, customers), marts.finish_monitor(monitor), trend)


@pytest.fixture
def keep(tmp_path):
    """Write a frame and read it again, as the states of a refresh are."""
    names = iter(range(1000))

    def write(df):
        path = str(tmp_path / f"kept-{next(names)}")
        df.coalesce(1).write.parquet(path)
        return df.sparkSession.read.schema(df.schema).parquet(path)

    return write


@pytest.fixture(scope="module")
def rebuilt(now):
    plans = (marts.customer_risk, marts.profitability_monitor, marts.payment_claims_trend)
    return [(df.dtypes, bag(df)) for df in (plan(now) for plan in plans)]


@pytest.mark.parametrize("kind", ARRIVALS)
def test_refreshed_marts_equal_a_rebuild(now, rebuilt, keep, kind):
    before, late = cut(now, ARRIVALS[kind])
    touched = keep(refresh.touched_policies(now, **late))
    for got, want in zip(refreshed(before, now, touched, keep), rebuilt):
        assert (got.dtypes, bag(got)) == want


def test_the_reporting_date_may_move_on(spark, now, rebuilt, keep):
    """Policies earn on, one becomes active, one expires and the calendar grows."""
    before, late = cut(sample.portfolio(spark, as_of=dt.date(2024, 6, 15)), KEEP)
    touched = keep(refresh.touched_policies(now, **late))
    previous = keep(marts.policy_totals(before))
    for got, (_, want) in zip(refreshed(before, now, touched, keep, previous), rebuilt):
        assert bag(got) == want
    with pytest.raises(ValueError):
        refresh.changed_images(now, before, previous, touched)
    with pytest.raises(ValueError):
        refresh.changed_images(before, now)


def test_held_tables_give_the_same_parts(spark, now, tmp_path, keep):
    before, late = cut(now, {**KEEP, "policies": "policy_id = 16", "customers": "customer_id = 2"})
    held = refresh.HeldBook.create(spark, str(tmp_path), before)
    touched = keep(held.touched_by(late))
    assert bag(touched) == bag(refresh.touched_policies(now, **late))
    old = held.part(touched)
    held.add(late)
    new = held.part(touched)
    for part, book in ((old, before), (new, now)):
        assert bag(marts.policy_totals(part)) == bag(
            marts.policy_totals(refresh.part_of(book, touched)))


def test_a_held_book_looks_policies_up_in_its_own_tables_alone(spark, now, tmp_path, monkeypatch):
    """No raw table is searched for touched policies, and the mart is read from a written state."""
    monkeypatch.setattr(registry.star_schema, "portfolio", lambda *_: now)
    monkeypatch.setattr(registry, "scratch_dir", lambda *_: str(tmp_path))
    monkeypatch.setattr(registry.refresh, "touched_policies", lambda *_, **__: pytest.fail("searched"))
    case = registry.Refresh(spark, "", lambda policy, day: F.coalesce(
        day >= F.lit(dt.date(2024, 8, 1)), F.lit(False)))
    got = case.held_book()()
    assert len(list(tmp_path.glob("customers-*"))) == 2
    assert bag(got) == bag(marts.customer_risk(now))


def test_only_touched_buckets_of_the_facts_are_read(spark, now, tmp_path):
    held = refresh.HeldBook.create(spark, str(tmp_path), now)
    touched = spark.createDataFrame([(1,)], "policy_id long")
    part = held.part(touched)
    bucket = spark.range(1).select(
        held.tables["claims"].bucket_of(F.lit(1).cast("long"))).first()[0]
    for name in ("policies", "claims", "payments", "endorsements"):
        files = part.table(name).inputFiles()
        facts = [f for f in files if f"/{name}/" in f]
        assert facts and all(f"_bucket={bucket}/" in f for f in facts)
        # The plan reads nothing else of the table either.
        plan = part.table(name)._jdf.queryExecution().executedPlan().toString()
        assert not re.search(rf"Location: \S+{name}\]", plan)
    every = {re.search(r"_bucket=(\d+)", f)[1] for f in held.tables["claims"].read().inputFiles()}
    assert len(every) > 3


def test_a_refresh_reads_the_state_and_the_touched_parts(spark, now, tmp_path):
    """The unchanged state meets the change without a shuffle of its own."""
    state = str(tmp_path / "state")
    refresh.customer_state_of(now).write.parquet(state)
    before, late = cut(now, KEEP)
    refresh.changed_images(*(refresh.part_of(b, refresh.touched_policies(now, **late))
                             for b in (before, now))).write.parquet(str(tmp_path / "images"))
    images = spark.read.parquet(str(tmp_path / "images"))
    after = refresh.refresh_customers(spark.read.parquet(state), images)
    plan = after._jdf.queryExecution().executedPlan().toString()
    # Only the images are aggregated; the state is scanned and joined to the broadcast change.
    assert "SortMergeJoin" not in plan
    for scan in re.finditer(r"FileScan parquet.*", plan):
        assert "state" in scan.group(0) or "images" in scan.group(0)


ROWS = st.lists(st.tuples(st.sampled_from([None, "a", "b", "c"]),
                          st.one_of(st.none(), st.integers(-5, 5))), max_size=12)


@few
@given(old=ROWS, gone=st.integers(0, 6), new=ROWS)
def test_a_merged_state_is_that_of_all_rows(spark, old, gone, new):
    def frame(rows):
        return spark.createDataFrame([(k, None if v is None else D(v)) for k, v in rows],
                                     "k string, v decimal(18,2)")

    def state(df):
        return deltas.state_of(df, ["k"], {"total": (F.col("v"), "decimal(26,2)")},
                               {"positive": F.col("v") > 0})

    left = old[gone:] + new
    merged = deltas.merge_state(
        state(frame(old)), state(deltas.signed(frame(old[:gone]), frame(new))), ["k"])
    plain = frame(left).groupBy("k").agg(
        F.count_if(F.col("v") > 0).alias("positive"), F.sum("v").cast("decimal(26,2)").alias("total"))
    assert bag(deltas.settled(merged)) == bag(plain)


@few
@given(values=st.lists(st.one_of(st.none(), st.integers(-5, 5)), min_size=1, max_size=8),
       first=st.integers(0, 8))
def test_running_sums_go_on_from_the_carried_row(spark, values, first):
    from riskloom.operators.spine import running_totals

    rows = [(s, i, v) for s in ("a", None) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "k string, at int, v long")
    whole = running_totals(df, ["k"], "at", {"r": "v"})
    stale = running_totals(df.withColumn("v", F.when(F.col("at") < first, F.col("v")).otherwise(9)),
                           ["k"], "at", {"r": "v"})
    firsts = spark.createDataFrame([("a", first), (None, first)], "k string, _first int")
    got = deltas.resume_totals(stale, df.filter(F.col("at") >= first), firsts, ["k"], "at",
                               {"r": "v"})
    assert bag(got) == bag(whole)
    same = deltas.resume_totals(whole, df.limit(0), firsts.limit(0), ["k"], "at", {"r": "v"})
    assert bag(same) == bag(whole)
