import datetime as dt
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from riskloom.operators import changes, keys, quality, reconcile, sets, skew, spine

PAIRS = st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 4)), st.integers(0, 3)), max_size=25)
few = settings(max_examples=6, deadline=None,
               suppress_health_check=[HealthCheck.function_scoped_fixture])


def frame(spark, rows, schema="k int, v int"):
    return spark.createDataFrame(rows, schema)


def bag(df):
    return Counter(tuple(r) for r in df.collect())


# -- keys ------------------------------------------------------------------------

@few
@given(rows=PAIRS)
def test_keep_unique_drops_every_copy(spark, rows):
    count = Counter(k for k, _ in rows)
    df = frame(spark, rows)
    assert bag(keys.keep_unique(df, "k")) == Counter(r for r in rows if count[r[0]] == 1)
    assert bag(keys.keep_unique(df, "k", drop_null_keys=True)) == Counter(
        r for r in rows if r[0] is not None and count[r[0]] == 1)


@few
@given(rows=PAIRS)
def test_key_counts_match_a_window(spark, rows):
    count = Counter(k for k, _ in rows)
    expected = Counter((k, v, count[k]) for k, v in rows)
    assert bag(keys.with_key_count(frame(spark, rows), "k", "n", hot_rows=2)) == expected
    assert bag(keys.with_key_count(frame(spark, rows), "k", "n")) == expected
    repeated = {(k, n) for k, n in count.items() if n > 1}
    assert {tuple(r) for r in keys.duplicate_keys(frame(spark, rows), "k").collect()} == repeated


def test_weights_count_as_copies(spark):
    df = frame(spark, [(1, 1), (2, 2)])
    assert bag(keys.keep_unique(df, "k", weight=F.col("v"))) == Counter([(1, 1)])


# -- skewed lookups ----------------------------------------------------------------

@few
@given(rows=PAIRS, right=st.sets(st.integers(0, 4)), how=st.sampled_from(
    ["inner", "left", "left_semi", "left_anti"]))
def test_lookup_join_equals_a_plain_join(spark, rows, right, how):
    left = frame(spark, rows).repartition(3)
    other = frame(spark, [(k, k * 10) for k in right], "k int, w int")
    assert bag(skew.lookup_join(left, other, "k", how, hot_rows=2)) == bag(
        left.join(other, "k", how))


@pytest.mark.parametrize("how, expected", [
    ("left", 4000), ("inner", 3000), ("left_semi", 3000), ("left_anti", 1000)])
def test_a_hot_key_is_spread_over_tasks(spark, how, expected):
    """Three quarters of the rows share one key, a few have none."""
    rows = spark.range(0, 4000, 1, 8).selectExpr(
        "IF(id % 4 < 3, 7, IF(id % 8 = 3, NULL, 1000 + id)) AS k", "id AS v")
    other = frame(spark, [(7, 70)], "k int, w int")
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "8",
            "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)

    def most(df):
        return max(r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect())

    try:
        joined = skew.lookup_join(rows, other, "k", how, hot_rows=100)
        assert joined.count() == expected
        # Behind the exchange by which rows learn their salt, and behind that of the join.
        hot = skew.hot_keys(skew.key_counts(rows, ["k"]), ["k"], 100)
        assert most(skew.spread_rows(rows, hot, ["k"], how in ("left", "left_anti"))) < 1200
        assert most(joined) < 1200
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


@few
@given(rows=PAIRS, hot_rows=st.integers(1, 5))
def test_hot_keys_are_few(spark, rows, hot_rows):
    counts = skew.key_counts(frame(spark, rows), ["k"])
    assert skew.hot_keys(counts, ["k"], hot_rows).count() <= len(rows) / hot_rows


# -- sets --------------------------------------------------------------------------

@few
@given(left=PAIRS, right=PAIRS)
def test_difference_is_distinct_and_null_safe(spark, left, right):
    got = bag(sets.set_difference(frame(spark, left), frame(spark, right)))
    assert got == Counter(set(left) - set(right))


# -- tagging -----------------------------------------------------------------------

def test_first_violated_rule_wins_and_unknown_is_valid(spark):
    df = frame(spark, [(1, -1), (None, -1), (1, None), (5, 5)])
    rules = [quality.Rule("NO_KEY", F.col("k").isNull()), quality.Rule("NEGATIVE", F.col("v") < 0),
             quality.Rule("BIG", F.col("v") > 3)]
    tagged = quality.tag(df, rules)
    assert [r.dq_reason for r in tagged.collect()] == ["NEGATIVE", "NO_KEY", None, "BIG"]
    assert bag(quality.valid(tagged)) == Counter([(1, None)])


def test_missing_values_per_column(spark):
    got = quality.missing_values(frame(spark, [(None, 1), (None, None)]), "t")
    assert bag(got) == Counter([("t", "k", 2), ("t", "v", 1)])


# -- spine -------------------------------------------------------------------------

def months(spark, start, until):
    column = spine.calendar(F.lit(start), F.lit(until))
    return spark.range(1).select(column.alias("c")).first()[0]


def test_calendar_ends_with_the_report_date(spark):
    got = months(spark, dt.date(2024, 5, 1), dt.date(2026, 12, 15))
    assert (len(got), got[0], got[-1]) == (32, dt.date(2024, 5, 1), dt.date(2026, 12, 1))
    assert len(months(spark, dt.date(2024, 5, 1), dt.date(2024, 5, 1))) == 1
    assert months(spark, dt.date(2024, 5, 1), dt.date(2024, 4, 30)) == []
    assert len(months(spark, dt.date(2024, 5, 1), dt.date(2050, 1, 1))) == 12 * 25 + 9
    assert months(spark, dt.date(2024, 5, 15), dt.date(2024, 6, 14)) == [
        dt.date(2024, 5, 1), dt.date(2024, 6, 1)]


@few
@given(facts=st.dictionaries(st.tuples(st.integers(0, 2), st.one_of(st.none(), st.integers(0, 30))),
                             st.one_of(st.none(), st.integers(-3, 3)), max_size=12))
def test_densify_fills_and_cuts(spark, facts):
    def day(n):
        return None if n is None else dt.date(2024, 1, 1) + dt.timedelta(n)

    df = frame(spark, [(k, day(n), v) for (k, n), v in facts.items()], "k int, d date, v int")
    wanted = [day(n) for n in range(5, 20)]
    got = spine.densify(df, ["k"], "d", ["v"], F.lit(wanted))
    assert bag(got) == Counter((k, d, facts.get((k, n), 0) or 0)
                               for k in {k for k, _ in facts} for n, d in enumerate(wanted, 5))


def test_densify_may_follow_the_series(spark):
    df = frame(spark, [(1, dt.date(2024, 1, 1), 5), (1, dt.date(2024, 3, 1), 7)], "k int, d date, v int")
    months = F.sequence("_first", "_last", F.expr("interval 1 month"))
    assert [r.v for r in spine.densify(df, ["k"], "d", ["v"], months).orderBy("d").collect()] == [5, 0, 7]


@few
@given(values=st.lists(st.one_of(st.none(), st.integers(-5, 5)), min_size=1, max_size=15))
def test_running_total_ends_at_the_sum(spark, values):
    df = frame(spark, [(1, i, v) for i, v in enumerate(values)], "k int, o int, v int")
    rolled = spine.running_totals(df, ["k"], "o", {"r": "v"}).orderBy("o").collect()
    known = [v for v in values if v is not None]
    assert rolled[-1].r == (sum(known) if known else None)


# -- changes -----------------------------------------------------------------------

SNAPSHOT = st.dictionaries(st.one_of(st.none(), st.integers(0, 6)), st.one_of(st.none(), st.integers(0, 2)), max_size=7)


@few
@given(old=SNAPSHOT, new=SNAPSHOT)
def test_replaying_a_diff_gives_the_new_snapshot(spark, old, new):
    before, after = frame(spark, list(old.items())), frame(spark, list(new.items()))
    diff = changes.snapshot_diff(before, after, "k")
    assert bag(changes.apply_changes(before, diff, "k")) == bag(after)
    images = bag(diff)
    for k in old.keys() & new.keys():
        changed = old[k] != new[k]
        assert images[("DELETE", True, k, old[k])] == images[("INSERT", True, k, new[k])] == changed
    for k in old.keys() - new.keys():
        assert images[("DELETE", False, k, old[k])] == 1


def test_diff_rejects_a_repeated_key(spark):
    twice = frame(spark, [(1, 1), (1, 2)])
    with pytest.raises(Exception, match="k is not unique in a snapshot"):
        changes.snapshot_diff(twice, frame(spark, []), "k").collect()


@few
@given(old=SNAPSHOT, new=SNAPSHOT, null_safe=st.booleans())
def test_upsert_is_idempotent_and_deletes_nothing(spark, old, new, null_safe):
    new.pop(None, None)  # a row without a key is inserted every time
    target, source = frame(spark, list(old.items())), frame(spark, list(new.items()))
    once = changes.upsert(target, source, "k", ["v"], null_safe=null_safe, hot_rows=2)
    expected = dict(old)
    for k, v in new.items():
        if k not in old or null_safe or None not in (old[k], v):
            expected[k] = v
    assert bag(once) == Counter(expected.items())
    assert bag(changes.upsert(once, source, "k", ["v"], null_safe=null_safe)) == bag(once)


def test_upsert_inserts_every_row_without_a_key(spark):
    merged = changes.upsert(frame(spark, [(None, 1)]), frame(spark, [(None, 2), (None, 2)]), "k", ["v"])
    assert bag(merged) == Counter({(None, 1): 1, (None, 2): 2})


def test_upsert_updates_every_copy_in_the_target(spark):
    target = frame(spark, [(1, 1)] * 5 + [(2, 2)])
    merged = changes.upsert(target, frame(spark, [(1, 9)]), "k", ["v"], hot_rows=2)
    assert bag(merged) == Counter([(1, 9)] * 5 + [(2, 2)])


def test_upsert_rejects_a_repeated_source_key(spark):
    source = frame(spark, [(1, 1), (1, 2)])
    with pytest.raises(Exception, match="k is not unique in the source"):
        changes.upsert(frame(spark, [(1, 0)]), source, "k", ["v"]).collect()


def test_latest_keeps_the_last_version(spark):
    rows = [(1, 5), (1, 7), (1, 6), (2, 1)]
    assert bag(changes.latest(frame(spark, rows), "k", ["v"])) == Counter([(1, 7), (2, 1)])


# -- reconciliation ------------------------------------------------------------------

def test_reconcile_compares_within_tolerance(spark):
    a, b = frame(spark, [(1, 10), (2, 5)]), frame(spark, [(1, 14)])
    parts = [reconcile.figures(a, "left", {"v.sum": F.sum("v"), "v.min": F.min("v")}),
             reconcile.figures(b, "right", {"v.sum": F.sum("v")})]
    got = {r.check_name: r for r in reconcile.reconcile(parts, tolerance=1).collect()}
    assert got["v.sum"].passed and got["v.sum"].difference == 1
    assert not got["v.min"].passed and got["v.min"].right_value == 0
