"""Every registered query against its SQL, and the shape of the plans."""

import re

import pytest

import __spark_entry__ as registry
from tests.compare import difference, duck, rows

QUERIES = registry.portfolio_queries()


@pytest.fixture(scope="module")
def connection(sf_dir):
    return duck(sf_dir)


def test_every_query_has_sql():
    assert set(registry.oracle_sql()) - set(registry.corpus_queries()) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, sf_dir, connection, name):
    df = QUERIES[name](spark, sf_dir)
    ours = rows(df.columns, [tuple(r) for r in df.collect()])
    cursor = connection.execute(registry.oracle_sql()[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    problem = difference(name, ours, rows(columns, cursor.fetchall()))
    assert problem is None, problem


def test_entry_is_the_loss_ratio_by_type(spark, sf_dir, monkeypatch):
    if sf_dir != "/root/testdata/sf0.001":
        pytest.skip("the entry reads a fixed folder")
    assert registry.entry(spark).columns == [
        "policy_type", "total_claims", "adjusted_premium", "loss_ratio"]


PLANNED = sorted(n for n in QUERIES if not re.match(
    "sql_view_c|load_|reconcile_|refresh_|check_|csv|json_i|.*_staged", n))


@pytest.mark.parametrize("name", PLANNED)
def test_plan_scales(spark, sf_dir, name):
    """No cross joins, no Python, nothing gathered in one task but bounded results."""
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "InPandas"):
        assert operator not in plan
    # The only single-partition steps are aggregates of one row.
    for match in re.finditer(r"Exchange SinglePartition.*\n(.*)", plan):
        assert "Aggregate(keys=[]" in match.group(1), match.group(0)


def test_window_partitions_are_series_only(spark, sf_dir):
    """Windows run over aggregated months, never over raw rows."""
    windowed = {n for n in PLANNED
                if "Window [" in QUERIES[n](spark, sf_dir)._jdf.queryExecution().toString()}
    assert windowed == {"payment_claims_trend", "profitability_monitor", "profitability_dense",
                        "rolling_loss_ratio"}


def test_running_sums_share_one_window(spark, sf_dir):
    for name in ("payment_claims_trend", "profitability_monitor"):
        plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Window [") == 1


def test_scans_read_only_what_is_used(spark, sf_dir):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        df = QUERIES["monthly_payments"](spark, sf_dir)
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    schemas = {re.search(r"(\w+)\.parquet", m.group(0)).group(1): m.group(1)
               for m in re.finditer(r"FileScan parquet.*?ReadSchema: struct<(.*?)>", plan)}
    assert "c_name" not in schemas["customer"]
    assert "l_returnflag" not in schemas["lineitem"]
    assert re.search(r"PushedFilters: \[[^\]]*EqualTo\(l_linestatus,F\)", plan)


@pytest.mark.parametrize("name, scans", [
    ("stage_claims", 1), ("stage_payments", 1), ("dq_tag_payments", 1), ("dq_tag_claims", 2)])
def test_facts_are_scanned_as_often_as_needed(spark, sf_dir, name, scans):
    """Once for the rows, and once more where keys are counted."""
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert len(re.findall(r"FileScan parquet.*/lineitem\.parquet", plan)) == scans
