import datetime as dt
from collections import Counter
from decimal import Decimal
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from tests import sample
from riskloom.operators.changes import snapshot_diff
from riskloom.plans import marts, pipeline, refresh, views
from riskloom.schemas import LOADED_AT, TABLES, stored
from riskloom.session import scratch_dir
from riskloom.sources import files, loads
from riskloom.sources.tables import ConcurrentWrite, VersionedTable
from riskloom.streaming.loads import append_only, landing_stream, refresh_trigger, stream_upsert


def bag(df):
    return Counter(tuple(r) for r in df.collect())


def policies(spark, rows):
    """Rows of (id, type, expiration, premium)."""
    full = [(i, 1, kind, dt.date(2024, 1, 1), sample.d(end), sample.m(premium))
            for i, kind, end, premium in rows]
    return spark.createDataFrame(full, TABLES["policies"]).coalesce(1)


# -- files ---------------------------------------------------------------------------

def test_csv_is_typed_quoted_and_stamped(spark, tmp_path):
    path = tmp_path / "customers.csv"
    path.write_text('customer_id,customer_name,state,industry\n'
                    '1,"Ash, ""Big"" and Co",TX,Retail\n2,Plain,NY,\n')
    df = files.read_csv(spark, str(path), "customers")
    assert [f.name for f in df.schema] == [*TABLES["customers"].names, LOADED_AT]
    assert df.schema[LOADED_AT].dataType.typeName() == "timestamp_ntz"
    rows = df.orderBy("customer_id").collect()
    assert tuple(rows[0])[:4] == (1, 'Ash, "Big" and Co', "TX", "Retail")
    assert rows[1].industry is None and rows[0][LOADED_AT] == rows[1][LOADED_AT]


def test_a_malformed_row_fails_the_load(spark, tmp_path):
    path = tmp_path / "claims.csv"
    path.write_text("claim_id,policy_id,claim_date,claim_amount,claim_status\n1,2,soon,3.00,Open\n")
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|FAILED_READ"):
        files.read_csv(spark, str(path), "claims").collect()


@pytest.mark.parametrize("array_file", [True, False])
def test_json_array_and_lines(spark, tmp_path, array_file):
    records = ['{"endorsement_id": 1, "policy_id": 2, "endorsement_type": "Cancellation",'
               ' "endorsement_date": "2024-05-10", "endorsement_amount": -19.57}',
               '{"endorsement_id": 2, "policy_id": 3, "endorsement_amount": 4}']
    path = tmp_path / "endorsements.json"
    path.write_text("[" + ",\n".join(records) + "]" if array_file else "\n".join(records))
    arrays, lines = files.split_by_form(spark, str(path))
    assert [len(arrays), len(lines)] == [int(array_file), int(not array_file)]
    rows = files.read_json(spark, str(path), "endorsements").orderBy("endorsement_id").collect()
    assert len(rows) == 2
    assert tuple(rows[0])[:5] == (Decimal("-19.57"), dt.date(2024, 5, 10), 1, "Cancellation", 2)
    assert rows[1].endorsement_date is None


def test_a_folder_may_hold_arrays_and_lines(spark, tmp_path):
    record = '{"endorsement_id": %d, "policy_id": 2, "endorsement_amount": 1}'
    (tmp_path / "a.json").write_text("\n [" + ",\n".join(record % i for i in range(5)) + "]")
    (tmp_path / "b.json").write_text("\n".join(record % i for i in range(5, 10)))
    rows = files.read_json(spark, str(tmp_path), "endorsements").collect()
    assert sorted(r.endorsement_id for r in rows) == list(range(10))


def test_json_fields_of_a_column(spark):
    df = spark.createDataFrame([('{"k": 5, "when": "2024-01-02", "a": {"b": "x"}}',), ('{"k": "?"}',)],
                               "j string").coalesce(1)
    fields = {"k": ("$.k", "int"), "when": ("$.when", "date"), "b": ("$.a.b", "string")}
    got = files.extract_json(df, "j", fields, strict=False).drop("j")
    assert bag(got) == Counter([(5, dt.date(2024, 1, 2), "x"), (None, None, None)])
    with pytest.raises(Exception, match="INVALID_VARIANT_CAST"):
        files.extract_json(df, "j", fields).collect()


# -- versioned table -----------------------------------------------------------------

def test_full_reload_replaces_what_it_reads(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    assert not table.exists()
    with pytest.raises(ValueError):
        table.read()
    loads.truncate_insert(table, spark.range(3))
    loads.truncate_insert(table, table.read().filter("id > 0"))
    assert table.version() == 1 and {r.id for r in table.read().collect()} == {1, 2}


def test_a_failed_write_keeps_the_current_version(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    table.replace(spark.range(3))
    broken = spark.range(3).select(F.when(F.col("id") == 2, F.raise_error("broken")).cast("long").alias("id"))
    with pytest.raises(Exception, match="broken"):
        table.replace(broken)
    assert table.version() == 0 and table.read().count() == 3
    table.replace(spark.range(5))
    assert table.version() == 1 and table.read().count() == 5


def test_upsert_updates_stamps_and_inserts(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    before = policies(spark, [(1, "Auto", "2025-01-01", "10.00"), (2, "Auto", "2025-01-01", "20.00"),
                              (3, "Auto", "2025-01-01", None)])
    loads.truncate_insert(table, before.withColumn(LOADED_AT, F.lit(sample.LOADED).cast("timestamp_ntz")))
    after = policies(spark, [(1, "Auto", "2025-01-01", "10.00"), (2, "Auto", "2025-06-01", "20.00"),
                             (3, "Auto", "2025-01-01", "30.00"), (4, "Auto", "2025-01-01", "40.00")])
    later = dt.datetime(2025, 2, 1)
    loads.merge_upsert(table, after, loaded_at=F.lit(later).cast("timestamp_ntz"))
    got = {r.policy_id: (r.expiration_date, r.premium, r[LOADED_AT]) for r in table.read().collect()}
    assert got == {
        1: (dt.date(2025, 1, 1), Decimal("10.00"), sample.LOADED),
        2: (dt.date(2025, 6, 1), Decimal("20.00"), later),
        3: (dt.date(2025, 1, 1), None, sample.LOADED),     # NULL to value is no change
        4: (dt.date(2025, 1, 1), Decimal("40.00"), later),
    }
    loads.merge_upsert(table, after.filter("policy_id = 3"), null_safe=True)
    assert {r.premium for r in table.read().filter("policy_id = 3").collect()} == {Decimal("30.00")}


def stored_files(folder):
    return {str(p): p.stat().st_mtime_ns for p in folder.rglob("*.parquet")}


def test_upsert_leaves_untouched_buckets_alone(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"), "policy_id", buckets=8)
    table.replace(policies(spark, [(i, "Auto", "2025-01-01", "10.00") for i in range(50)]))
    before = stored_files(tmp_path)
    loads.merge_upsert(table, policies(spark, [(7, "Auto", "2025-01-01", "11.00"),
                                               (99, "Auto", "2025-01-01", "9.00")]))
    after = stored_files(tmp_path)
    assert all(after[f] == t for f, t in before.items()) and len(after) - len(before) <= 2
    premiums = {r.policy_id: int(r.premium) for r in table.read().collect()}
    assert premiums == {i: 10 for i in range(50)} | {7: 11, 99: 9}
    assert 1 <= table.vacuum() <= 2 and len(stored_files(tmp_path)) == len(before)
    assert {r.policy_id: int(r.premium) for r in table.read().collect()} == premiums


def test_the_second_of_two_writers_fails(spark, tmp_path):
    one, two = (VersionedTable(spark, str(tmp_path / "t")) for _ in range(2))
    one.replace(spark.range(3))
    started = two._current()
    one.replace(spark.range(4))
    with pytest.raises(ConcurrentWrite):
        two._write(spark.range(9), started, {}, None, None)
    assert two.version() == 1 and two.read().count() == 4


# -- streaming -------------------------------------------------------------------------

def batches(query):
    query.awaitTermination()
    return sum(1 for p in query.recentProgress if p["numInputRows"] > 0)


def test_append_takes_each_file_once(spark, tmp_path):
    landing, target, checkpoint = (str(tmp_path / n) for n in ("landing", "target", "checkpoint"))

    def load():
        return batches(append_only(landing_stream(spark, landing, "policies"), target, checkpoint))

    policies(spark, [(1, "Auto", "2025-01-01", "10.00")]).write.parquet(landing)
    assert load() == 1
    assert load() == 0
    policies(spark, [(1, "Auto", "2025-01-01", "10.00"), (2, "Auto", "2025-01-01", "20.00")]
             ).write.mode("append").parquet(landing)
    assert load() == 1
    loaded = spark.read.parquet(target)
    assert Counter(r.policy_id for r in loaded.collect()) == Counter({1: 2, 2: 1})
    assert loaded.filter(F.col(LOADED_AT).isNull()).count() == 0


def test_change_feed_upserts_once_per_batch(spark, tmp_path):
    landing, checkpoint = str(tmp_path / "landing"), str(tmp_path / "checkpoint")
    table = VersionedTable(spark, str(tmp_path / "t"))
    before = policies(spark, [(1, "Auto", "2025-01-01", "10.00"), (2, "Auto", "2025-01-01", "20.00")])
    after = policies(spark, [(1, "Auto", "2025-01-01", "11.00"), (3, "Auto", "2025-01-01", "30.00")])
    table.replace(before.withColumn(LOADED_AT, F.localtimestamp()))
    snapshot_diff(before, after, "policy_id").coalesce(1).write.parquet(landing)

    def load(**options):
        rows = landing_stream(spark, landing, "policies", change_feed=True)
        return batches(stream_upsert(rows, table, checkpoint, **{"unique_keys": True} | options))

    assert load() == 1 and load() == 0
    # The delete does not propagate.
    assert {(r.policy_id, int(r.premium)) for r in table.read().collect()} == {(1, 11), (2, 20), (3, 30)}
    assert table.version() == 1 and table.has_batch(checkpoint, 0)
    assert not table.has_batch("another stream", 0)


def test_the_last_delivered_version_wins(spark, tmp_path):
    landing = str(tmp_path / "landing")
    table = VersionedTable(spark, str(tmp_path / "t"))
    table.replace(policies(spark, [(1, "Auto", "2025-01-01", "10.00")]))
    policies(spark, [(1, "Auto", "2025-02-01", "12.00"), (1, "Auto", "2025-03-01", "11.00")]
             ).write.parquet(landing)
    rows = landing_stream(spark, landing, "policies")
    stream_upsert(rows, table, str(tmp_path / "c"), order_by=["expiration_date"]).awaitTermination()
    assert [r.premium for r in table.read().collect()] == [Decimal("11.00")]


def test_refresh_interval():
    assert refresh_trigger() == {"availableNow": True}
    assert refresh_trigger(continuous=True) == {"processingTime": "60 minutes"}


# -- pipeline, refresh, views ------------------------------------------------------------

def test_delivery_to_marts(spark, tmp_path):
    book, delivery = sample.portfolio(spark), tmp_path / "delivery"
    for name, file in loads.DELIVERY.items():
        rows = book.table(name).drop(LOADED_AT)
        if file.endswith("csv"):
            rows.write.csv(str(delivery / file), header=True, quote='"', escape='"')
        else:
            rows.write.json(str(delivery / file))
    written = pipeline.run(spark, str(delivery), str(tmp_path / "out"), sample.AS_OF, sample.START)
    assert set(written) == {
        "policy_totals", "payment_claims_trend", "customer_risk", "profitability_monitor"}
    for name in ("customer_risk", "payment_claims_trend", "policy_totals"):
        assert bag(written[name]) == bag(getattr(marts, name)(book))
    raw = VersionedTable(spark, str(tmp_path / "out/raw/claims")).read()
    assert raw.schema == stored("claims")


def test_refreshing_touched_policies_equals_a_rebuild(spark):
    now = sample.portfolio(spark)
    late = F.col("claim_id").isin(3, 5) & F.col("policy_id").isin(2, 777)
    new_claims = now.claims.filter(late)
    new_payments = now.payments.filter("payment_id = 6")
    before = now.with_tables(claims=now.claims.filter(~late | F.col("claim_id").isNull()),
                             payments=now.payments.filter("payment_id != 6"))
    touched = refresh.touched_policies(now, claims=new_claims, payments=new_payments)
    # Claim 5 arrives a second time, which takes the first one out of policy 1.
    assert {r.policy_id for r in touched.collect()} == {1, 2, 13, 777}
    previous = marts.policy_totals(before)
    assert bag(previous) != bag(marts.policy_totals(now))
    refreshed = refresh.refresh_policy_totals(previous, now, touched)
    assert bag(refreshed) == bag(marts.policy_totals(now))
    owned = refresh.touched_policies(now, customers=now.customers.filter("customer_id = 1"))
    assert {r.policy_id for r in owned.collect()} == {1, 2}


def test_views_answer_sql(spark):
    names = views.register(spark, sample.portfolio(spark), prefix="t_")
    assert len(names) == 21
    got = spark.sql("SELECT risk_tier, count(*) FROM t_customer_risk_v GROUP BY 1").collect()
    assert sum(r[1] for r in got) == 5


def test_namespaces(spark):
    loads.create_namespaces(spark)
    assert {"raw", "stage", "mart"} <= {d.name for d in spark.catalog.listDatabases()}


def session(master, **conf):
    return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master))


def test_scratch_follows_the_session_setting():
    shared = session("yarn", **{"spark.checkpoint.dir": "hdfs://shared/tmp/"})
    assert scratch_dir(shared, "x").startswith("hdfs://shared/tmp/x-")
    assert scratch_dir(shared, "x") != scratch_dir(shared, "x")
    assert "riskloom-" in scratch_dir(session("local[2]"), "x")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_dir(session("yarn"), "x")


def test_forms_are_told_by_the_tasks(spark, tmp_path):
    """Compressed files, white space and spaces in names; an empty file is of no form."""
    import gzip

    record = '{"endorsement_id": %d, "policy_id": 1}'
    folder = tmp_path / "a b"
    (folder / "deep").mkdir(parents=True)
    (folder / "array.json").write_text("\n  [\n" + record % 1 + ",\n" + record % 2 + "]\n")
    (folder / "deep" / "lines.json").write_text(record % 3 + "\n\n" + record % 4 + "\n")
    (folder / "empty.json").write_text("")
    with gzip.open(folder / "more.json.gz", "wt") as out:
        out.write("[" + record % 5 + "]")
    arrays, lines = files.split_by_form(spark, str(folder))
    assert [len(arrays), len(lines)] == [2, 1]
    got = files.read_json(spark, str(folder), "endorsements")
    assert sorted(r.endorsement_id for r in got.collect()) == [1, 2, 3, 4, 5]


def test_a_large_bucket_is_written_by_several_tasks(spark, tmp_path):
    """The bucket stays one folder, whose files are of the advised size."""
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        table = VersionedTable(spark, str(tmp_path / "t"), "k", buckets=2)
        rows = spark.range(0, 40000, 1, 8).selectExpr("if(id % 5 > 0, 7, id) AS k", "uuid() AS v")
        table.replace(rows)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    folders = Counter(f.rsplit("/", 2)[1] for f in table.read().inputFiles())
    assert len(folders) == 2 and max(folders.values()) > 4
    assert table.read().count() == 40000
    # Another handle goes by the number in the commit.
    again = VersionedTable(spark, str(tmp_path / "t"), "k", buckets=50)
    bucket = spark.range(1).select(again.bucket_of(F.lit(7).cast("long"))).first()[0]
    assert bucket in (0, 1) and again.read([bucket]).filter("k = 7").count() == 32000
