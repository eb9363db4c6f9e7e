"""Query registry: each entry reads the tables under ``sf_dir`` in full."""

from __future__ import annotations

import datetime as dt
import importlib
import os
import sys
import uuid
from collections.abc import Callable
from functools import cached_property, reduce
from importlib.util import find_spec

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import Column, DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

import oracle_queries  # noqa: E402
from riskloom.functions import null_if_zero, ratio  # noqa: E402
from riskloom.operators.changes import snapshot_diff  # noqa: E402
from riskloom.plans import checks, findings, marts, refresh, views  # noqa: E402
from riskloom.plans.pipeline import observed_build, staged_with_totals  # noqa: E402
from riskloom.plans.portfolio import Portfolio  # noqa: E402
from riskloom.schemas import LOADED_AT  # noqa: E402
from riskloom.session import scratch_dir  # noqa: E402
from riskloom.sources import files, loads, star_schema  # noqa: E402
from riskloom.sources.loads import merge_upsert, truncate_insert  # noqa: E402
from riskloom.sources.tables import VersionedTable  # noqa: E402
from riskloom.streaming.loads import append_dedup, append_only, landing_stream, stream_upsert  # noqa: E402

Query = Callable[[SparkSession, str], DataFrame]

# The trend agrees with the clean facts once the calendar reaches the last of them.
LAST_FACT_MONTH = dt.date(2001, 11, 30)


def edge(df: DataFrame) -> DataFrame:
    """Exact decimals as doubles and load times as text, for comparison outside Spark."""
    columns = []
    for field in df.schema.fields:
        column = F.col(field.name)
        if isinstance(field.dataType, T.DecimalType):
            exact = F.round(column, 4) if field.dataType.scale > 4 else column
            column = exact.cast("double")
        elif isinstance(field.dataType, T.TimestampNTZType):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss")
        columns.append(column.alias(field.name))
    return df.select(*columns)


def _on(plan: Callable[[Portfolio], DataFrame], as_of: dt.date = star_schema.AS_OF) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return edge(plan(star_schema.portfolio(spark, sf_dir, as_of)))

    return run


def _on_written(plan: Callable[[Portfolio], DataFrame],
                as_of: dt.date = star_schema.AS_OF) -> Query:
    """Run a check over written clean views and totals, as after a nightly build."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        book = star_schema.portfolio(spark, sf_dir, as_of)
        return edge(plan(staged_with_totals(spark, book, scratch_dir(spark, "stage"))))

    return run


def _div0(book: Portfolio) -> DataFrame:
    closed = F.col("closed_claim_total")
    unresolved = F.coalesce(F.col("op_claim_total"), F.lit(0))
    return marts.policy_totals(book).select(
        "policy_id",
        ratio(closed, unresolved).alias("zero_on_zero"),
        ratio(closed, null_if_zero(unresolved)).alias("null_on_zero"),
    )


# -- loads -------------------------------------------------------------------

def _csv_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers delivered as CSV, read back with their fixed schema."""
    path = scratch_dir(spark, "csv")
    rows = star_schema.customers(spark, sf_dir).drop(LOADED_AT)
    rows.write.csv(path, header=True, quote='"', escape='"')
    return edge(files.read_csv(spark, path, "customers").drop(LOADED_AT))


def _json_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Endorsements delivered as JSON records, read back with their fixed schema."""
    path = scratch_dir(spark, "json")
    star_schema.endorsements(spark, sf_dir).drop(LOADED_AT).write.json(path)
    return edge(files.read_json(spark, path, "endorsements").drop(LOADED_AT))


def _json_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = star_schema.star_table(spark, sf_dir, "events").select("event_id", "props")
    return files.extract_json(events, "props", {"k": ("$.k", "bigint")}).select("event_id", "k")


def _snapshots(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Two states of the policy book: the later one lacks the oldest policies, has
    newer ones, reprices urgent policies and prolongs high-priority ones."""
    book = star_schema.portfolio(spark, sf_dir).clean_policies()
    kind, effective = F.col("policy_type"), F.col("effective_date")
    before = book.filter(effective < F.lit(dt.date(2001, 1, 1)))
    after = book.filter(effective >= F.lit(dt.date(1995, 7, 1))).withColumns({
        "premium": F.when(kind == "1-URGENT", F.col("premium") + 100)
        .otherwise(F.col("premium")).cast("decimal(18,2)"),
        "expiration_date": F.when(kind == "2-HIGH", F.add_months("expiration_date", 6))
        .otherwise(F.col("expiration_date")),
    })
    return before, after


def _merge_time():
    return F.lit("2001-02-01 00:00:00").cast("timestamp_ntz")


def _snapshot_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    before, after = (s.drop(LOADED_AT) for s in _snapshots(spark, sf_dir))
    return edge(snapshot_diff(before, after, "policy_id"))


def _load_truncate_insert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two full reloads; the second, of all raw policies, is what remains."""
    table = VersionedTable(spark, scratch_dir(spark, "reload"))
    truncate_insert(table, _snapshots(spark, sf_dir)[0])
    truncate_insert(table, star_schema.portfolio(spark, sf_dir).policies)
    return edge(table.read())


def _load_delivery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four CSV tables and files of JSON arrays, loaded, counted and cleaned."""
    base = scratch_dir(spark, "delivery")
    book = star_schema.portfolio(spark, sf_dir)
    for name, file in loads.DELIVERY.items():
        rows = book.table(name).drop(LOADED_AT)
        if file.endswith(".csv"):
            rows.write.csv(f"{base}/in/{file}", header=True, quote='"', escape='"')
        else:
            # A thousand records or so to a file, one array in each.
            files_needed = max(1, round(rows.count() / 1000))
            (rows.groupBy(F.pmod(F.xxhash64("endorsement_id"), F.lit(files_needed)).alias("file"))
             .agg(F.to_json(F.collect_list(F.struct(*rows.columns))).alias("value"))
             .write.partitionBy("file").text(f"{base}/in/{file}"))
    loaded = loads.load_delivery(spark, f"{base}/in", f"{base}/raw")
    held = Portfolio({name: table.read for name, table in loaded.items()}, star_schema.AS_OF)
    staged = held.staged(spark, f"{base}/stage")
    clean = {"customers": staged.clean_customers(), "policies": staged.clean_policies(),
             "claims": staged.clean_claims(), "payments": staged.clean_payments(),
             "endorsements": staged.clean_endorsements()}

    def count(tables: dict[str, DataFrame], column: str) -> DataFrame:
        return reduce(DataFrame.unionByName, [
            df.agg(F.count(F.lit(1)).alias(column)).withColumn("table_name", F.lit(name))
            for name, df in tables.items()])

    return count({n: held.table(n) for n in clean}, "row_count").join(
        count(clean, "clean_count"), "table_name")


def _load_merge_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    before, after = _snapshots(spark, sf_dir)
    table = VersionedTable(spark, scratch_dir(spark, "upsert"), "policy_id")
    truncate_insert(table, before)
    merge_upsert(table, after.drop(LOADED_AT), loaded_at=_merge_time())
    return edge(table.read())


def _load_stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same merge, fed from a change feed dropped into a landing directory."""
    before, after = _snapshots(spark, sf_dir)
    base = scratch_dir(spark, "stream-upsert")
    table = VersionedTable(spark, f"{base}/target", "policy_id")
    truncate_insert(table, before)
    snapshot_diff(before.drop(LOADED_AT), after.drop(LOADED_AT), "policy_id").write.parquet(
        f"{base}/landing")
    rows = landing_stream(spark, f"{base}/landing", "policies", change_feed=True)
    stream_upsert(rows, table, f"{base}/checkpoint", loaded_at=_merge_time(),
                  unique_keys=True).awaitTermination()
    return edge(table.read())


def _load_append_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payments arriving in two deliveries, each appended by its own run."""
    base = scratch_dir(spark, "append")
    payments = star_schema.payments(spark, sf_dir).drop(LOADED_AT)
    early = F.col("payment_date") < F.lit(dt.date(1998, 1, 1))
    for delivery in (payments.filter(early), payments.filter(~early)):
        delivery.write.mode("append").parquet(f"{base}/landing")
        rows = landing_stream(spark, f"{base}/landing", "payments")
        append_only(rows, f"{base}/target", f"{base}/checkpoint").awaitTermination()
    return edge(spark.read.parquet(f"{base}/target").drop(LOADED_AT))


def written(df: DataFrame, path: str) -> DataFrame:
    """``df`` as a table that later steps read."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Refresh:
    """The book before and after late claims and payments, and the policies they touch.

    ``late`` tells by policy key and date which facts arrive late.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, late: Callable[[Column, Column], Column]):
        self.spark = spark
        self.path = scratch_dir(spark, "refresh")
        self.now = star_schema.portfolio(spark, sf_dir)
        claim, payment = (late(F.col("policy_id"), F.col(d)) for d in ("claim_date", "payment_date"))
        self.arrivals = {"claims": self.now.claims.filter(claim),
                         "payments": self.now.payments.filter(payment)}
        self.before = self.now.with_tables(claims=self.now.claims.filter(~claim),
                                           payments=self.now.payments.filter(~payment))

    @cached_property
    def touched(self) -> DataFrame:
        """The keys are used several times over, so they are worked out once and written."""
        return self.kept("touched", refresh.touched_policies(self.now, **self.arrivals))

    def kept(self, name: str, df: DataFrame) -> DataFrame:
        return written(df, f"{self.path}/{name}-{uuid.uuid4().hex}")

    def parts(self) -> tuple[Portfolio, Portfolio]:
        return tuple(refresh.part_of(book, self.touched) for book in (self.before, self.now))

    def risk_after(self, state: DataFrame, images: DataFrame) -> DataFrame:
        """Customer risk from the next state, which is written: the mart's sort reads it twice."""
        after = self.kept("customers", refresh.refresh_customers(state, images))
        return refresh.customer_risk_of(self.now, after)

    def images(self) -> DataFrame:
        return self.kept("images", refresh.changed_images(*self.parts()))

    # Each gives a function that only does what follows an arrival.

    def policy_totals(self) -> Callable[[], DataFrame]:
        totals = self.kept("totals", marts.policy_totals(self.before))
        return lambda: refresh.refresh_policy_totals(totals, self.now, self.touched)

    def customer_risk(self) -> Callable[[], DataFrame]:
        state = self.kept("customers", refresh.customer_state_of(self.before))
        self.touched
        return lambda: self.risk_after(state, self.images())

    def monitor(self) -> Callable[[], DataFrame]:
        state = self.kept("months", refresh.month_state_of(self.before))
        previous = self.kept("monitor", refresh.monitor_rows(state))

        def step() -> DataFrame:
            images = self.images()
            after = self.kept("months", refresh.refresh_months(state, images))
            return marts.finish_monitor(refresh.refresh_monitor(previous, after, images))

        return step

    def trend(self) -> Callable[[], DataFrame]:
        state = self.kept("cells", refresh.trend_state_of(self.before))
        previous = self.kept("trend", marts.payment_claims_trend(self.before))

        def step() -> DataFrame:
            change = self.kept("change", refresh.trend_change(*self.parts()))
            after = self.kept("cells", refresh.refresh_cells(state, change))
            return refresh.refresh_trend(previous, after, change, self.now)

        return step

    def held_book(self) -> Callable[[], DataFrame]:
        """Customer risk from tables of which only the touched buckets are read."""
        held = refresh.HeldBook.create(self.spark, f"{self.path}/held", self.before)
        state = self.kept("customers", refresh.customer_state_of(self.before))

        def step() -> DataFrame:
            touched = self.kept("touched", held.touched_by(self.arrivals))
            old = held.part(touched)
            held.add(self.arrivals)
            images = self.kept("images", refresh.changed_images(old, held.part(touched)))
            return self.risk_after(state, images)

        return step


def _since_2001(policy: Column, day: Column) -> Column:
    return day >= F.lit(dt.date(2001, 1, 1))


def one_percent(policy: Column, day: Column) -> Column:
    """The facts of every hundredth policy."""
    return policy % 100 == 7


def _load_append_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payments in three deliveries that repeat rows, their own and those of earlier ones."""
    base = scratch_dir(spark, "dedup")
    payments = star_schema.payments(spark, sf_dir).drop(LOADED_AT)
    year = F.year("payment_date")
    deliveries = (
        payments.filter(year < 1998).unionByName(payments.filter((year < 1998) & (F.col("payment_id") % 5 == 0))),
        payments.filter(year.between(1997, 1999)),
        payments.filter(year != 1998),
    )
    for delivery in deliveries:
        delivery.write.mode("append").parquet(f"{base}/landing")
        rows = landing_stream(spark, f"{base}/landing", "payments")
        append_dedup(rows, f"{base}/target", f"{base}/checkpoint", payments.columns).awaitTermination()
    return edge(spark.read.parquet(f"{base}/target").drop(LOADED_AT))


def _on_staged(plan: Callable[[Portfolio], DataFrame], **layout) -> Query:
    """Run a mart over clean views laid out for it."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        book = star_schema.portfolio(spark, sf_dir)
        return edge(plan(book.staged(spark, scratch_dir(spark, "staged"), **layout)))

    return run


def _reconcile_observed(spark: SparkSession, sf_dir: str) -> DataFrame:
    book = star_schema.portfolio(spark, sf_dir)
    _, metrics = observed_build(spark, book, scratch_dir(spark, "observed"))
    return edge(checks.reconcile_observed(spark, metrics))


def _reconcile_fingerprints(doctored: bool) -> Query:
    """Marts against facts; doctored, two policies have errors that cancel each other."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        book = staged_with_totals(spark, star_schema.portfolio(spark, sf_dir),
                                  scratch_dir(spark, "prints"))
        totals = marts.policy_totals(book)
        if doctored:
            ends = totals.filter("op_claim_total IS NOT NULL").agg(
                F.min("policy_id").alias("first"), F.max("policy_id").alias("last")).first()
            error = F.when(F.col("policy_id") == ends["first"], 1).when(
                F.col("policy_id") == ends["last"], -1).otherwise(0)
            totals = totals.withColumn("op_claim_total", (F.col("op_claim_total") + error)
                                       .cast(totals.schema["op_claim_total"].dataType))
        return edge(checks.reconcile_fingerprints(spark, book, totals))

    return run


def _refreshed(mart: str) -> Query:
    """A mart written before the facts of the last year arrived, then brought up to date."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return edge(getattr(Refresh(spark, sf_dir, _since_2001), mart)()())

    return run


def _sql_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The registered views, queried with SQL."""
    views.register(spark, star_schema.portfolio(spark, sf_dir), prefix="riskloom_",
                   names=["policies_v", "customer_risk_v"])
    return edge(spark.sql("""
        SELECT p.policy_type, r.risk_tier, count(*) AS policies, sum(p.premium) AS premium
        FROM riskloom_policies_v p
        JOIN riskloom_customer_risk_v r ON r.customer_id = p.customer_id
        GROUP BY p.policy_type, r.risk_tier
    """))


# The views over clean data, audits and marts.
VIEWS = ["customers_v", "policies_v", "claims_v", "payments_v", "endorsements_v",
         "policies_tagged_v", "claims_dq_v", "payments_dq_v", "policy_totals_v",
         "payment_claims_trend_v", "customer_risk_v", "profitability_monitor_v"]


def _sql_view_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of each view, counted with SQL."""
    views.register(spark, star_schema.portfolio(spark, sf_dir), "riskloom_", VIEWS)
    return spark.sql(" UNION ALL ".join(
        f"SELECT '{v}' AS view_name, count(*) AS row_count FROM riskloom_{v}" for v in VIEWS))


def _flags_doctored(book: Portfolio) -> DataFrame:
    """The check on a mart in which every seventh customer has an impossible flag."""
    wrong = F.when(F.col("customer_id") % 7 == 0, 2).otherwise(F.col("flag_collection"))
    return checks.flag_domain(book, marts.customer_risk(book).withColumn("flag_collection", wrong))


def _status_doctored(book: Portfolio) -> DataFrame:
    """The check on a monitor that calls every month unprofitable."""
    return checks.status_thresholds(book, marts.profitability_monitor(book).withColumn(
        "profitability_status", F.lit("Unprofitable")))


def _profit_doctored(book: Portfolio) -> DataFrame:
    """The check on a monitor whose profit is too high in every May."""
    wrong = F.col("underwriting_profit") + F.when(F.month("effective_month") == 5, 1).otherwise(0)
    return checks.profit_identity(
        book, marts.profitability_monitor(book).withColumn("underwriting_profit", wrong))


def entry(spark: SparkSession) -> DataFrame:
    """Loss ratio by policy type."""
    return queries()["loss_ratio_by_type"](spark, "/root/testdata/sf0.001")


def _optional(module: str):
    """The module, or None where its files are not there."""
    try:
        present = find_spec(module) is not None
    except ModuleNotFoundError:
        present = False
    return importlib.import_module(module) if present else None


def corpus_queries() -> dict[str, Query]:
    """Queries of the corpus operators and their pipeline, as far as they are installed."""
    found: dict[str, Query] = {}
    if operators := _optional("riskloom.llm.queries"):
        found |= operators.QUERIES
    if operators and (pipeline := _optional("corpus_pipeline")):
        found["pipeline"] = pipeline.run
    return found


def corpus_sql() -> dict[str, str]:
    found: dict[str, str] = {}
    if operators := _optional("riskloom.llm.queries"):
        found |= operators.ORACLE_SQL
    if operators and (pipeline := _optional("corpus_pipeline")) and pipeline.ORACLE_SQL:
        found["pipeline"] = pipeline.ORACLE_SQL
    return found


def queries() -> dict[str, Query]:
    """Every implemented query by name."""
    return portfolio_queries() | corpus_queries()


def portfolio_queries() -> dict[str, Query]:
    return {
        # Sources and loads.
        "csv_ingest": _csv_ingest,
        "json_ingest": _json_ingest,
        "json_extract": _json_extract,
        "load_truncate_insert": _load_truncate_insert,
        "load_delivery": _load_delivery,
        "load_append_only": _load_append_only,
        "load_append_dedup": _load_append_dedup,
        "load_merge_upsert": _load_merge_upsert,
        "load_stream_upsert": _load_stream_upsert,
        "snapshot_diff": _snapshot_diff,
        "table_row_counts": _on(checks.table_row_counts),
        "sql_views": _sql_views,
        "sql_view_counts": _sql_view_counts,
        # Clean views.
        "stage_passthrough": _on(Portfolio.clean_customers),
        "stage_endorsements": _on(Portfolio.clean_endorsements),
        "stage_policies": _on(Portfolio.clean_policies),
        "stage_claims": _on(Portfolio.clean_claims),
        "stage_payments": _on(Portfolio.clean_payments),
        # Data quality.
        "dq_tag_policies": _on(findings.tagged_policies),
        "dq_tag_claims": _on(findings.tagged_claims),
        "dq_tag_payments": _on(findings.tagged_payments),
        "dq_tag_customers": _on(findings.tagged_customers),
        "dq_tag_endorsements": _on(findings.tagged_endorsements),
        "dq_rejects_claims": _on(Portfolio.rejected_claims),
        "dq_rejects_payments": _on(Portfolio.rejected_payments),
        "dq_duplicate_pk": _on(findings.policy_key_counts),
        "dq_duplicate_keys": _on(findings.repeated_claim_keys),
        "dq_orphan_fk": _on(findings.orphans),
        "dq_missing_values": _on(findings.missing),
        "dq_negative_amounts": _on(findings.negative_amounts),
        "dq_endorsement_sign": _on(findings.contradictory_endorsements),
        "dq_payment_after_expiration": _on(findings.payments_after_expiration),
        "dq_payment_after_cancellation": _on(findings.payments_after_cancellation),
        # Marts.
        "policy_totals": _on(marts.policy_totals),
        "refresh_policy_totals": _refreshed("policy_totals"),
        "refresh_customer_risk": _refreshed("customer_risk"),
        "refresh_monitor": _refreshed("monitor"),
        "refresh_trend": _refreshed("trend"),
        "refresh_held_book": _refreshed("held_book"),
        "policy_totals_staged": _on_staged(marts.policy_totals, buckets=8),
        "monthly_claims_staged": _on_staged(marts.monthly_claims, buckets=8),
        "payment_claims_trend_staged": _on_staged(marts.payment_claims_trend, buckets=4,
                                                  by_month=True),
        "distinct_policies": _on(marts.distinct_policies),
        "threshold_calibration": _on(marts.threshold_calibration),
        "prorated_premium": _on(marts.prorated_premium),
        "div0": _on(_div0),
        "loss_ratio_by_type": _on(marts.loss_ratio_by_type),
        "policy_segments": _on(marts.policy_segments),
        "calendar_spine": _on(marts.calendar_spine),
        "monthly_claims": _on(marts.monthly_claims),
        "monthly_payments": _on(marts.monthly_payments),
        "payment_claims_trend": _on(marts.payment_claims_trend),
        "customer_rollup": _on(marts.customer_rollup),
        "customer_risk": _on(marts.customer_risk),
        "tier_distribution": _on(marts.tier_distribution),
        "profitability_monthly": _on(marts.profitability_monthly),
        "profitability_monitor": _on(marts.profitability_monitor),
        "rolling_loss_ratio": _on(marts.rolling_loss_ratio),
        "profitability_dense": _on(marts.profitability_dense),
        "accident_year_loss_ratio": _on(marts.accident_year_loss_ratio),
        # Checks.
        "reconcile_totals": _on_written(checks.reconcile_totals),
        "reconcile_observed": _reconcile_observed,
        "reconcile_fingerprints": _reconcile_fingerprints(doctored=False),
        "reconcile_fingerprints_doctored": _reconcile_fingerprints(doctored=True),
        "reconcile_trend": _on_written(checks.reconcile_trend, LAST_FACT_MONTH),
        "check_negative_loss_ratio": _on(checks.negative_loss_ratio),
        "check_date_coverage": _on_written(checks.date_coverage),
        "check_grain": _on_written(checks.grain),
        "check_flag_domain": _on(checks.flag_domain),
        "check_status_thresholds": _on(checks.status_thresholds),
        "check_profit_identity": _on(checks.profit_identity),
        "check_flag_domain_doctored": _on(_flags_doctored),
        "check_status_thresholds_doctored": _on(_status_doctored),
        "check_profit_identity_doctored": _on(_profit_doctored),
    }


def oracle_sql() -> dict[str, str]:
    """The same results as DuckDB SQL over the raw tables."""
    return oracle_queries.statements() | corpus_sql()
