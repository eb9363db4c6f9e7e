"""From a delivery of files to written marts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.operators.observe import LoadMetrics
from riskloom.plans import checks, marts
from riskloom.plans.portfolio import SPINE_START, Portfolio
from riskloom.sources.loads import load_delivery
from riskloom.sources.tables import VersionedTable


def staged_with_totals(spark: SparkSession, book: Portfolio, path: str) -> Portfolio:
    """Write the clean views and the policy totals, and read them from then on.

    Customer risk, profitability and the loss ratios all start from the policy
    totals, so a build of several marts computes them once. Earned premium is as
    of the date of writing.
    """
    staged = book.staged(spark, path)
    target = f"{path.rstrip('/')}/policy_totals"
    marts.policy_totals(staged).write.mode("overwrite").parquet(target)
    return staged.with_written({**staged.written, "policy_totals": spark.read.parquet(target)})


def observed_build(spark: SparkSession, book: Portfolio,
                   path: str) -> tuple[Portfolio, LoadMetrics]:
    """Write clean views, policy totals, customer sums and months, observing each as it is
    written, and keep the figures beside them."""
    path = path.rstrip("/")
    metrics = LoadMetrics(checks.load_measures(book))
    staged = book.staged(spark, path, watch=metrics.watch)
    for name, plan in (("policy_totals", marts.policy_totals),
                       ("customer_rollup", marts.customer_rollup),
                       ("profitability", marts.profitability_monthly)):
        metrics.watch(name, plan(staged)).write.mode("overwrite").parquet(f"{path}/{name}")
        staged = staged.with_written({**staged.written,
                                      name: spark.read.parquet(f"{path}/{name}")})
    metrics.keep(spark, path)
    return staged, metrics


def write_marts(spark: SparkSession, book: Portfolio, path: str) -> dict[str, DataFrame]:
    """Write every mart as the next version of its table under ``path``."""
    staged = staged_with_totals(spark, book, f"{path.rstrip('/')}/stage")
    plans = {
        "policy_totals": marts.policy_totals,
        "payment_claims_trend": marts.payment_claims_trend,
        "customer_risk": marts.customer_risk,
        "profitability_monitor": marts.profitability_monitor,
    }
    written = {}
    for name, plan in plans.items():
        table = VersionedTable(spark, f"{path.rstrip('/')}/{name}")
        table.replace(plan(staged))
        written[name] = table.read()
    return written


def run(spark: SparkSession, delivery_dir: str, out_dir: str, as_of: dt.date | None = None,
        spine_start: dt.date = SPINE_START) -> dict[str, DataFrame]:
    """Load a delivery, clean it and write the marts, all as of one date.

    Without ``as_of`` that is the date at which the run starts.
    """
    out = out_dir.rstrip("/")
    as_of = as_of or spark.range(1).select(F.current_date()).first()[0]
    loaded: dict[str, VersionedTable] = load_delivery(spark, delivery_dir, f"{out}/raw")
    tables = {name: table.read for name, table in loaded.items()}
    return write_marts(spark, Portfolio(tables, as_of, spine_start), f"{out}/mart")
