"""The five-table model filled from an order-style star schema in parquet.

Orders act as policies, line items as claims and payments, events as
endorsements. Some rows are made invalid on purpose, by fixed rules on their
keys, so that every data-quality rule has something to find.
"""

from __future__ import annotations

import datetime as dt
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.plans.portfolio import Portfolio
from riskloom.schemas import LOADED_AT

AS_OF = dt.date(2001, 1, 1)
SPINE_START = dt.date(1995, 1, 1)
LOAD_TIME = "2001-01-01 00:00:00"


_LAYOUT = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_mktsegment string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_linenumber int, l_extendedprice double, "
                "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, event_type string, value double, props string",
}
_LOADED = f"timestamp_ntz'{LOAD_TIME}' AS {LOADED_AT}"


def star_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The used columns of one table; a given schema saves reading footers to plan."""
    return spark.read.schema(_LAYOUT[name]).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = star_table(spark, sf_dir, "nation")
    region = star_table(spark, sf_dir, "region")
    people = star_table(spark, sf_dir, "customer")
    placed = people.join(nation, people.c_nationkey == nation.n_nationkey).join(
        region, nation.n_regionkey == region.r_regionkey)
    return placed.selectExpr(
        "c_custkey AS customer_id",
        "c_name AS customer_name",
        "r_name AS state",
        "c_mktsegment AS industry",
        _LOADED,
    )


def policies(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = star_table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS policy_id",
        "if(o_orderkey % 97 = 5, o_custkey + 100000000, o_custkey) AS customer_id",
        "o_orderpriority AS policy_type",
        "date(o_orderdate) AS effective_date",
        "if(o_orderkey % 89 = 21, date_sub(date(o_orderdate), 1), "
        "add_months(date(o_orderdate), 12)) AS expiration_date",
        "CAST(CASE WHEN o_orderkey % 83 = 6 THEN NULL WHEN o_orderkey % 79 = 7 THEN -o_totalprice "
        "WHEN o_orderkey % 73 = 8 THEN 0 ELSE o_totalprice END AS decimal(18,2)) AS premium",
        _LOADED,
    )
    # Repeat some keys within the one scan.
    return rows.selectExpr(
        "*", "explode(sequence(1, if(policy_id % 101 = 3, 2, 1))) AS _copy").drop("_copy")


def claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star_table(spark, sf_dir, "lineitem").filter("l_linestatus = 'O'").selectExpr(
        "l_orderkey * 10 + l_linenumber AS claim_id",
        "l_orderkey AS policy_id",
        "date(l_shipdate) AS claim_date",
        "CAST(l_extendedprice AS decimal(18,2)) AS claim_amount",
        "CASE WHEN (l_orderkey * 10 + l_linenumber) % 67 = 9 THEN 'Disputed' "
        "WHEN l_returnflag = 'A' THEN 'Closed' WHEN l_returnflag = 'R' THEN 'Open' "
        "WHEN l_returnflag = 'N' THEN 'Pending' END AS claim_status",
        _LOADED,
    )


def payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star_table(spark, sf_dir, "lineitem").filter("l_linestatus = 'F'").selectExpr(
        "l_orderkey * 10 + l_linenumber AS payment_id",
        "l_orderkey AS policy_id",
        "date(l_shipdate) AS payment_date",
        "CAST(if((l_orderkey + l_linenumber) % 61 = 0, -l_extendedprice, l_extendedprice) "
        "AS decimal(18,2)) AS payment_amount",
        _LOADED,
    )


def endorsements(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = star_table(spark, sf_dir, "orders")
    order_count = orders.agg(F.count(F.lit(1))).scalar()
    events = star_table(spark, sf_dir, "events")
    return events.withColumn("policy_id", F.col("event_id") * 7 % order_count).selectExpr(
        "CAST(if(event_id % 3 = 0, -value, value) AS decimal(18,2)) AS endorsement_amount",
        f"date_add(date'{SPINE_START}', int(event_id * 13 % 2190)) AS endorsement_date",
        "event_id AS endorsement_id",
        "CASE WHEN event_type IN ('purchase', 'signup') THEN 'Coverage Increase' "
        "WHEN event_type = 'error' THEN 'Cancellation' ELSE 'Coverage Reduction' END "
        "AS endorsement_type",
        "policy_id",
        _LOADED,
    )


def portfolio(spark: SparkSession, sf_dir: str, as_of: dt.date = AS_OF,
              **parameters) -> Portfolio:
    """The sample portfolio under ``sf_dir``, reported on a fixed date."""
    builders = {
        "customers": customers,
        "policies": policies,
        "claims": claims,
        "payments": payments,
        "endorsements": endorsements,
    }
    tables = {name: partial(build, spark, sf_dir) for name, build in builders.items()}
    return Portfolio(tables, as_of, SPINE_START, **parameters)
