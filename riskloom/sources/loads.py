"""Batch load patterns: full reload and upsert. Appends are streaming loads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.operators.changes import upsert
from riskloom.sources.files import READERS
from riskloom.sources.tables import VersionedTable

# Key and compared columns of the upsert on policies.
POLICY_KEY = "policy_id"
POLICY_UPDATES = ("premium", "expiration_date", "policy_type")

# File names of a full delivery.
DELIVERY = {
    "customers": "customers.csv",
    "policies": "policies.csv",
    "claims": "claims.csv",
    "payments": "payments.csv",
    "endorsements": "endorsements.json",
}


def create_namespaces(spark: SparkSession) -> None:
    """Databases for the three layers."""
    for layer in ("raw", "stage", "mart"):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer}")


def truncate_insert(table: VersionedTable, rows: DataFrame) -> int:
    """Full reload: the new rows replace everything, without a gap for readers."""
    return table.replace(rows)


def load_delivery(spark: SparkSession, source_dir: str, target_dir: str) -> dict[str, VersionedTable]:
    """Reload all five tables from a delivery of CSV and JSON files."""
    loaded = {}
    for name, file in DELIVERY.items():
        read = READERS[file.rsplit(".", 1)[1]]
        loaded[name] = VersionedTable(spark, f"{target_dir.rstrip('/')}/{name}")
        truncate_insert(loaded[name], read(spark, f"{source_dir.rstrip('/')}/{file}", name))
    return loaded


def merge_upsert(table: VersionedTable, source: DataFrame, key: str = POLICY_KEY,
                 update: Sequence[str] = POLICY_UPDATES, loaded_at: Column | None = None,
                 null_safe: bool = False, stream: str | None = None,
                 batch_id: int | None = None) -> int:
    """Merge changed and new rows into the table as its next version.

    Where the table is bucketed by the key, only buckets that the source's keys fall into
    are read and written.
    """
    def merge(target: DataFrame) -> DataFrame:
        return upsert(target, source, key, update, loaded_at, null_safe)

    if table.key != key:
        return table.replace(merge(table.read()), stream, batch_id)
    # At most as many rows as the table has buckets.
    touched = source.select(table.bucket_of(F.col(key)).alias("bucket")).distinct().collect()
    return table.rewrite([r.bucket for r in touched], merge, stream, batch_id)


