"""Key uniqueness without windows: a hot key is counted, never gathered."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.operators.skew import key_counts, lookup_join


def keep_unique(df: DataFrame, key: str, weight: Column | None = None,
                drop_null_keys: bool = False) -> DataFrame:
    """Rows whose key occurs exactly once; every copy of a repeated key is removed.

    One aggregation does it: in a group of one row, the maximum of each column is
    that row. ``weight`` counts a row more than once, as a join with repeated
    partners would have.
    """
    if drop_null_keys:
        df = df.filter(F.col(key).isNotNull())
    copies = F.count(F.lit(1)) if weight is None else F.sum(weight)
    rest = [c for c in df.columns if c != key]
    grouped = df.groupBy(key).agg(copies.alias("_copies"), *[F.max(c).alias(c) for c in rest])
    return grouped.filter(F.col("_copies") == 1).select(*df.columns)


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("row_count"))
    return counts.filter(F.col("row_count") > 1)


def with_key_count(df: DataFrame, key: str, name: str = "key_count",
                   hot_rows: int | None = None) -> DataFrame:
    """Every row with the number of rows sharing its key (NULLs form one group)."""
    counts = key_counts(df, [key])
    if hot_rows is None:
        several = counts.filter(F.col("_rows") > 1).withColumnRenamed(key, "_key")
        joined = df.join(several, F.col(key).eqNullSafe(F.col("_key")), "left")
        return joined.select(*df.columns, F.coalesce("_rows", F.lit(1)).alias(name))
    repeated = counts.filter((F.col("_rows") > 1) & F.col(key).isNotNull())
    joined = lookup_join(df, repeated.withColumnRenamed("_rows", name), key,
                         "left", hot_rows, counts)
    # The group of NULL keys cannot be joined to; its size is one scalar.
    nulls = counts.filter(F.col(key).isNull()).select(F.max("_rows")).scalar()
    return joined.withColumn(
        name, F.when(F.col(key).isNull(), nulls).otherwise(F.coalesce(F.col(name), F.lit(1)))
    ).select(*df.columns, name)
