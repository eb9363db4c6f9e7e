"""Rule-based tagging of invalid rows."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class Rule(NamedTuple):
    reason: str
    violated: Column


def tag(df: DataFrame, rules: Sequence[Rule], column: str = "dq_reason") -> DataFrame:
    """Add the reason of the first violated rule; NULL marks a valid row."""
    reason = F.lit(None).cast("string")
    for rule in reversed(rules):
        reason = F.when(rule.violated, F.lit(rule.reason)).otherwise(reason)
    return df.withColumn(column, reason)


def valid(tagged: DataFrame, column: str = "dq_reason") -> DataFrame:
    return tagged.filter(F.col(column).isNull()).drop(column)


def missing_values(df: DataFrame, table: str) -> DataFrame:
    """NULLs per column, as one row per column, from a single pass."""
    columns = df.columns
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    pairs = F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).alias("missing_count")) for c in columns
    ])
    return counted.select(F.explode(pairs).alias("p")).select(
        F.lit(table).alias("table_name"), "p.column_name", "p.missing_count"
    )
