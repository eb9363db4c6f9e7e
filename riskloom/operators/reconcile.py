"""Comparison of the same figure taken from two places."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

FIGURE = T.DecimalType(36, 8)


def figures(df: DataFrame, side: str, values: Mapping[str, Column]) -> DataFrame:
    """Global aggregates of one frame as rows ``(check_name, side, value)``, in one pass."""
    # Aggregates get positional names first: a check name may contain dots.
    names = list(values)
    row = df.agg(*[values[n].cast(FIGURE).alias(f"v{i}") for i, n in enumerate(names)])
    cells = F.array(*[
        F.struct(F.lit(n).alias("check_name"), F.lit(side).alias("side"), F.col(f"v{i}").alias("value"))
        for i, n in enumerate(names)
    ])
    return row.select(F.explode(cells).alias("c")).select("c.*")


def reconcile(parts: list[DataFrame], tolerance: float = 0.0) -> DataFrame:
    """Pair the ``left`` and ``right`` figures of each check.

    Gives ``check_name, left_value, right_value, difference, passed``. A missing
    sum counts as 0.
    """
    rows = reduce(DataFrame.unionByName, parts)
    value = F.col("value")

    def of(side: str) -> Column:
        picked = F.max(F.when(F.col("side") == side, value))
        return F.coalesce(picked, F.lit(0)).cast(FIGURE).alias(f"{side}_value")

    paired = rows.groupBy("check_name").agg(of("left"), of("right"))
    difference = F.col("left_value") - F.col("right_value")
    return paired.withColumn("difference", difference).withColumn(
        "passed", F.abs("difference") <= F.lit(tolerance)
    )
