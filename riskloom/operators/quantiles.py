"""Quantiles per group from mergeable sketches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Size parameter of the sketches. A group of up to so many values is kept whole, so its
#: quantiles are exact; beyond, a quantile's rank is off by less than RANK_ERROR of the group
#: with 99 % probability, whatever the number of values.
SIZE = 4096
RANK_ERROR = 0.002


def quantile_state(rows: DataFrame, keys: Sequence[str], value: Column, name: str = "sketch",
                   size: int = SIZE) -> DataFrame:
    """A sketch of the values of each group; NULLs are left out."""
    return rows.groupBy(*keys).agg(
        F.kll_sketch_agg_double(value.cast("double"), F.lit(size)).alias(name))


def merge_quantiles(state: DataFrame, keys: Sequence[str], name: str = "sketch",
                    size: int = SIZE) -> DataFrame:
    """The sketches of coarser groups."""
    return state.groupBy(*keys).agg(F.kll_merge_agg_double(name, F.lit(size)).alias(name))


def quantiles(state: DataFrame, keys: Sequence[str], probabilities: Sequence[float],
              name: str = "sketch") -> DataFrame:
    """``probability, value_count, value``: the smallest value whose share of values up to and
    with it reaches the probability. Groups without values have no rows."""
    count = F.kll_sketch_get_n_double(name)
    points = F.array(*[F.lit(float(p)) for p in probabilities])
    pairs = F.arrays_zip(points.alias("probability"),
                         F.kll_sketch_get_quantile_double(name, points).alias("value"))
    pointed = state.filter(count > 0).select(
        *keys, count.alias("value_count"), F.explode(pairs).alias("_point"))
    return pointed.select(*keys, "_point.probability", "value_count", "_point.value")
