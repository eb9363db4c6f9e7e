"""Exact distinct counts that can be merged to any coarser grain.

The distinct ids of a group are kept as bitmaps, words of 64 bits for each range of 64 ids that
the group has ids of. Merging is a bitwise OR, so finer groups add up to coarser ones without
the ids, which a sum of distinct counts cannot do. A state never has more rows than there are
ids in its groups, however thinly these are spread, and 64 times fewer where they lie dense.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RANGE = "_range"


def distinct_state(rows: DataFrame, keys: Sequence[str], identity: str,
                   measures: Mapping[str, Column]) -> DataFrame:
    """Bitmaps of the ids of each group, one for each measure: the ids of rows that meet its
    condition. NULL ids are left out; a measure without ids in a range is NULL there.

    Rows are dealt out by range, so that neither the state nor what is merged from it is
    shuffled again. Where an id repeats often, collapse the rows first.
    """
    number = F.col(identity).cast("bigint")
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"),
                          F.pmod(number, F.lit(64)).cast("int"))
    placed = rows.select(*keys, F.shiftright(number, 6).alias(RANGE), *[
        F.when(condition, bit).alias(name) for name, condition in measures.items()])
    return placed.filter(F.col(RANGE).isNotNull()).repartition(RANGE).groupBy(*keys, RANGE).agg(
        *[F.bit_or(m).alias(m) for m in measures])


def merge_distinct(state: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """The state of coarser groups."""
    return state.groupBy(*keys, RANGE).agg(*[F.bit_or(m).alias(m) for m in measures])


def distinct_counts(state: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Distinct ids per group and measure. Ranges do not overlap, so their counts add up."""
    return state.groupBy(*keys).agg(*[
        F.coalesce(F.sum(F.bit_count(m)), F.lit(0)).cast("bigint").alias(m) for m in measures])
