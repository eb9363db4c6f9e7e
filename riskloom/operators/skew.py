"""Joins that stay balanced when one key holds a large share of the rows.

Fact and dimension keys are joined here against a side with at most one row per
key. By default that is a plain join: adaptive execution splits a partition that
turns out large. Where it cannot (another step needs the partitioning, or it is
switched off), ``hot_rows`` spreads the rows of each key that has more over several
tasks and repeats the matching row of the other side once per task. Nothing is
dropped and no pairs are formed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_SPREAD = "_spread"
_SALT = "_salt"
_PLACE = "_place"
#: Tasks over which the rows of one key are dealt while they learn how far it is spread.
TAGGING_TASKS = 64


def key_counts(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows per key, counted map-side first, so a hot key travels as one row per task."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))


def hot_keys(counts: DataFrame, keys: list[str], hot_rows: int) -> DataFrame:
    """Keys holding more than ``hot_rows`` rows, with the number of tasks to use.

    A table of N rows has fewer than N / hot_rows such keys, which bounds the
    size of this frame whatever the distribution is.
    """
    spread = F.ceil(F.col("_rows") / F.lit(hot_rows)).cast("bigint").alias(_SPREAD)
    return counts.filter(F.col("_rows") > hot_rows).select(*keys, spread)


def _place(df: DataFrame, keys: list[str]) -> Column:
    """A number by which equal keys are told apart: of the map task and the other columns.

    Taken before any shuffle by key. Recomputing a lost task gives the same numbers.
    """
    plain = [f.name for f in df.schema.fields if f.name not in keys
             and not isinstance(f.dataType, (T.MapType, T.VariantType))]
    return F.xxhash64(F.spark_partition_id(), *plain)


def spread_rows(left: DataFrame, hot: DataFrame, keys: list[str],
                null_keys: bool = False) -> DataFrame:
    """``left`` with the salt of each row: 0 unless its key is among :func:`hot_keys`.

    The hot keys are repeated for every tagging task, so that no task sees all rows of a
    key here either. ``null_keys`` spreads rows without a key as well.
    """
    step = F.pmod(F.col(_PLACE), F.lit(TAGGING_TASKS)).cast("int").alias("_step")
    placed = left.withColumn(_PLACE, _place(left, keys)).select("*", step)
    tags = hot.withColumn("_step", F.explode(F.sequence(F.lit(0), F.lit(TAGGING_TASKS - 1))))
    # The step used up the lowest digits; the salt takes the next ones.
    turn = F.shiftright(_PLACE, 6)
    salt = F.when(F.col(_SPREAD).isNotNull(), F.pmod(turn, F.col(_SPREAD)))
    if null_keys:
        for key in keys:
            salt = salt.when(F.col(key).isNull(), turn)
    return (placed.join(tags, [*keys, "_step"], "left")
            .withColumn(_SALT, salt.otherwise(F.lit(0)).cast("bigint"))
            .select(*left.columns, _SALT))


def lookup_join(left: DataFrame, right: DataFrame, on: str | list[str], how: str = "left",
                hot_rows: int | None = None, counts: DataFrame | None = None) -> DataFrame:
    """Equi-join ``left`` to ``right``, which must have at most one row per key.

    ``how`` is inner, left, left_semi or left_anti. With ``hot_rows``, keys that have
    more rows are counted first and spread. ``counts`` may hand in rows
    per key (from :func:`key_counts`) of ``left`` or of any table that ``left``
    was filtered from: it only decides how far a key is spread. The salt comes from the
    row's place before the join, see :func:`spread_rows`.
    """
    keys = [on] if isinstance(on, str) else list(on)
    added = [] if how in ("left_semi", "left_anti") else [c for c in right.columns if c not in keys]
    if hot_rows is None:
        return left.join(right, keys, how).select(*left.columns, *added)
    if counts is None:
        counts = key_counts(left, keys)
    hot = hot_keys(counts, keys, hot_rows)
    # Rows without a key match nothing but are kept by these: spread them as well.
    salted = spread_rows(left, hot, keys, null_keys=how in ("left", "left_anti"))
    repeats = F.sequence(F.lit(0).cast("bigint"), F.coalesce(F.col(_SPREAD), F.lit(1)) - 1)
    repeated = (
        right.join(hot, keys, "left")
        .withColumn(_SALT, F.explode(repeats)).drop(_SPREAD)
    )
    joined = salted.join(repeated, [*keys, _SALT], how)
    return joined.select(*left.columns, *added)
