"""Sums that are kept up to date by signed changes instead of being added up anew.

A state has one row per group: the number of rows behind it, and for every sum its value and
the number of values that were not NULL. All of them are additive, so an old image of a row is
taken out by adding it with a minus sign. A sum without values is NULL again, and a group
without rows disappears, as if the group had been aggregated from scratch.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.operators.spine import running_totals

SIGN = "_sign"
ROWS = "_rows"


def _values(name: str) -> str:
    return f"_values_{name}"


def signed(old: DataFrame, new: DataFrame) -> DataFrame:
    """Images before a change with sign -1 and images after it with sign 1."""
    return old.withColumn(SIGN, F.lit(-1)).unionByName(new.withColumn(SIGN, F.lit(1)))


def state_of(rows: DataFrame, keys: Sequence[str], sums: Mapping[str, tuple[Column, T.DataType | str]],
             counts: Mapping[str, Column] | None = None) -> DataFrame:
    """The state of ``rows``, or the change of a state that signed ``rows`` make.

    ``sums`` are values with the type of their sum, ``counts`` conditions whose rows count.
    """
    sign = F.col(SIGN) if SIGN in rows.columns else F.lit(1)
    cells = [F.sum(sign).cast("bigint").alias(ROWS)]
    for name, condition in (counts or {}).items():
        cells.append(F.sum(F.when(condition, sign).otherwise(0)).cast("bigint").alias(name))
    for name, (value, dtype) in sums.items():
        amount = F.coalesce(F.when(sign < 0, -value).otherwise(value), F.lit(0))
        cells.append(F.sum(amount).cast(dtype).alias(name))
        cells.append(F.sum(F.when(value.isNotNull(), sign).otherwise(0)).cast("bigint")
                     .alias(_values(name)))
    return rows.groupBy(*keys).agg(*cells)


def _as_key(keys: Sequence[str]) -> list[Column]:
    return [F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]


def _same_key(keys: Sequence[str]) -> Column:
    """Equality with keys renamed by :func:`_as_key`, NULL being equal to NULL."""
    return reduce(lambda a, b: a & b,
                  [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)])


def merge_state(state: DataFrame, change: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The state after a change. Both sides have one row per group, NULL keys being equal.

    The state is the left side of both joins, so that a small change, which is the point of
    it, is sent to the state's tasks and the state is not shuffled.
    """
    figures = [c for c in state.columns if c not in keys]
    renamed = change.select(*_as_key(keys),
                            *[F.col(c).alias(f"_d_{c}") for c in figures])
    met = _same_key(keys)
    changed = state.join(renamed, met, "left").select(*keys, *[
        (F.col(c) + F.coalesce(F.col(f"_d_{c}"), F.lit(0))).cast(state.schema[c].dataType).alias(c)
        for c in figures])
    known = state.select(*_as_key(keys))
    fresh = change.join(known, met, "left_anti").select(*state.columns)
    return changed.unionByName(fresh).filter(F.col(ROWS) > 0)


def settled(state: DataFrame) -> DataFrame:
    """Plain sums and counts: a sum without values is NULL."""
    hidden = {c for c in state.columns if c.startswith("_values_")}
    return state.select(*[
        F.when(F.col(_values(c)) > 0, F.col(c)).alias(c) if _values(c) in hidden else F.col(c)
        for c in state.columns if c not in hidden and c != ROWS])


def resume_totals(previous: DataFrame, fresh: DataFrame, firsts: DataFrame, keys: Sequence[str],
                  order: str, totals: Mapping[str, str]) -> DataFrame:
    """A series with running ``totals`` of which only the changed ends are worked out anew.

    ``firsts`` has the keys of the changed series and ``_first``, the first changed row's
    place; ``fresh`` has their rows from there on, without totals. Earlier rows, and series
    that did not change, are carried as they are, and totals go on from the last carried row.
    """
    changed = firsts.select(*_as_key(keys), "_first")
    carried = previous.join(changed, _same_key(keys), "left").filter(
        F.col("_first").isNull() | (F.col(order) < F.col("_first")))
    opening = carried.filter(F.col("_first").isNotNull()).groupBy(*keys).agg(*[
        F.max_by(name, order).alias(f"_o_{name}") for name in totals]).select(
        *_as_key(keys), *[f"_o_{name}" for name in totals])
    opened = fresh.join(opening, _same_key(keys), "left").select(
        *fresh.columns, *[f"_o_{name}" for name in totals])
    rolled = running_totals(opened, keys, order, totals).withColumns({
        # A running sum is NULL until the first value.
        name: F.when(F.col(f"_o_{name}").isNull(), F.col(name)).when(
            F.col(name).isNull(), F.col(f"_o_{name}")).otherwise(
            F.col(f"_o_{name}") + F.col(name)) for name in totals})
    return carried.select(*previous.columns).unionByName(rolled.select(*[
        F.col(c).cast(previous.schema[c].dataType).alias(c) for c in previous.columns]))
