"""Month calendars, dense series and running totals."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F


def calendar(start: Column, until: Column) -> Column:
    """Array of month starts from the month of ``start``, none after ``until``."""
    first = F.trunc(start, "month")
    series = F.sequence(first, until, F.expr("interval 1 month"))
    return F.when(first <= until, series).otherwise(F.array().cast("array<date>"))


def spine(segments: DataFrame, start: Column, until: Column,
          month: str = "month_start") -> DataFrame:
    """One row per segment and calendar month, without joining the two."""
    return segments.withColumn(month, F.explode(calendar(start, until)))


def densify(facts: DataFrame, keys: Sequence[str], month: str, sums: Sequence[str],
            months: Column) -> DataFrame:
    """Give every series of ``facts`` a row for each of ``months``, 0 where it has none.

    ``facts`` has one row per series and month; a NULL month names a series that
    has no facts. ``months`` is an array of dates, which may depend on the first
    and last month of the series, ``_first`` and ``_last``. Facts of other months
    drop out. A series is as long as its calendar, so its months travel in one
    row: there is no join to a calendar, and the result stays partitioned by
    series for the running totals that follow.
    """
    types = {s: facts.schema[s].dataType for s in sums}
    cell = F.struct(month, *sums, F.lit(0).alias("_framed"))
    series = facts.groupBy(*keys).agg(
        F.collect_list(F.when(F.col(month).isNotNull(), cell)).alias("_cells"),
        F.min(month).alias("_first"),
        F.max(month).alias("_last"),
    )
    frame = F.transform(months, lambda m: F.struct(
        m.alias(month), *[F.lit(None).cast(types[s]).alias(s) for s in sums],
        F.lit(1).alias("_framed")))
    rows = series.select(*keys, F.inline(F.concat("_cells", frame)))
    filled = rows.groupBy(*keys, month).agg(F.max("_framed").alias("_framed"), *[
        F.coalesce(F.sum(s), F.lit(0)).cast(types[s]).alias(s) for s in sums])
    return filled.filter(F.col("_framed") == 1).drop("_framed")


def running(keys: Sequence[str], order: str) -> WindowSpec:
    """Window from the first row of a series to the current one."""
    return (
        Window.partitionBy(*keys)
        .orderBy(F.col(order).asc_nulls_last())
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )


def running_totals(df: DataFrame, keys: Sequence[str], order: str,
                   totals: Mapping[str, str]) -> DataFrame:
    """Add running sums ``{new column: summed column}`` over one shared window.

    Meant for series that are aggregated already: a partition has one row per
    ``order`` value.
    """
    window = running(keys, order)
    return df.withColumns({name: F.sum(col).over(window) for name, col in totals.items()})
