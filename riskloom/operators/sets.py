"""Set operations over whole rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def set_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct rows of ``left`` that do not occur in ``right``; NULL equals NULL.

    Both sides go through one aggregation over all columns: copies collapse
    before the shuffle and there is no join for a repeated row to overload.
    """
    columns = left.columns
    tagged = left.select(*columns, F.lit(0).alias("_known")).unionByName(
        right.select(*columns, F.lit(1).alias("_known"))
    )
    seen = tagged.groupBy(*columns).agg(F.max("_known").alias("_known"))
    return seen.filter(F.col("_known") == 0).select(*columns)
