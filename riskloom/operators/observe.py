"""Counts and sums taken while a table is written, and kept beside it.

A check of what was loaded then needs no second scan: the numbers come out of the tasks that
write the rows. They are those of the rows written; recomputed tasks do not count twice, as
observations are taken in the writing stage itself.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

FIGURE = T.DecimalType(36, 8)
_SCHEMA = T.StructType([T.StructField("table_name", T.StringType()),
                        T.StructField("measure", T.StringType()),
                        T.StructField("value", FIGURE)])


class LoadMetrics:
    """Figures of tables, by table and measure.

    :meth:`watch` gives the rows to write instead; :meth:`value` has a figure once they are
    written, and :meth:`keep` writes all figures as a small table.
    """

    def __init__(self, measures: Mapping[str, Mapping[str, Column]] | None = None):
        self.measures = dict(measures or {})
        self._observed: dict[str, Observation] = {}
        self._values: dict[str, dict[str, Decimal]] = {}

    def watch(self, name: str, rows: DataFrame) -> DataFrame:
        """``rows``, observed as table ``name`` when they are computed by a write."""
        figures = {"rows": F.count(F.lit(1)), **self.measures.get(name, {})}
        self._values.pop(name, None)
        self._observed[name] = Observation(f"{name}-{uuid.uuid4().hex}")
        return rows.observe(self._observed[name], *[
            F.coalesce(v.cast(FIGURE), F.lit(0).cast(FIGURE)).alias(m) for m, v in figures.items()])

    def value(self, name: str, measure: str = "rows") -> Decimal:
        """A figure of a written table. A sum over no values is 0."""
        if name not in self._values:
            self._values[name] = dict(self._observed[name].get)
        return self._values[name][measure]

    def table(self, spark: SparkSession) -> DataFrame:
        """All figures as rows ``table_name, measure, value``."""
        for name in self._observed:
            self.value(name)
        rows = [(n, m, v) for n, figures in self._values.items() for m, v in figures.items()]
        return spark.createDataFrame(rows, _SCHEMA)

    def keep(self, spark: SparkSession, path: str) -> None:
        """Write the figures beside the tables they belong to."""
        self.table(spark).coalesce(1).write.mode("overwrite").parquet(f"{path.rstrip('/')}/_metrics")

    @classmethod
    def kept(cls, spark: SparkSession, path: str) -> LoadMetrics:
        """The figures written by :meth:`keep`."""
        found = cls()
        for row in spark.read.schema(_SCHEMA).parquet(f"{path.rstrip('/')}/_metrics").collect():
            found._values.setdefault(row.table_name, {})[row.measure] = row.value
        return found
