"""Connected components of links that are spread over the cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import written


def components(links: DataFrame) -> DataFrame:
    """``id`` and ``label``, the smallest id it is connected with, for each id in ``links(a, b)``.

    A distributed union-find: in each round an id takes the smallest label among its
    neighbours and then the label of that label, so that long chains shrink by halves. Rounds
    end when no label has become smaller.
    """
    both = written(links.select("a", "b").union(links.select("b", "a")).distinct(), "links")
    labels = written(both.groupBy(F.col("a").alias("id"))
                     .agg(F.least(F.col("id"), F.min("b")).alias("label")), "labels")
    total = F.sum(F.col("label").cast("decimal(38,0)"))
    before = labels.agg(total).first()[0]
    while before is not None:
        near = (both.join(labels.withColumnRenamed("id", "a"), "a")
                .select(F.col("b").alias("id"), "label"))
        far = labels.alias("x").join(labels.alias("y"), F.col("x.label") == F.col("y.id")).select(
            F.col("x.id"), F.col("y.label"))
        labels = written(near.union(far).groupBy("id").agg(F.min("label").alias("label")),
                         "labels")
        after = labels.agg(total).first()[0]
        if after == before:
            break
        before = after
    return labels
