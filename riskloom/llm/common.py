"""Helpers that the corpus operators share."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.session import scratch_dir

PACKAGE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SLICE_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return rows.select(*columns) if columns else rows


def ship_code(spark: SparkSession) -> None:
    """Give the executors' Python this package, once a session."""
    context = spark.sparkContext
    if getattr(context, "_riskloom_shipped", False):
        return
    folder = tempfile.mkdtemp(prefix="riskloom-code-")
    archive = os.path.join(folder, "riskloom-code.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for top, _, names in os.walk(PACKAGE):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(top, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(PACKAGE)))
    context.addPyFile(archive)
    context._riskloom_shipped = True


def written(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` as a table in the shared folder: computed once, whatever executors are lost."""
    path = scratch_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_of(column: str = "text"):
    """The text, a null one being empty."""
    return F.coalesce(F.col(column), F.lit(""))


def slices(batches: Iterator[pa.RecordBatch], column: int = 1) -> Iterator[pa.RecordBatch]:
    """The batches cut so that each piece holds about ``SLICE_BYTES`` of text, or one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        per_row = max(1, batch.column(column).nbytes // batch.num_rows)
        rows = max(1, SLICE_BYTES // per_row)
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def filesystem(uri: str) -> tuple[fs.FileSystem, str]:
    """The store behind a folder that driver and executors share, and the path in it."""
    if "://" in uri or uri.startswith("file:"):
        return fs.FileSystem.from_uri(uri)
    return fs.LocalFileSystem(), uri


def numbered(docs: DataFrame) -> DataFrame:
    """``row, doc_id, text``: the row number orders the documents by id, and is unique.

    Where ids are unique and none is null, they are the numbers. Otherwise rows are sorted and
    written with numbers of their own: equal ids by their texts, null ids last.
    """
    repeated = docs.groupBy("doc_id").count().filter("count > 1 OR doc_id IS NULL")
    rows = docs.select("doc_id", text_of().alias("text"))
    if repeated.isEmpty():
        return rows.select(F.col("doc_id").alias("row"), "doc_id", "text")
    order = [F.asc_nulls_last("doc_id"), F.asc("text")]
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return written(placed.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text"),
                   "numbered")
