"""Append-only and upsert loads from a landing directory.

The checkpoint remembers which files were taken, so every run handles only what
arrived since the last one, and a run without new files does nothing.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from riskloom.operators.changes import INSERT, latest
from riskloom.schemas import LOADED_AT, TABLES
from riskloom.sources.files import CSV_OPTIONS
from riskloom.sources.loads import POLICY_KEY, POLICY_UPDATES, merge_upsert
from riskloom.sources.tables import VersionedTable

# Fixed value: refresh interval of a long-running load.
REFRESH = "60 minutes"


def refresh_trigger(continuous: bool = False) -> dict:
    """Take what is there and stop, or keep running and look every hour."""
    return {"processingTime": REFRESH} if continuous else {"availableNow": True}


def landing_stream(spark: SparkSession, source_dir: str, table: str, file_format: str = "parquet",
                   files_per_batch: int | None = None, change_feed: bool = False,
                   array_files: bool = False) -> DataFrame:
    """Rows of the files arriving in ``source_dir``.

    A ``change_feed`` also carries ``_action`` and ``_is_update``; only its INSERT
    images are passed on. ``array_files`` tells that each JSON file holds one array.
    """
    schema = TABLES[table]
    if change_feed:
        schema = T.StructType(schema.fields + [
            T.StructField("_action", T.StringType()),
            T.StructField("_is_update", T.BooleanType()),
        ])
    reader = spark.readStream.schema(schema).format(file_format)
    if file_format == "csv":
        reader = reader.options(**CSV_OPTIONS)
    if file_format == "json":
        reader = reader.option("mode", "FAILFAST").option("multiLine", array_files)
        reader = reader.option("dateFormat", "yyyy-MM-dd")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    rows = reader.load(source_dir)
    if change_feed:
        rows = rows.filter(F.col("_action") == INSERT).drop("_action", "_is_update")
    return rows


def append_only(rows: DataFrame, target_dir: str, checkpoint_dir: str,
                continuous: bool = False) -> StreamingQuery:
    """Append a stream to a parquet table, each row exactly once."""
    stamped = rows.withColumn(LOADED_AT, F.localtimestamp())
    return (
        stamped.writeStream.format("parquet").outputMode("append")
        .option("path", target_dir).option("checkpointLocation", checkpoint_dir)
        .trigger(**refresh_trigger(continuous)).start()
    )


# Class of the state store that keeps its state on disk.
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def append_dedup(rows: DataFrame, target_dir: str, checkpoint_dir: str,
                 key: str | Sequence[str],
                 within: str = "30 days", arrived: Column | None = None,
                 continuous: bool = False) -> StreamingQuery:
    """Append a stream to a parquet table, leaving out rows whose key arrived before.

    A key is remembered for ``within`` from its first arrival, across batches and restarts,
    in a RocksDB state store beside the checkpoint: state grows with the keys of that time,
    not with the table, and lies on the executors' disks. A key that comes again later is
    appended again; :func:`riskloom.operators.keys.duplicate_keys` over the table finds such
    keys without a limit in time. Of rows of one key in one batch any one stays. Rows
    without a key (any of its columns is NULL) are all appended. ``arrived`` is the time that
    counts; by default it is when the batch is read, so no file is ever too late to be taken.
    """
    keys = [key] if isinstance(key, str) else list(key)
    has_key = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    spark = rows.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    time = F.current_timestamp() if arrived is None else arrived
    keyed = (rows.filter(has_key).withColumn("_arrived", time)
             .withWatermark("_arrived", within).dropDuplicatesWithinWatermark(keys)
             .drop("_arrived"))
    return append_only(keyed.unionByName(rows.filter(~has_key)), target_dir, checkpoint_dir,
                       continuous)


def stream_upsert(rows: DataFrame, table: VersionedTable, checkpoint_dir: str,
                  key: str = POLICY_KEY, update: Sequence[str] = POLICY_UPDATES,
                  order_by: Sequence[str] | None = None, loaded_at: Column | None = None,
                  null_safe: bool = False, continuous: bool = False,
                  unique_keys: bool = False) -> StreamingQuery:
    """Merge each micro-batch into the table.

    A batch replayed after a failure is recognised by the checkpoint it belongs to
    and its id, and skipped.
    ``order_by`` keeps the last version of a key delivered several times in one
    batch. ``unique_keys`` vouches instead that no batch repeats a key; a batch that
    does fails then, and would fail again on every retry.
    """
    if not order_by and not unique_keys:
        raise ValueError("a change feed needs order_by, or unique_keys where keys never repeat")

    def merge(batch: DataFrame, batch_id: int) -> None:
        if table.has_batch(checkpoint_dir, batch_id):
            return
        source = latest(batch, key, order_by) if order_by else batch
        merge_upsert(table, source, key, update, loaded_at, null_safe,
                     checkpoint_dir, batch_id)

    return (
        rows.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint_dir)
        .trigger(**refresh_trigger(continuous)).start()
    )
