"""A parquet table whose changes rewrite only the buckets they fall into.

Rows lie in buckets of a hashed key. Every write goes to a new folder; a commit file then
names, for each bucket, the folder that holds it now. Readers always see the last commit.
Commit files are created exclusively, so of two writers that start from one version the
second fails and changes nothing.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKETS = 64
_BUCKET = "_bucket"


class ConcurrentWrite(RuntimeError):
    """Another writer committed the same version first."""


class VersionedTable:
    """Any number of readers; writers that collide fail and may retry.

    ``key`` deals rows to buckets; without one, as for tables that are only replaced as a
    whole, there is one bucket. ``buckets`` counts for a new table; commits carry the number. Exclusive creation needs a store that has it, such as a
    distributed or local file system.
    """

    def __init__(self, spark: SparkSession, path: str, key: str | None = None,
                 buckets: int = BUCKETS):
        self.spark = spark
        self.path = path.rstrip("/")
        self.key = key
        self.buckets = buckets if key else 1

    # -- commits ---------------------------------------------------------------

    def _place(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")

    def _store(self):
        conf = self.spark._jsparkSession.sessionState().newHadoopConf()
        return self._place("").getFileSystem(conf)

    def _versions(self) -> list[int]:
        store, folder = self._store(), self._place("commits")
        if not store.exists(folder):
            return []
        return sorted(int(s.getPath().getName().split(".")[0])
                      for s in store.listStatus(folder) if s.getPath().getName().endswith(".json"))

    def _commit(self, version: int) -> dict:
        lines = self.spark.read.text(f"{self.path}/commits/{version:012d}.json").collect()
        return json.loads(lines[0][0])

    def _current(self) -> dict | None:
        versions = self._versions()
        return self._commit(versions[-1]) if versions else None

    def version(self) -> int | None:
        """Number of the current version, or None before the first write."""
        return max(self._versions(), default=None)

    def exists(self) -> bool:
        return self.version() is not None

    def has_batch(self, stream: str, batch_id: int) -> bool:
        """True when a stream's batch was committed before (it is being replayed)."""
        current = self._current()
        return bool(current) and current["streams"].get(stream, -1) >= batch_id

    # -- reading ---------------------------------------------------------------

    def bucket_of(self, column: Column) -> Column:
        """Bucket of a key, by the number of buckets the table was first written with."""
        return self._bucket(column, self._current())

    def _bucket(self, column: Column, current: dict | None) -> Column:
        buckets = current.get("buckets", BUCKETS) if current and self.key else self.buckets
        return F.pmod(F.xxhash64(column), F.lit(buckets)).cast("int")

    def read(self, buckets: Sequence[int] | None = None) -> DataFrame:
        """The current rows, of all buckets or of some."""
        current = self._current()
        if current is None:
            raise ValueError(f"nothing has been written to {self.path}")
        wanted = {int(b): f for b, f in current["folders"].items()
                  if buckets is None or int(b) in buckets}
        paths = [f"{self.path}/{folder}/{_BUCKET}={b}" for b, folder in sorted(wanted.items())]
        schema = self.spark.createDataFrame([], current["schema"]).schema
        return (self.spark.read.schema(schema).parquet(*paths) if paths
                else self.spark.createDataFrame([], schema))

    # -- writing ---------------------------------------------------------------

    def replace(self, df: DataFrame, stream: str | None = None,
                batch_id: int | None = None) -> int:
        """Write ``df`` as all of the next version. ``df`` may read the current one.

        A failed write leaves the current version in place.
        """
        current = self._current()
        return self._write(df, current, {}, stream, batch_id)

    def rewrite(self, buckets: Sequence[int], change: Callable[[DataFrame], DataFrame],
                stream: str | None = None, batch_id: int | None = None) -> int:
        """Replace some buckets by what ``change`` makes of their rows; keep the others' files.

        ``change`` must leave rows in the buckets that were asked for.
        """
        current = self._current()
        if current is None:
            raise ValueError(f"nothing has been written to {self.path}")
        kept = {b: f for b, f in current["folders"].items() if int(b) not in set(buckets)}
        return self._write(change(self.read(buckets)), current, kept, stream, batch_id)

    def _write(self, df: DataFrame, current: dict | None, kept: dict[str, str],
               stream: str | None, batch_id: int | None) -> int:
        following = 0 if current is None else current["version"] + 1
        folder = f"data/{following:012d}-{uuid.uuid4().hex}"
        bucket = self._bucket(F.col(self.key), current) if self.key else F.lit(0)
        rows = df.withColumn(_BUCKET, bucket)
        if self.key:
            # Adaptive execution gathers small buckets and splits large ones over several
            # tasks, so a bucket is as many files as its size asks for.
            rows = rows.hint("rebalance", F.col(_BUCKET))
        rows.write.partitionBy(_BUCKET).parquet(f"{self.path}/{folder}")
        store, place = self._store(), self._place(folder)
        written = [s.getPath().getName().split("=")[1] for s in store.listStatus(place)
                   if s.getPath().getName().startswith(f"{_BUCKET}=")]
        streams = dict(current["streams"]) if current else {}
        if stream is not None:
            streams[stream] = batch_id
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
        buckets = current.get("buckets", BUCKETS) if current else self.buckets
        self._create(following, {"version": following, "streams": streams, "schema": schema,
                                 "buckets": buckets,
                                 "folders": kept | {b: folder for b in written}})
        return following

    def _create(self, version: int, commit: dict) -> None:
        place = self._place(f"commits/{version:012d}.json")
        try:
            stream = self._store().create(place, False)
        except Py4JJavaError as error:
            if "AlreadyExists" in error.java_exception.getClass().getName():
                raise ConcurrentWrite(f"version {version} of {self.path} exists") from error
            raise
        stream.write(bytearray(json.dumps(commit).encode()))
        stream.close()

    def vacuum(self, keep: int = 1) -> int:
        """Delete the folders that none of the last ``keep`` commits needs, and older commits.

        Folders that no commit names stay: a writer may be filling them. Readers of older
        versions must have ended.
        """
        versions = self._versions()
        old, new = versions[:-keep], versions[-keep:]
        needed = {f for v in new for f in self._commit(v)["folders"].items()}
        store, gone = self._store(), set()
        for version in old:
            gone |= set(self._commit(version)["folders"].items()) - needed
        for bucket, folder in gone:
            store.delete(self._place(f"{folder}/{_BUCKET}={bucket}"), True)
        for version in old:
            store.delete(self._place(f"commits/{version:012d}.json"), False)
        return len(gone)
