"""Token ids in Arrow files of equal-length sequences.

A file holds record batches with two columns: ``ids``, a fixed-size list of ``length``
unsigned integers, and ``mask``, a fixed-size list that is false where the last sequence of
the file is filled up. Documents follow one another in ascending order of their key and run
over from one sequence to the next. Uncompressed fixed-size lists lie in the file as they
lie in memory, so a reader maps the file and addresses any sequence, or the ids of any
document, without copying or parsing.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.common import filesystem, ship_code, slices, text_of, written
from riskloom.llm.tokens import END_ID, encoder
from riskloom.session import scratch_dir

SEQUENCE = 2048
#: Sequences in a record batch.
BATCH = 256

_INDEX = "part int, file string, doc_id bigint, local_start bigint, n_tokens bigint"
_READ = pa.schema([("part", pa.int32()), ("local_start", pa.int64()), ("doc_id", pa.int64()),
                   ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])


class SequenceWriter:
    """Cuts a run of ids into sequences and writes them batch by batch."""

    def __init__(self, uri: str, dtype: np.dtype, length: int):
        self.store, self.path = filesystem(uri)
        self.store.create_dir(os.path.dirname(self.path), recursive=True)
        self.length, self.dtype = length, dtype
        self.schema = pa.schema([
            ("ids", pa.list_(pa.from_numpy_dtype(dtype), length)),
            ("mask", pa.list_(pa.bool_(), length)),
        ])
        self.stream = self.store.open_output_stream(self.path)
        self.out = pa.ipc.new_file(self.stream, self.schema)
        self.waiting: list[np.ndarray] = []
        self.held = 0
        self.total = 0

    def add(self, ids: np.ndarray) -> None:
        self.waiting.append(ids)
        self.held += len(ids)
        self.total += len(ids)
        if self.held >= self.length * BATCH:
            self._flush(self.held // (self.length * BATCH) * self.length * BATCH)

    def _flush(self, count: int) -> None:
        run = np.concatenate([*self.waiting, np.zeros(0, self.dtype)]).astype(self.dtype)
        for start in range(0, count, self.length * BATCH):
            self._write(run[start:min(start + self.length * BATCH, count)])
        self.waiting, self.held = [run[count:]], len(run) - count

    def _write(self, ids: np.ndarray) -> None:
        mask = np.ones(len(ids), bool)
        if short := -len(ids) % self.length:
            ids, mask = np.pad(ids, (0, short)), np.pad(mask, (0, short))
        lists = [pa.FixedSizeListArray.from_arrays(pa.array(x), self.length) for x in (ids, mask)]
        self.out.write_batch(pa.record_batch(lists, schema=self.schema))

    def close(self) -> None:
        self._flush(self.held)
        self.out.close()
        self.stream.close()


class SequenceReader:
    """Random access to the ids of a file by their place in it."""

    def __init__(self, uri: str):
        store, path = filesystem(uri)
        source = (pa.memory_map(path) if store.type_name == "local"
                  else store.open_input_file(path))
        self.file = pa.ipc.open_file(source)
        self.length = self.file.schema.field("ids").type.list_size
        self.batches: dict[int, np.ndarray] = {}

    def sequences(self, batch: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and masks of a batch, a row for each sequence."""
        found = self.file.get_batch(batch)
        return (found.column(0).flatten().to_numpy().reshape(-1, self.length),
                found.column(1).flatten().to_numpy(zero_copy_only=False)
                .reshape(-1, self.length))

    def _flat(self, batch: int) -> np.ndarray:
        if batch not in self.batches:
            self.batches = {batch: self.file.get_batch(batch).column(0).flatten().to_numpy()}
        return self.batches[batch]

    def ids(self, start: int, count: int) -> np.ndarray:
        size, found = self.length * BATCH, []
        while count:
            batch, at = divmod(start, size)
            found.append(self._flat(batch)[at:at + count])
            start, count = start + len(found[-1]), count - len(found[-1])
        return found[0] if len(found) == 1 else np.concatenate([*found, np.zeros(0, np.uint32)])


def crc32_of(ids: np.ndarray) -> int:
    """Unsigned CRC-32 of the ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(np.ascontiguousarray(ids, "<u4"))


def write_token_files(docs: DataFrame, folder: str, tokenizer: str | None = None,
                      length: int = SEQUENCE) -> DataFrame:
    """Write the ids of ``docs(doc_id, text)`` below ``folder``; return the index of documents.

    Each task sorts a range of ``doc_id`` and streams it into one file; equal ids are ordered
    by text, null ids come first, a null text is an empty one. Every document ends with id 0.
    A task that runs again writes a file of another name, and the index names only files of
    tasks that succeeded. The index has the file, the place in it and the number of ids.
    """
    spark = docs.sparkSession
    ship_code(spark)
    in_order = (docs.select("doc_id", text_of().alias("text"))
                .repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, out, encode = TaskContext.get(), None, encoder(tokenizer)
        part = task.partitionId()
        file = f"{folder}/part-{part:06d}-{task.taskAttemptId()}.arrow"
        for batch in slices(batches):
            out = out or SequenceWriter(file, encode.dtype, length)
            starts, counts = [], []
            for ids in encode.encode(batch.column(1)):
                starts.append(out.total)
                counts.append(len(ids))
                out.add(ids)
            rows = len(counts)
            yield pa.record_batch({
                "part": pa.array([part] * rows, pa.int32()),
                "file": pa.array([file] * rows, pa.string()),
                "doc_id": batch.column(0),
                "local_start": pa.array(starts, pa.int64()),
                "n_tokens": pa.array(counts, pa.int64()),
            })
        if out:
            out.close()

    return written(in_order.mapInArrow(write, _INDEX), "token-index")


def read_token_files(index: DataFrame) -> DataFrame:
    """Per indexed document its ids' place among all ids, their number and their CRC-32."""
    ship_code(index.sparkSession)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, reader = None, None
        for batch in batches:
            parts, files, docs, starts, counts = (batch.column(i) for i in range(5))
            sums = []
            for file, start, count in zip(files.to_pylist(), starts.to_pylist(),
                                          counts.to_pylist()):
                if file != name:
                    name, reader = file, SequenceReader(file)
                sums.append(crc32_of(reader.ids(start, count)))
            yield pa.record_batch([parts, starts, docs, counts, pa.array(sums, pa.int64())],
                                  schema=_READ)

    found = index.mapInArrow(
        read, "part int, local_start bigint, doc_id bigint, n_tokens bigint, ids_crc32 bigint")
    # One row for each file, so the running sum is over few rows.
    sizes = index.groupBy("part").agg(F.sum("n_tokens").alias("size"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("part", F.coalesce(F.sum("size").over(before), F.lit(0))
                           .alias("offset"))
    return found.join(offsets, "part").select(
        "doc_id", (F.col("offset") + F.col("local_start")).alias("start"),
        "n_tokens", "ids_crc32")


def token_digest(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Write the documents as token files, read the files back and describe what they hold.

    Each row of ``docs`` is a document of its own, repeated ones too; an empty table gives no
    file and no row. Further columns are ignored.
    """
    folder = scratch_dir(docs.sparkSession, "token-files")
    return read_token_files(write_token_files(docs, folder, tokenizer))
