"""WARC archives of web pages: written as one gzip member per record and read back in sequence.

Equal payloads are stored once. The reader needs no index and never holds more than a record:
it inflates member after member piece by piece, frames each record by its Content-Length and
compares digests.
"""

from __future__ import annotations

import base64
import hashlib
import os
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import filesystem, ship_code, slices, text_of, written
from riskloom.session import scratch_dir

#: Payloads below this many bytes are never stored as revisits.
LEAST_SHARED = 100
CHUNK = 1 << 16
_DATE = "2000-01-01T00:00:00Z"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


class WarcError(ValueError):
    """An archive that does not follow the format, or whose digests disagree."""


@dataclass
class Record:
    headers: dict[str, str] = field(default_factory=dict)
    content: bytes = b""

    @property
    def kind(self) -> str:
        return self.headers["WARC-Type"]


def _digest(content: bytes) -> str:
    return "sha256:" + hashlib.sha256(content).hexdigest()


def record_bytes(headers: dict[str, str], content: bytes) -> bytes:
    """A gzip member that holds one record."""
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in headers.items()),
             f"WARC-Block-Digest: {_digest(content)}", f"Content-Length: {len(content)}"]
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    head = "\r\n".join(lines).encode() + b"\r\n\r\n"
    return packer.compress(head + content + b"\r\n\r\n") + packer.flush()


def _members(stream) -> Iterator[bytes]:
    """The inflated gzip members of a stream, read in chunks."""
    waiting = stream.read(CHUNK)
    while waiting:
        member, found = zlib.decompressobj(31), []
        while not member.eof:
            if not waiting and not (waiting := stream.read(CHUNK)):
                raise WarcError("the archive ends inside a record")
            found.append(member.decompress(waiting))
            waiting = member.unused_data if member.eof else b""
        yield b"".join(found)
        waiting = waiting or stream.read(CHUNK)


def read_records(stream) -> Iterator[Record]:
    """The records of an archive in order, each checked against its digests."""
    for data in _members(stream):
        head, gap, rest = data.partition(b"\r\n\r\n")
        version, *lines = head.decode().split("\r\n")
        if not gap or not version.startswith("WARC/"):
            raise WarcError("a record does not begin with its headers")
        headers = dict(line.split(": ", 1) for line in lines)
        length = int(headers["Content-Length"])
        content = rest[:length]
        if len(content) != length or rest[length:] != b"\r\n\r\n":
            raise WarcError("a record is not as long as it says")
        if headers["WARC-Block-Digest"] != _digest(content):
            raise WarcError("a record's content does not match its digest")
        if (headers["WARC-Type"] == "response"
                and headers["WARC-Payload-Digest"] != _digest(content)):
            raise WarcError("a payload does not match its digest")
        yield Record(headers, content)


def _address_headers(url: str | None) -> dict[str, str]:
    """The page's address, percent-encoded where a URI cannot hold a character as it is.

    What that changes, and an empty or null address (``about:blank``), also stands in a header
    of its own as it was; null ones come back empty.
    """
    url = url or ""
    address = quote(url, safe="%:/?#[]@!$&'()*+,;=") or "about:blank"
    headers = {"WARC-Target-URI": address}
    if address != url:
        headers["Page-Url"] = base64.b64encode(url.encode()).decode()
    return headers


def _address(headers: dict[str, str]) -> str:
    if "Page-Url" in headers:
        return base64.b64decode(headers["Page-Url"]).decode()
    return headers["WARC-Target-URI"]


def _record_id(page: int | None, row: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page}:{row}')}>"


def _told_apart(pages: DataFrame) -> DataFrame:
    """The pages with ``row``, which no two of them share.

    It is the page id, where ids are unique and none is null. Otherwise the rows are written
    with numbers, so that the numbers stay the same however often they are read.
    """
    rows = pages.select(F.col("page_id").cast("bigint").alias("row"), "page_id", "url", "html")
    repeated = pages.groupBy("page_id").count().filter("count > 1 OR page_id IS NULL")
    if repeated.isEmpty():
        return rows
    return written(rows.withColumn("row", F.monotonically_increasing_id()), "pages")


def plan_records(pages: DataFrame) -> DataFrame:
    """``pages(page_id, url, html)`` with digest, record type and what a revisit refers to.

    Of equal payloads of at least ``LEAST_SHARED`` bytes the one with the smallest page id is
    the response; rows that repeat this id are responses too, and where no row has an id, all
    are. Null payloads are empty. The number of copies has no bound: the smallest id is a
    partial aggregate, and the join with it may be split where one payload is frequent.
    ``row`` tells rows apart that share an id, and ``original`` is the row that a revisit means.
    """
    payload = F.encode(text_of("html"), "UTF-8")
    rows = _told_apart(pages).select("row", "page_id", "url",
                                     payload.alias("payload")).withColumns({
        "digest": F.sha2("payload", 256), "size": F.length("payload").cast("long")})
    shared = F.col("size") >= LEAST_SHARED
    # Another column than the grouped one: the join then has shuffles of its own, which
    # adaptive execution can split.
    firsts = (rows.filter(shared).groupBy("digest")
              .agg(F.min("page_id").alias("first"), F.min_by("row", "page_id").alias("first_row"),
                   F.count(F.lit(1)).alias("copies"))
              .filter(F.col("copies") > 1)
              .select(F.unhex("digest").alias("shared_key"), "first", "first_row"))
    # Only a shared payload has a key, so the others need not meet anything.
    key = F.when(shared, F.unhex("digest"))
    joined = rows.withColumn("key", key).join(firsts, F.col("key") == F.col("shared_key"), "left")
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return joined.select(
        "page_id", "url", "digest", "size",
        F.when(revisit, F.lit("revisit")).otherwise("response").alias("record_type"),
        F.when(revisit, F.col("first")).alias("refers_to"),
        F.when(~revisit, F.col("payload")).alias("payload"),
        "row", F.when(revisit, F.col("first_row")).alias("original"))


def write_archives(records: DataFrame, folder: str) -> DataFrame:
    """Write planned records, one archive per task; return the archives' paths and counts.

    A task that runs again writes another file; only files of tasks that succeeded are named.
    """
    ship_code(records.sparkSession)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, out, count = TaskContext.get(), None, 0
        uri = f"{folder}/part-{task.partitionId():06d}-{task.taskAttemptId()}.warc.gz"
        for batch in slices(batches, 6):
            if out is None:
                store, path = filesystem(uri)
                store.create_dir(os.path.dirname(path), recursive=True)
                # The members are packed already; the store must not pack the file again.
                out = store.open_output_stream(path, compression=None)
            for row in batch.to_pylist():
                headers = {
                    "WARC-Type": row["record_type"],
                    "WARC-Record-ID": _record_id(row["page_id"], row["row"]),
                    "WARC-Date": _DATE,
                    **_address_headers(row["url"]),
                    "WARC-Payload-Digest": f"sha256:{row['digest']}",
                    "Page-Id": "" if row["page_id"] is None else str(row["page_id"]),
                    "Payload-Length": str(row["size"]),
                }
                if row["record_type"] == "revisit":
                    headers |= {"WARC-Profile": _PROFILE,
                                "WARC-Refers-To": _record_id(row["refers_to"], row["original"]),
                                "Refers-To-Page": str(row["refers_to"])}
                out.write(record_bytes(headers, row["payload"] or b""))
                count += 1
        if out is not None:
            out.close()
            yield pa.record_batch({"archive": pa.array([uri]), "records": pa.array([count])})

    return written(records.mapInArrow(write, "archive string, records bigint"), "warc-list")


def read_archives(archives: DataFrame, with_content: bool = True) -> DataFrame:
    """Every record of the listed archives, each archive read by one task as a stream."""
    ship_code(archives.sparkSession)
    kinds = ("page_id bigint, url string, record_type string, refers_to bigint, "
             "payload_digest string, payload_bytes bigint, html string")

    def rows_of(records: list[Record]) -> pa.RecordBatch:
        number = lambda text: int(text) if text else None
        of = [r.headers for r in records]
        url = [_address(h) for h in of]
        html = [r.content.decode() if with_content and r.kind == "response" else None
                for r in records]
        return pa.record_batch({
            "page_id": pa.array([number(h["Page-Id"]) for h in of], pa.int64()),
            "url": pa.array(url, pa.string()),
            "record_type": pa.array([h["WARC-Type"] for h in of], pa.string()),
            "refers_to": pa.array([number(h.get("Refers-To-Page")) for h in of], pa.int64()),
            "payload_digest": pa.array(
                [h["WARC-Payload-Digest"].removeprefix("sha256:") for h in of], pa.string()),
            "payload_bytes": pa.array([int(h["Payload-Length"]) for h in of], pa.int64()),
            "html": pa.array(html, pa.string())})

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                store, path = filesystem(uri)
                held, size = [], 0
                with store.open_input_stream(path, compression=None) as stream:
                    for record in read_records(stream):
                        held.append(record)
                        size += len(record.content)
                        if size >= 4 << 20 or len(held) >= 5000:
                            yield rows_of(held)
                            held, size = [], 0
                if held:
                    yield rows_of(held)

    # A stated number of tasks is kept, where a few bytes of names would end up in one task.
    tasks = max(1, archives.count())
    return archives.select("archive").repartition(tasks, "archive").mapInArrow(read, kinds)


def archive_round_trip(pages: DataFrame) -> DataFrame:
    """Write ``pages`` as archives, read these back and describe each record."""
    folder = scratch_dir(pages.sparkSession, "warc")
    archives = write_archives(plan_records(pages), folder)
    return read_archives(archives, with_content=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
