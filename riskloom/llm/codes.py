"""Product codes of vectors, learned by exact ball k-means on integers.

Vectors are cut into parts, and each part position has a codebook of its own. The parts that
have one entry form its ball. An entry further from the ball's centre than twice the radius
can be nearest to none of them, so only neighbour entries count; a part nearer to its entry
than half the way to the nearest neighbour lies in the stable core and keeps its code; for
the others, rings around the centre tell how many of the neighbours, by distance, have to be
compared. All distances are squared integers, so every bound and every tie is exact.

A round is one pass over the vectors: tasks write them with their codes, and beside them one
row for each entry they used, with the sum and number of its parts. The sums of all tasks meet
in an aggregation as large as the codebooks, which is what the driver reads and sends out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.llm.common import ship_code, slices, written

SCALE = 256
PARTS = 16
ENTRIES = 64
ROUNDS = 2
#: Largest scaled component: squared distances and their sums stay far below 2**63.
LARGEST = 1 << 24


def integer_rows(embeddings: DataFrame, scale: int = SCALE) -> DataFrame:
    """``vec_id, label, vector``: components times ``scale``, rounded down.

    Rows whose vector is null or holds a null or non-finite component are left out. A scaled
    component beyond ``LARGEST`` fails the query, as errors would not fit their column.
    """
    x = F.col("embedding")
    sound = x.isNotNull() & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v)
                                     & (F.abs(v) != F.lit(float("inf"))))

    def scaled(v):
        value = F.lit(scale) * v.cast("double")
        return F.when(F.abs(value) <= LARGEST, F.floor(value).cast("bigint")).otherwise(
            F.raise_error(F.lit(f"a component times {scale} is beyond {LARGEST}"))
            .cast("bigint"))

    return embeddings.filter(F.coalesce(sound, F.lit(False))).select(
        "vec_id", "label", F.transform(x, scaled).alias("vector"))


def part_bounds(width: int, parts: int = PARTS) -> list[tuple[int, int]]:
    """Where the parts begin and end: equal, or the first ones one longer."""
    size, longer = divmod(width, parts)
    ends = np.cumsum([0] + [size + (i < longer) for i in range(parts)]).tolist()
    return list(zip(ends, ends[1:]))


class Balls:
    """The entries of one codebook, each with the others in order of distance."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        apart = ((entries[:, None, :] - entries[None, :, :]) ** 2).sum(axis=2)
        self.near = np.argsort(apart, axis=1, kind="stable")
        self.apart = np.take_along_axis(apart, self.near, axis=1)
        #: Distances computed beyond those to the parts' own entries, for tests and tuning.
        self.compared = 0

    def guess(self, points: np.ndarray) -> np.ndarray:
        """An entry near each point by the coordinate in which entries differ most."""
        if not self.entries.shape[1]:
            return np.zeros(len(points), np.int64)
        axis = int(np.argmax(np.ptp(self.entries, axis=0)))
        order = np.argsort(self.entries[:, axis], kind="stable")
        along = self.entries[order, axis]
        return order[np.searchsorted((along[1:] + along[:-1]) / 2, points[:, axis])]

    def _squared(self, points: np.ndarray, codes: np.ndarray) -> np.ndarray:
        gap = points - self.entries[codes]
        return (gap * gap).sum(axis=-1)

    def nearest(self, points: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest entry of each point, of equals the first, and the squared distance.

        ``codes`` are the balls that the points lie in now; any will do, good ones save work.
        """
        codes, best = codes.copy(), self._squared(points, codes)
        order = np.argsort(codes, kind="stable")
        ends = np.searchsorted(codes[order], np.arange(len(self.entries) + 1))
        rings = np.ones(len(points), np.int64)
        for entry, (start, end) in enumerate(zip(ends, ends[1:])):
            if start == end:
                continue
            members = order[start:end]
            radius = best[members].max()
            # Up to and with twice the radius, as an entry there may be as near.
            neighbours = np.searchsorted(self.apart[entry], 4 * radius, side="right")
            if neighbours > 1:
                rings[members] = np.searchsorted(self.apart[entry, :neighbours],
                                                 4 * best[members], side="right")
        width = 1
        while width < len(self.entries):
            # Rings of up to twice as many neighbours are compared together.
            inner, width = width, min(2 * width, len(self.entries))
            some = np.flatnonzero((rings > inner) & (rings <= width))
            if not len(some):
                continue
            rivals = self.near[codes[some], :width]
            found = self._squared(points[some, None, :], rivals)
            self.compared += found.size
            least = found.min(axis=1)
            first = np.where(found == least[:, None], rivals, len(self.entries)).min(axis=1)
            codes[some], best[some] = first, least
        return codes, best


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return pc.list_flatten(column).to_numpy(zero_copy_only=False).reshape(len(column), width)


def _code_vectors(matrix: np.ndarray, codes: list[bytes | None],
                  books: list[Balls], bounds: list[tuple[int, int]]
                  ) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all parts and squared distances summed over the parts."""
    known = (np.frombuffer(b"".join(codes), np.uint8).reshape(len(matrix), -1)
             if codes and codes[0] is not None else None)
    out = np.zeros((len(matrix), len(books)), np.uint8)
    errors = np.zeros(len(matrix), np.int64)
    for p, (book, (start, end)) in enumerate(zip(books, bounds)):
        points = np.ascontiguousarray(matrix[:, start:end])
        held = book.guess(points) if known is None else known[:, p].astype(np.int64)
        out[:, p], best = book.nearest(points, held)
        errors += best
    return out, errors


def _round(vectors: DataFrame, entries: np.ndarray, parts: int) -> DataFrame:
    """The vectors with new codes, and rows ``cell, count, sums`` of the entries' parts."""
    bounds = part_bounds(entries.shape[1], parts)
    fields = vectors.schema.fields + [
        T.StructField("cell", T.IntegerType()), T.StructField("count", T.LongType()),
        T.StructField("sums", T.ArrayType(T.LongType()))]
    width, size = entries.shape[1], len(entries)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = [Balls(entries[:, a:b]) for a, b in bounds]
        counts = np.zeros((parts, size), np.int64)
        sums = [np.zeros((size, b - a), np.int64) for a, b in bounds]
        schema = None
        for batch in slices(batches, 2):
            matrix = _matrix(batch.column(2), width)
            codes, _ = _code_vectors(matrix, batch.column(3).to_pylist(), books, bounds)
            for p, (a, b) in enumerate(bounds):
                counts[p] += np.bincount(codes[:, p], minlength=size)
                np.add.at(sums[p], codes[:, p], matrix[:, a:b])
            rows = len(matrix)
            out = pa.record_batch({
                "vec_id": batch.column(0), "label": batch.column(1), "vector": batch.column(2),
                "code": pa.array([c.tobytes() for c in codes], pa.binary()),
                "cell": pa.nulls(rows, pa.int32()), "count": pa.nulls(rows, pa.int64()),
                "sums": pa.nulls(rows, pa.list_(pa.int64()))})
            schema = out.schema
            yield out
        if schema is not None:
            used = [(p, e) for p in range(parts) for e in range(size) if counts[p, e]]
            yield pa.record_batch([
                *[pa.nulls(len(used), f.type) for f in list(schema)[:4]],
                pa.array([p * size + e for p, e in used], pa.int32()),
                pa.array([counts[p, e] for p, e in used], pa.int64()),
                pa.array([sums[p][e].tolist() for p, e in used], pa.list_(pa.int64()))],
                schema=schema)

    return written(vectors.mapInArrow(work, T.StructType(fields)), "codes")


def _moved(coded: DataFrame, entries: np.ndarray, parts: int) -> np.ndarray:
    """Entries at the rounded-down means of their parts; unused ones stay.

    The driver reads one row for each number of the codebooks.
    """
    bounds, size = part_bounds(entries.shape[1], parts), len(entries)
    totals = (coded.filter("cell IS NOT NULL")
              .select("cell", "count", F.posexplode("sums").alias("place", "value"))
              .groupBy("cell", "place")
              .agg(F.sum("value").alias("total"), F.sum("count").alias("count")).collect())
    moved = entries.copy()
    for row in totals:
        part, entry = divmod(row["cell"], size)
        moved[entry, bounds[part][0] + row["place"]] = row["total"] // row["count"]
    return moved


def codebook_digest(entries: np.ndarray, parts: int = PARTS) -> str:
    """SHA-256 of all components by part, entry and place, in decimal and joined by commas."""
    cells = [str(x) for a, b in part_bounds(entries.shape[1], parts)
             for x in entries[:, a:b].ravel().tolist()]
    return hashlib.sha256(",".join(cells).encode()).hexdigest()


def learn_codes(embeddings: DataFrame, parts: int = PARTS, size: int = ENTRIES,
                rounds: int = ROUNDS, scale: int = SCALE) -> tuple[DataFrame, np.ndarray]:
    """``vec_id, label, code, error`` of every sound vector, and the codebooks side by side.

    Codebooks begin with the vectors of the ``size`` smallest ids (equal ids by their vectors,
    null ids last) that are as long as the first of them. Vectors of another length have no
    code and no error. Without vectors there are no rows, and codebooks without entries.
    """
    if size > 256:
        raise ValueError("a code of a part is one byte")
    spark = embeddings.sparkSession
    ship_code(spark)
    vectors = written(integer_rows(embeddings, scale), "vectors")
    order = [F.asc_nulls_last("vec_id"), F.asc("vector")]
    first = vectors.orderBy(*order).select(F.size("vector").alias("n")).limit(1).collect()
    width = first[0]["n"] if first else 0
    alike = vectors.filter(F.size("vector") == width)
    chosen = alike.orderBy(*order).limit(size).select("vector").collect()
    entries = np.array([r["vector"] for r in chosen], np.int64).reshape(len(chosen), width)
    coded = alike.withColumn("code", F.lit(None).cast("binary"))
    for _ in range(rounds if chosen else 0):
        table = _round(coded, entries, parts)
        entries = _moved(table, entries, parts)
        coded = table.filter("cell IS NULL").drop("cell", "count", "sums")
    bounds = part_bounds(width, parts)

    def last(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = [Balls(entries[:, a:b]) for a, b in bounds]
        for batch in slices(batches, 2):
            codes, errors = _code_vectors(_matrix(batch.column(2), width),
                                          batch.column(3).to_pylist(), books, bounds)
            yield pa.record_batch({
                "vec_id": batch.column(0), "label": batch.column(1),
                "code": pa.array([c.tobytes().hex() for c in codes], pa.string()),
                "error": pa.array(errors)})

    kinds = T.StructType(vectors.schema.fields[:2] + [
        T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])
    others = vectors.filter(F.size("vector") != width).select(
        "vec_id", "label", F.lit(None).cast("string").alias("code"),
        F.lit(None).cast("bigint").alias("error"))
    return coded.mapInArrow(last, kinds).unionByName(others), entries


def vector_codes(embeddings: DataFrame) -> DataFrame:
    """Codes and errors of ``embeddings(vec_id, embedding, label)`` with the label's error.

    See :func:`learn_codes` for nulls, ties and other lengths. Repeated ids are separate rows.
    Errors are added up over equal labels, null labels being equal; a label that many rows
    share is summed in the map tasks first.
    """
    found, entries = learn_codes(embeddings.select("vec_id", "embedding", "label"))
    rows = written(found, "coded")
    totals = rows.groupBy(F.col("label").alias("same")).agg(F.sum("error").alias("label_error"))
    return rows.join(totals, F.col("label").eqNullSafe(F.col("same")), "left").select(
        "vec_id", "code", "error", "label_error",
        F.lit(codebook_digest(entries)).alias("codebooks_sha256"))
