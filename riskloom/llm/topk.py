"""Exact inner-product search with ball trees.

Vectors are dealt to coarse cells, each to the nearest of some centres, and a cell to shards of
bounded size. In each shard a ball tree is built: a node keeps the centre and radius of the
vectors below it, so no inner product below it exceeds ``query . centre + |query| * radius``.
The same holds of a cell, the root of its shards. A block of queries walks the tree, the child
with the higher bound first, and skips nodes whose bound is below the query's k-th best score so
far. Queries are dealt to blocks of bounded size as well, those that start in one cell together,
and each task holds one shard and one block. A query visits cells by falling bounds, in waves of
growing size: it takes its k-th best score along and is sent only to cells that may beat it.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.common import SLICE_BYTES, ship_code, slices, written

SCALE = 256
SHARD_ROWS = 8192
LEAF_ROWS = 64
#: Bytes of queries that meet a shard in one task, and queries that walk a tree together.
QUERY_BYTES = 16 << 20
BLOCK_ROWS = 512
#: The centres of cells come from a sample of so many vectors and bytes; every row is dealt to
#: a cell. Cells hold ``SAMPLE_A_CELL`` vectors of the sample or more.
SAMPLE_ROWS = 16384
SAMPLE_BYTES = 32 << 20
SAMPLE_A_CELL = 8
#: After its first cell a query may visit 7 more, then 56 more, and so on.
GROWTH = 8


@dataclass
class Node:
    centre: np.ndarray
    radius: float
    ids: np.ndarray | None = None
    vectors: np.ndarray | None = None
    children: tuple["Node", ...] = ()


def build(ids: np.ndarray, vectors: np.ndarray, leaf_rows: int = LEAF_ROWS) -> Node:
    """Split along the widest coordinate at its middle until a node is a leaf."""
    centre = vectors.mean(axis=0)
    radius = float(np.sqrt(((vectors - centre) ** 2).sum(axis=1).max()))
    if len(ids) <= leaf_rows or radius == 0:
        order = np.argsort(ids, kind="stable")
        return Node(centre, radius, ids[order], vectors[order])
    widest = int(np.argmax(vectors.max(axis=0) - vectors.min(axis=0)))
    order = np.argsort(vectors[:, widest], kind="stable")
    halves = order[:len(order) // 2], order[len(order) // 2:]
    return Node(centre, radius, children=tuple(build(ids[h], vectors[h], leaf_rows)
                                               for h in halves))


def upper_bounds(products, norms, radius):
    """No inner product in a ball is higher; a little generous for the rounding of centres."""
    bound = products + norms * radius
    return bound + 1e-9 * (np.abs(bound) + norms * (radius + 1)) + 1e-6


class Cells:
    """Centres, each with the vectors that are nearer to it than to others.

    A further, last cell holds the vectors of another length than the centres'; only queries of
    other lengths visit it. Shards ``first[c]`` to ``first[c + 1] - 1`` are those of cell ``c``.
    """

    def __init__(self, centres: np.ndarray):
        self.centres = centres
        self.half_squares = (centres ** 2).sum(axis=1) / 2
        self.radii = np.zeros(len(centres))
        self.first = np.zeros(len(centres) + 2, np.int64)

    @classmethod
    def fitted(cls, sample: np.ndarray, count: int) -> "Cells":
        """Split the group with the greatest sum of squared distances from its mean, at the mean
        of the coordinate that varies most, until there are ``count`` or all are points."""
        spread = lambda rows: ((rows - rows.mean(axis=0)) ** 2).sum()
        groups, number = [(-spread(sample), 0, sample)], 1
        while len(groups) < count and groups[0][0] < -1e-6:
            rows = heapq.heappop(groups)[2]
            values = rows[:, int(np.argmax(rows.var(axis=0)))]
            low = values <= values.mean()
            for half in (rows[low], rows[~low]):
                heapq.heappush(groups, (-spread(half), number, half))
                number += 1
        return cls(np.array([g[2].mean(axis=0) for g in sorted(groups, key=lambda g: g[1])]))

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The cell of each vector and the distance from its centre."""
        cell = np.argmax(vectors @ self.centres.T - self.half_squares, axis=1)
        return cell, np.sqrt(((vectors - self.centres[cell]) ** 2).sum(axis=1))

    def measure(self, found: dict[int, tuple[int, float]], shard_rows: int) -> None:
        """Take in rows and radius by cell. A shard has ``shard_rows`` to twice as many rows."""
        shards = np.zeros(len(self.centres) + 1, np.int64)
        for cell, (rows, away) in found.items():
            shards[cell] = -(-rows // (2 * shard_rows))
            if cell < len(self.centres):
                self.radii[cell] = away
        self.first = np.concatenate([[0], np.cumsum(shards)])

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        norms = np.sqrt((queries ** 2).sum(axis=1))[:, None]
        bounds = upper_bounds(queries @ self.centres.T, norms, self.radii)
        bounds[:, self.first[1:-1] == self.first[:-2]] = -np.inf
        return bounds

    def due(self, queries: np.ndarray, floors: np.ndarray, start: int,
            until: int) -> tuple[np.ndarray, np.ndarray]:
        """Places of queries, and cells, of which the bound is the ``start``-th highest or
        later, before the ``until``-th, and reaches the query's floor."""
        bounds = self.bounds(queries)
        order = np.argsort(-bounds, axis=1, kind="stable")[:, start:until]
        rows, ranks = np.nonzero(np.take_along_axis(bounds, order, 1) >= floors[:, None])
        return rows, order[rows, ranks]


class Search:
    """The k best so far of each query of a block; ties go to the smaller id."""

    def __init__(self, ids: np.ndarray, queries: np.ndarray, floors: np.ndarray, k: int):
        self.ids, self.queries, self.k = ids, queries, k
        self.norms = np.sqrt((queries ** 2).sum(axis=1))
        self.scores = np.full((len(ids), k), -np.inf)
        self.found = np.full((len(ids), k), np.iinfo(np.int64).max)
        #: Scores that k vectors met elsewhere reach: nothing below can be among the best.
        self.floors = floors

    def bounds(self, node: Node, rows: np.ndarray) -> np.ndarray:
        return upper_bounds(self.queries[rows] @ node.centre, self.norms[rows], node.radius)

    def walk(self, node: Node, rows: np.ndarray) -> None:
        known = np.maximum(self.scores[rows, -1], self.floors[rows])
        rows = rows[self.bounds(node, rows) >= known]
        if not len(rows):
            return
        if node.ids is not None:
            self._leaf(node, rows)
            return
        one, two = node.children
        first = self.bounds(one, rows) >= self.bounds(two, rows)
        self.walk(one, rows[first])
        self.walk(two, rows)
        self.walk(one, rows[~first])

    def _leaf(self, node: Node, rows: np.ndarray) -> None:
        # Integers below 2**53, so the products are exact.
        scores = self.queries[rows] @ node.vectors.T
        scores[node.ids[None, :] == self.ids[rows][:, None]] = -np.inf
        both = np.hstack([self.scores[rows], scores])
        ids = np.hstack([self.found[rows], np.broadcast_to(node.ids, scores.shape)])
        best = np.lexsort((ids, -both), axis=1)[:, :self.k]
        self.scores[rows] = np.take_along_axis(both, best, axis=1)
        self.found[rows] = np.take_along_axis(ids, best, axis=1)


def integer_vectors(embeddings: DataFrame, scale: int = SCALE) -> DataFrame:
    """``vec_id`` and ``vector``: each component times ``scale``, rounded down. Rows without an
    id, and vectors that are null, empty or hold a null or non-finite component, are left out.
    """
    x = F.col("embedding")
    sound = (F.col("vec_id").isNotNull() & x.isNotNull() & (F.size(x) > 0)
             & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v)
                        & (F.abs(v) != F.lit(float("inf")))))
    return embeddings.filter(F.coalesce(sound, F.lit(False))).select(
        "vec_id", F.transform(x, lambda v: F.floor(F.lit(scale) * v.cast("double"))
                              .cast("double")).alias("vector"))


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    """Of vectors of one length."""
    return pc.list_flatten(column).to_numpy().reshape(len(column), -1)


def _lengths(column: pa.ChunkedArray) -> np.ndarray:
    return pc.list_value_length(column).to_numpy()


def _search_shards(shards: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """Walk each shard's tree with each block of queries that is sent to it."""

    def walk(left: pa.Table, right: pa.Table) -> pa.Table:
        names = ["query_id", "vec_id", "score"]
        kind = pa.schema([(n, pa.int64()) for n in names])
        if not left.num_rows or not right.num_rows:
            return kind.empty_table()
        # Vectors of another length than the query's have no inner product with it.
        out = []
        lengths = _lengths(left.column("vector"))
        asked_lengths = _lengths(right.column("asked"))
        for size in np.intersect1d(lengths, asked_lengths):
            some = left.filter(pa.array(lengths == size))
            tree = build(some.column("vec_id").to_numpy(), _matrix(some.column("vector")))
            wanted = right.filter(pa.array(asked_lengths == size))
            for start in range(0, wanted.num_rows, BLOCK_ROWS):
                block = wanted.slice(start, BLOCK_ROWS)
                search = Search(block.column("query_id").to_numpy(),
                                _matrix(block.column("asked")),
                                block.column("floor").to_numpy(), k)
                search.walk(tree, np.arange(block.num_rows))
                rows, places = np.nonzero(np.isfinite(search.scores))
                out.append(pa.table([search.ids[rows], search.found[rows, places],
                                     search.scores[rows, places].astype(np.int64)],
                                    schema=kind))
        return pa.concat_tables(out) if out else kind.empty_table()

    return (shards.groupBy("shard", "block").cogroup(asked.groupBy("visits", "asked_block"))
            .applyInArrow(walk, "query_id bigint, vec_id bigint, score bigint"))


def _fit_cells(vectors: DataFrame, shard_rows: int) -> Cells | None:
    """Centres from a bounded sample, by the order of a hash; None if there are no vectors."""
    count, width = vectors.agg(F.count(F.lit(1)), F.max(F.size("vector"))).first()
    if not count:
        return None
    rows = max(1, min(SAMPLE_ROWS, SAMPLE_BYTES // (8 * width)))
    sample = (vectors.orderBy(F.xxhash64("vec_id", "vector")).limit(rows)
              .select("vector").toArrow().column(0))
    lengths = _lengths(sample)
    usual = np.bincount(lengths).argmax()
    sample = _matrix(sample.filter(pa.array(lengths == usual)))
    return Cells.fitted(sample, max(1, min(-(-count // shard_rows),
                                           len(sample) // SAMPLE_A_CELL)))


def _in_cells(vectors: DataFrame, cells: Cells) -> DataFrame:
    """``vec_id, vector, cell, away``: the nearest centre and the distance from it."""
    shared = vectors.sparkSession.sparkContext.broadcast(cells)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = shared.value
        for piece in slices(batches):
            for start in range(0, piece.num_rows, BLOCK_ROWS):
                block = piece.slice(start, BLOCK_ROWS)
                usual = _lengths(block.column(1)) == cells.centres.shape[1]
                cell = np.full(block.num_rows, len(cells.centres))
                away = np.zeros(block.num_rows)
                if usual.any():
                    cell[usual], away[usual] = cells.nearest(
                        _matrix(block.column(1).filter(pa.array(usual))))
                yield pa.record_batch([block.column(0), block.column(1),
                                       pa.array(cell, pa.int32()), pa.array(away)],
                                      names=["vec_id", "vector", "cell", "away"])

    return vectors.mapInArrow(place, "vec_id bigint, vector array<double>, cell int, away double")


_VISITS = ("visits bigint, query_id bigint, asked array<double>, asked_block bigint, "
           "floor double")


def _visits(asked: DataFrame, shared, start: int, until: int) -> DataFrame:
    """A row for each shard that a query of ``asked`` visits in this wave."""

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = shared.value
        width = cells.centres.shape[1]
        for piece in slices(batches):
            for at in range(0, piece.num_rows, BLOCK_ROWS):
                block = piece.slice(at, BLOCK_ROWS)
                usual = np.flatnonzero(_lengths(block.column(1)) == width)
                others = np.setdiff1d(np.arange(block.num_rows), usual) if not start else usual[:0]
                rows, due = usual[:0], usual[:0]
                if len(usual):
                    some = block.take(pa.array(usual))
                    rows, due = cells.due(_matrix(some.column(1)),
                                          some.column(3).to_numpy(), start, until)
                    rows = usual[rows]
                rows = np.concatenate([rows, others])
                due = np.concatenate([due, np.full(len(others), len(cells.centres))])
                shards = cells.first[due + 1] - cells.first[due]
                rows, ends = np.repeat(rows, shards), np.cumsum(shards)
                numbers = np.arange(len(rows)) + np.repeat(cells.first[due] - ends + shards, shards)
                step = max(1, SLICE_BYTES * block.num_rows // max(1, block.nbytes))
                for i in range(0, len(rows), step):
                    sent = block.take(pa.array(rows[i:i + step]))
                    yield pa.record_batch([pa.array(numbers[i:i + step]), *sent.columns],
                                          names=["visits", *sent.schema.names])

    return asked.mapInArrow(visit, _VISITS)


def _numbered_blocks(queries: DataFrame, cells: Cells, block_rows: int) -> DataFrame:
    """``query_id, asked, asked_block``: blocks of about ``block_rows`` queries, at most one
    and a half times as many but for the chance of a hash. Queries that have the highest bound
    in the same cell stand together; neighbouring cells with few queries share a block, since
    each block that visits a shard has it sent once more."""
    shared = queries.sparkSession.sparkContext.broadcast(cells)

    def start(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = shared.value
        for piece in slices(batches):
            for at in range(0, piece.num_rows, BLOCK_ROWS):
                block = piece.slice(at, BLOCK_ROWS)
                usual = _lengths(block.column(1)) == cells.centres.shape[1]
                home = np.full(block.num_rows, len(cells.centres))
                if usual.any():
                    home[usual] = cells.bounds(
                        _matrix(block.column(1).filter(pa.array(usual)))).argmax(axis=1)
                yield pa.record_batch([block.column(0), block.column(1),
                                       pa.array(home, pa.int32())],
                                      names=["query_id", "asked", "home"])

    homes = written(queries.mapInArrow(start, "query_id bigint, asked array<double>, home int"),
                    "queries")
    # At most as many rows as there are cells.
    blocks, held, rows = -1, None, []
    for home, count in homes.groupBy("home").count().orderBy("home").collect():
        parts = max(1, round(count / block_rows))
        if parts == 1 and held is not None and held + count <= 1.5 * block_rows:
            held += count
        else:
            blocks += 1
            held = count if parts == 1 else None
        rows.append((home, blocks, parts))
        blocks += parts - 1
    parts = homes.sparkSession.createDataFrame(rows, "home int, before bigint, parts bigint")
    return homes.join(F.broadcast(parts), "home").select(
        "query_id", "asked",
        (F.col("before") + F.pmod(F.xxhash64("query_id"), "parts")).alias("asked_block"))


def top_k(embeddings: DataFrame, k: int = 5, every: int = 50, scale: int = SCALE,
          shard_rows: int = SHARD_ROWS, query_bytes: int = QUERY_BYTES) -> DataFrame:
    """The ``k`` best of all other rows for each query, a row whose id ``every`` divides.

    Repeated ids are separate candidates but one query (their first vector in order); a row is
    never its own query's candidate, nor is a row that repeats its id. Without rows, or with
    one row, there is no result.
    """
    spark = embeddings.sparkSession
    ship_code(spark)
    vectors = integer_vectors(embeddings, scale)
    cells = _fit_cells(vectors, shard_rows)
    if cells is None:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    in_cells = written(_in_cells(vectors, cells), "vectors")
    found = in_cells.groupBy("cell").agg(F.count(F.lit(1)), F.max("away")).collect()
    cells.measure({cell: (rows, away) for cell, rows, away in found}, shard_rows)
    # One row for each cell: at most SAMPLE_ROWS / SAMPLE_A_CELL + 1.
    parts = spark.createDataFrame(
        [(c, int(cells.first[c]), int(cells.first[c + 1] - cells.first[c]))
         for c in range(len(cells.centres) + 1)], "cell int, before bigint, parts bigint")
    placed = in_cells.join(F.broadcast(parts), "cell").select(
        "vec_id", "vector",
        (F.col("before") + F.pmod(F.xxhash64("vec_id", "vector"), "parts")).alias("shard"))
    # Names of their own keep the queries apart from the rows they come from.
    queries = (in_cells.filter(F.col("vec_id") % every == 0)
               .select(F.col("vec_id").alias("query_id"), F.col("vector").alias("asked"))
               .groupBy("query_id").agg(F.min("asked").alias("asked")))
    queries = _numbered_blocks(queries, cells,
                               max(1, query_bytes // (8 * cells.centres.shape[1])))
    shared = spark.sparkContext.broadcast(cells)
    best, start, until = None, 0, 1
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    while True:
        lowest = F.lit(float("-inf"))
        asked = queries.withColumn("floor", lowest)
        if best is not None:
            floors = (best.filter(F.col("rank") == k)
                      .select("query_id", F.col("score").cast("double").alias("known")))
            asked = queries.join(floors, "query_id", "left").select(
                "query_id", "asked", "asked_block", F.coalesce("known", lowest).alias("floor"))
        visits = _visits(asked.select("query_id", "asked", "asked_block", "floor"),
                         shared, start, until)
        # A shard goes to the blocks that have a query for it, and to no others.
        met = visits.select(F.col("visits").alias("shard"),
                            F.col("asked_block").alias("block")).distinct()
        found = _search_shards(placed.join(met, "shard"), visits, k)
        if best is not None:
            found = found.unionByName(best.drop("rank"))
        ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        ranked = ranked.select("query_id", "rank", "vec_id", "score")
        if until >= len(cells.centres):
            return ranked
        best = written(ranked, "best")
        start, until = until, until * GROWTH
