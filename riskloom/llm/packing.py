"""Packing of documents into training sequences by a grouping genetic algorithm.

Pieces are spread over shards of bounded size. Several islands breed packings of each shard:
a crossover copies whole well-filled sequences of one packing into another, takes out the
sequences that hold a piece twice, and best-fits the pieces this displaces. Between epochs the
best packing of each island moves to its neighbour. Sequences that end up well filled are
final; the pieces of the others are dealt out anew, shard by shard, until they fill one
shard or no longer get fewer. Only lengths take part; token ids stay where they are.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import ship_code, slices, text_of, written
from riskloom.llm.token_files import crc32_of
from riskloom.llm.tokens import encoder

CAPACITY = 2048
SHARD_ITEMS = 4096
ISLANDS = 2
EPOCHS = 2
GENERATIONS = 6
POPULATION = 4
#: A sequence filled so far is final.
WELL_FILLED = 0.985

_PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
_PIECE_COLUMNS = ["doc_id", "piece", "start", "length", "ids_crc32"]


def cut_points(n: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """Start and length of each piece of a document: full ones but for the first."""
    first = n % capacity
    starts = ([0] if first else []) + list(range(first, n, capacity))
    return [(s, (first if s == 0 and first else capacity)) for s in starts]


def pieces_of(docs: DataFrame, tokenizer: str | None = None,
              capacity: int = CAPACITY) -> DataFrame:
    """The pieces of every row of ``docs(doc_id, text)``; a null text is empty, and even an
    empty one has its end id."""
    ship_code(docs.sparkSession)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        for batch in slices(batches):
            rows = [(doc, k, start, length, crc32_of(ids[start:start + length]))
                    for doc, ids in zip(batch.column(0).to_pylist(),
                                        encode.encode(batch.column(1)))
                    for k, (start, length) in enumerate(cut_points(len(ids), capacity))]
            doc, k, start, length, crc = zip(*rows)
            yield pa.record_batch({
                "doc_id": pa.array(doc, pa.int64()), "piece": pa.array(k, pa.int32()),
                "start": pa.array(start, pa.int64()), "length": pa.array(length, pa.int64()),
                "ids_crc32": pa.array(crc, pa.int64())})

    return docs.select("doc_id", text_of().alias("text")).mapInArrow(cut, _PIECES)


class Shard:
    """Packings of one shard's pieces. A packing is the sequence number of each piece."""

    def __init__(self, lengths: np.ndarray, capacity: int, random: np.random.Generator):
        self.lengths, self.capacity, self.random = lengths, capacity, random
        self.least = math.ceil(lengths.sum() / capacity)

    def fills(self, packing: np.ndarray) -> np.ndarray:
        return np.bincount(packing, self.lengths).astype(np.int64)

    def fitness(self, packing: np.ndarray) -> tuple[int, float]:
        """Fewer sequences are better; among as many, those with fuller ones."""
        fills = self.fills(packing)
        return -len(fills), float(((fills / self.capacity) ** 2).sum())

    def best_fit(self, packing: np.ndarray, loose: np.ndarray) -> np.ndarray:
        """Put the loose pieces, in the order given, where the least space is left over."""
        free = (self.capacity - np.bincount(packing[packing >= 0],
                                            self.lengths[packing >= 0])).astype(int).tolist()
        at: dict[int, list[int]] = {}
        for number, space in enumerate(free):
            at.setdefault(space, []).append(number)
        open_spaces = sum(1 << space for space in at if space > 0)
        lengths, packing = self.lengths, packing.copy()
        for piece, length in zip(loose.tolist(), lengths[loose].tolist()):
            fitting = open_spaces >> length
            if fitting:
                space = length + (fitting & -fitting).bit_length() - 1
                number = at[space].pop()
                if not at[space]:
                    open_spaces ^= 1 << space
            else:
                space, number = self.capacity, len(free)
                free.append(space)
            packing[piece] = number
            left = space - length
            if left > 0:
                if not at.setdefault(left, []):
                    open_spaces |= 1 << left
                at[left].append(number)
        return packing

    def _compact(self, packing: np.ndarray) -> np.ndarray:
        """Numbers without gaps; loose pieces are -1."""
        numbers = np.unique(packing[packing >= 0])
        return np.where(packing < 0, -1, np.searchsorted(numbers, packing))

    def decreasing(self, pieces: np.ndarray, shake: float = 0.0) -> np.ndarray:
        """Long pieces first, with some disorder."""
        keys = self.lengths[pieces] * (1 + shake * self.random.standard_normal(len(pieces)))
        return pieces[np.argsort(-keys, kind="stable")]

    def first_packings(self, count: int) -> list[np.ndarray]:
        everything, nothing = np.arange(len(self.lengths)), np.full(len(self.lengths), -1)
        return [self.best_fit(nothing, self.decreasing(everything, 0.02 * i))
                for i in range(count)]

    def cross(self, into: np.ndarray, source: np.ndarray) -> np.ndarray:
        """Copy well-filled sequences of ``source`` into ``into``."""
        fills = self.fills(source)
        good = np.flatnonzero(fills >= np.quantile(fills, .5))
        chosen = good[self.random.random(len(good)) < self.random.uniform(.1, .6)]
        injected = np.isin(source, chosen)
        hit = np.isin(into, np.unique(into[injected]))
        child = np.where(hit, -1, into)
        child = np.where(injected, source + into.max() + 1, child)
        loose = np.flatnonzero(child < 0)
        return self.best_fit(self._compact(child), self.decreasing(loose))

    def mutate(self, packing: np.ndarray) -> np.ndarray:
        """Empty the worst sequences and some others, and fit their pieces anew."""
        fills = self.fills(packing)
        worst = np.argsort(fills, kind="stable")[:max(2, len(fills) // 20)]
        others = self.random.integers(0, len(fills), max(1, len(fills) // 20))
        loose = np.flatnonzero(np.isin(packing, np.append(worst, others)))
        child = packing.copy()
        child[loose] = -1
        return self.best_fit(self._compact(child), self.decreasing(loose, .1))

    def evolve(self, population: list[np.ndarray], generations: int, size: int
               ) -> list[np.ndarray]:
        """The best packings after some generations, best first."""
        ranked = sorted(population, key=self.fitness, reverse=True)[:size]
        for _ in range(generations):
            if -self.fitness(ranked[0])[0] <= self.least:
                break
            children = []
            for _ in range(size):
                one, two = self.random.integers(0, len(ranked), 2)
                children.append(self.cross(ranked[min(one, two)], ranked[max(one, two)])
                                if one != two else self.mutate(ranked[one]))
            ranked = sorted(ranked + children, key=self.fitness, reverse=True)[:size]
        return ranked


def _as_arrays(column: pa.Array) -> list[np.ndarray]:
    return [np.array(x, np.int64) for x in column.to_pylist()]


def _breed(islands: DataFrame, capacity: int, epoch: int) -> DataFrame:
    """One epoch of every island, from the packings that came with it, if any."""

    def breed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shards, numbers = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            best, counts, squares = [], [], []
            for shard, island, lengths, given in zip(shards, numbers, _as_arrays(batch.column(2)),
                                                     batch.column(3).to_pylist()):
                own = Shard(lengths, capacity, np.random.default_rng([shard, island, epoch]))
                population = [np.array(p, np.int64) for p in given or []]
                population += own.first_packings(max(0, POPULATION - len(population)))
                found = own.evolve(population, GENERATIONS, POPULATION)[0]
                count, square = own.fitness(found)
                best.append(found.astype(np.int32))
                counts.append(count)
                squares.append(square)
            yield pa.record_batch({
                "shard": batch.column(0), "island": batch.column(1),
                "packing": pa.array(best, pa.list_(pa.int32())),
                "fewness": pa.array(counts, pa.int64()),
                "fullness": pa.array(squares, pa.float64())})

    return islands.mapInArrow(
        breed, "shard bigint, island int, packing array<int>, fewness bigint, fullness double")


def _pack_shards(items: DataFrame, shards: int, capacity: int) -> DataFrame:
    """``items`` with ``shard``, ``bin``, the bin's ``fill`` and the ``offset`` in it."""
    spread = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(shards))
    struct = F.struct(*_PIECE_COLUMNS)
    held = written(items.withColumn("shard", spread).groupBy("shard")
                   .agg(F.collect_list(struct).alias("items")), "shards")
    islands = held.select("shard", F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1)))
                          .alias("island"), F.col("items.length").alias("lengths"))
    # Islands are few bytes and much work: a stated number of tasks is not made smaller.
    wanted = 16 * int(items.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tasks = min(shards * ISLANDS, wanted)
    packed = None
    for epoch in range(EPOCHS):
        if packed is None:
            given = islands.withColumn("given", F.lit(None).cast("array<array<int>>"))
        else:
            # An island goes on with its own best packing and its neighbour's.
            moves = packed.select("shard", "packing", F.explode(F.array(
                "island", (F.col("island") + 1) % ISLANDS)).alias("island"))
            gathered = moves.groupBy("shard", "island").agg(
                F.collect_list("packing").alias("given"))
            given = islands.join(gathered, ["shard", "island"])
        packed = written(_breed(given.repartition(tasks, "shard", "island"), capacity, epoch), "packings")
    best = packed.groupBy("shard").agg(F.max(F.struct("fewness", "fullness", "packing"))
                                       .getField("packing").alias("packing"))
    rows = held.join(best, "shard").select("shard", F.explode(
        F.arrays_zip(F.col("items"), F.col("packing"))).alias("x")).select(
        "shard", "x.items.*", F.col("x.packing").alias("bin"))
    # A sequence holds at most ``capacity`` pieces, as none is empty.
    bins = rows.groupBy("shard", "bin").agg(
        F.array_sort(F.collect_list(struct)).alias("items"), F.sum("length").alias("fill"))
    offsets = F.expr("transform(items, (x, i) -> aggregate(slice(items, 1, i), 0L, "
                     "(s, y) -> s + y.length))")
    return bins.select("shard", "bin", "fill", F.explode(
        F.arrays_zip("items", offsets.alias("offsets"))).alias("x")).select(
        "x.items.*", "shard", "bin", "fill", F.col("x.offsets").alias("offset"))


def pack(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY,
         shard_items: int = SHARD_ITEMS) -> DataFrame:
    """Every piece of every row of ``docs(doc_id, text)`` with its sequence and place there.

    Repeated rows are packed as often as they occur; an empty table gives no row; further
    columns are ignored. Sequences have no gaps and hold at most ``capacity`` ids.
    """
    pieces = written(pieces_of(docs, tokenizer, capacity), "pieces")
    full = pieces.filter(F.col("length") >= capacity)
    done = [full.select(*_PIECE_COLUMNS, F.monotonically_increasing_id().alias("sequence_id"),
                        F.lit(0).cast("long").alias("offset"))]
    items, before, level = pieces.filter(F.col("length") < capacity), None, 0
    while True:
        count = items.count()
        if not count:
            break
        level += 1
        shards = max(1, round(count / shard_items))
        packed = written(_pack_shards(items, shards, capacity), "packed")
        last = shards == 1 or (before is not None and count > .7 * before)
        final = packed if last else packed.filter(F.col("fill") >= WELL_FILLED * capacity)
        number = F.lit(level << 58) + F.col("shard") * F.lit(1 << 24) + F.col("bin")
        done.append(final.select(*_PIECE_COLUMNS, number.alias("sequence_id"), "offset"))
        if last:
            break
        items = packed.filter(F.col("fill") < WELL_FILLED * capacity).select(*_PIECE_COLUMNS)
        before = count
    return reduce(DataFrame.unionByName, done)
