"""Near-duplicate groups by SuperMinHash.

Each document is its set of word shingles. SuperMinHash gives every element a random rank in
every slot out of one permutation, so the ranks of an element differ between slots; signatures
vary less than with independent ranks, and a slot's later levels need not be looked at once all
slots hold an earlier one. Signatures are cut into bands; documents that agree in a band are
candidates. Equal sets count once. In each bucket the most central document, the anchor, is
compared with all others, which connects most of a group. For documents that share a bucket
and are not connected yet, an exact filter says whom they can still be similar to: if all sets
list their rarest shingles first, two similar sets have one in common near the front. Buckets
of these shingles are worked off with more and more anchors in each round, until so few pairs
are open that they are compared at once. So a group of copies never becomes pairs of all with
all. A comparison looks at signatures first, then at whole sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.common import ship_code, slices, text_of, written
from riskloom.llm.graphs import components
from riskloom.llm.hashing import GOLD, U, mix

WORDS = 5
BANDS, ROWS = 30, 5
#: Once a bucket's open pairs are so few times its members, they are compared at once.
OPEN_PAIRS = 16
#: Anchors of a bucket grow by this factor from round to round.
MORE_ANCHORS = 32
#: Pairs whose signatures agree less than this many standard errors below the limit are
#: not similar; whole sets are compared of all others.
ERRORS = 6.0
_SLICE = 1 << 20
_WORD_CACHE = 600_000

_ALL = (1 << 64) - 1


class WordHashes(dict):
    """64-bit hashes of words, remembered as they are met."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _WORD_CACHE:
            self.clear()
        self[word] = found = xxhash.xxh3_64_intdigest(word)
        return found


def words_of(text: str | None) -> list[bytes]:
    """Words with A-Z in lower case; only ASCII white space parts them."""
    return (text or "").encode().lower().split()


def shingle_hashes(words: list[bytes], hashes: WordHashes, n: int = WORDS) -> np.ndarray:
    """Distinct hashed shingles of ``n`` words; of fewer words, the sequence is one."""
    if not words:
        return np.zeros(0, U)
    h = np.fromiter(map(hashes.__getitem__, words), U, len(words))
    width = min(n, len(words))
    found = np.full(len(h) - width + 1, U(width))
    for i in range(width):
        found = mix(found + GOLD) ^ h[i:len(h) - width + 1 + i]
    return np.unique(mix(found))


def super_minhash(elements: np.ndarray, owners: np.ndarray, sets: int, slots: int) -> np.ndarray:
    """Signatures, a row for each set, of elements that belong to sets ``0..sets-1``.

    Level ``j`` of an element puts rank ``j + r`` into the slot that its random permutation has
    at place ``j``. All elements of all sets go through a level together; a set takes part
    until its slots all hold ranks below the next level.
    """
    ranks = np.full(sets * slots, np.iinfo(np.uint64).max, U)
    places = None
    for level in range(slots):
        if not len(elements):
            break
        draw = mix(elements + U((level + 1) * int(GOLD) & _ALL))
        value = (draw >> U(32)) | (U(level) << U(32))
        k = level + (((draw & U(0xFFFFFFFF)) * U(slots - level)) >> U(32)).astype(np.int64)
        every = np.arange(len(elements))
        slot = k if places is None else places[every, k]
        np.minimum.at(ranks, owners * slots + slot, value)
        most = ranks.reshape(sets, slots).max(axis=1)
        going = (most >= U(level + 1) << U(32))[owners]
        elements, owners, k = elements[going], owners[going], k[going]
        if places is None:
            places = np.tile(np.arange(slots, dtype=np.int16), (len(elements), 1))
        else:
            places = places[going]
        every = np.arange(len(elements))
        places[every, k], places[:, level] = places[:, level], places[every, k]
    return ranks.reshape(sets, slots)


def band_hashes(signatures: np.ndarray, bands: int, rows: int) -> np.ndarray:
    parts = signatures.reshape(len(signatures), bands, rows)
    found = np.broadcast_to(np.arange(1, bands + 1, dtype=U) * GOLD, parts.shape[:2])
    for i in range(rows):
        found = mix(found + GOLD) ^ parts[:, :, i]
    return mix(found)


def _features(docs: DataFrame, bands: int, rows: int, smallest: int) -> DataFrame:
    """Set size, fingerprint of the set and band hashes of every row with an id."""

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for outer in slices(batches):
            step = max(1, outer.num_rows * _SLICE // max(1, outer.column(1).nbytes))
            for start in range(0, outer.num_rows, step):
                batch = outer.slice(start, step)
                sets = [shingle_hashes(words_of(t), hashes) for t in batch.column(1).to_pylist()]
                sizes = np.array([len(s) for s in sets])
                # Smaller sets that differ are never similar enough.
                signed = np.flatnonzero(sizes >= smallest)
                buckets: list = [None] * len(sets)
                if len(signed):
                    elements = np.concatenate([sets[i] for i in signed])
                    owners = np.repeat(np.arange(len(signed)), sizes[signed])
                    found = super_minhash(elements, owners, len(signed), bands * rows)
                    for i, row in zip(signed, band_hashes(found, bands, rows).view(np.int64)):
                        buckets[i] = row
                marks: list = [None] * len(sets)
                if len(signed):
                    for i, row in zip(signed, found.astype(np.uint8)):
                        marks[i] = row.tobytes()
                prints = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
                yield pa.record_batch({
                    "doc_id": batch.column(0),
                    "n_shingles": pa.array(sizes, pa.int64()),
                    "set_print": pa.array(prints, pa.binary()),
                    "signature": pa.array(marks, pa.binary()),
                    "buckets": pa.array(buckets, pa.list_(pa.int64()))})

    return docs.select("doc_id", text_of().alias("text")).mapInArrow(
        describe, "doc_id bigint, n_shingles bigint, set_print binary, signature binary, "
                  "buckets array<bigint>")


def _shingle_set(text: str) -> set:
    words = words_of(text)
    if len(words) < WORDS:
        return {tuple(words)} if words else set()
    return set(zip(*(words[i:] for i in range(WORDS))))


def similar(one: set, two: set, percent: int) -> bool:
    common = len(one & two)
    return bool(one or two) and 100 * common >= percent * (len(one) + len(two) - common)


def _alike(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` whose signatures do not rule out that they are similar enough."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            one, two = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint8)
                        .reshape(batch.num_rows, -1) for i in (2, 3))
            limit = percent / 100
            error = (limit * (1 - limit) / one.shape[1]) ** .5
            near = (one == two).mean(axis=1) >= limit - ERRORS * error
            yield pa.RecordBatch.from_arrays(batch.columns[:2], names=["a", "b"]).filter(
                pa.array(near))

    def side(name: str) -> DataFrame:
        return sets.select(F.col("rep").alias(name), F.col("signature").alias(f"signature_{name}"))

    both = pairs.join(side("b"), "b").join(side("a"), "a")
    return both.select("a", "b", "signature_a", "signature_b").mapInArrow(
        compare, "a bigint, b bigint").distinct()


def _confirmed(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` whose whole sets are similar enough."""

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, known = None, set()
        for batch in slices(batches, 2):
            one, two, kept = batch.column(2).to_pylist(), batch.column(3).to_pylist(), []
            for left, right in zip(one, two):
                if left != held:
                    held, known = left, _shingle_set(left)
                kept.append(similar(known, _shingle_set(right), percent))
            yield pa.RecordBatch.from_arrays(batch.columns[:2], names=["a", "b"]).filter(
                pa.array(kept))

    def side(name: str) -> DataFrame:
        return texts.select(F.col("doc_id").alias(name), F.col("text").alias(f"text_{name}"))

    both = pairs.join(side("b"), "b").join(side("a"), "a")
    return both.select("a", "b", "text_a", "text_b").mapInArrow(confirm, "a bigint, b bigint")


def _front_shingles(texts: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """``rep, size, key, rest``: of each set the shingles of which similar sets must share one,
    and how many shingles of the set come after it.

    Of ``n`` shingles in a common order, those are the first ``n - ceil(limit * n) + 1``. The
    order is by rareness; what occurs once is no key.
    """
    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in slices(batches):
            sets = [shingle_hashes(words_of(t), hashes) for t in batch.column(1).to_pylist()]
            yield pa.record_batch({
                "rep": batch.column(0), "size": pa.array([len(x) for x in sets], pa.int64()),
                "print": pa.array([xxhash.xxh3_128_digest(x.tobytes()) for x in sets]),
                "shingles": pa.array([x.view(np.int64) for x in sets], pa.list_(pa.int64()))})

    sets = written(texts.join(reps, "doc_id").select("doc_id", "text").mapInArrow(
        describe, "rep bigint, size bigint, print binary, shingles array<bigint>"), "open-sets")
    rows = sets.select("rep", "size", "print", F.explode("shingles").alias("shingle"))
    known = F.xxhash64("shingle").alias("known")
    counts = (rows.groupBy("shingle").agg(F.count(F.lit(1)).alias("sets"))
              .filter("sets > 1").select(known, "sets"))
    order = Window.partitionBy("rep", "print").orderBy(F.coalesce("sets", F.lit(1)), "shingle")
    front = F.col("size") - F.ceil(F.col("size") * percent / 100) + 1
    return (rows.select("rep", "size", "print", "shingle", known).join(counts, "known", "left")
            .withColumn("place", F.row_number().over(order))
            .filter((F.col("place") <= front) & F.col("sets").isNotNull())
            .select("rep", "size", F.col("shingle").alias("key"),
                    (F.col("size") - F.col("place")).alias("rest")))


def _sizes_allow(one, two, percent: int):
    return 100 * F.least(one, two) >= percent * F.greatest(one, two)


def _rest_allows(one: str, two: str, percent: int):
    """Whether sets whose first common shingle this is can have enough in common: all that
    they share is this shingle and what comes after it."""
    size = F.col(f"{one}size") + F.col(f"{two}size")
    common = F.least(F.col(f"{one}rest"), F.col(f"{two}rest")) + 1
    return (100 + percent) * common >= percent * size


def _met(members: DataFrame) -> DataFrame:
    """Members of a bucket outside its largest label (``main``) with all of the bucket.

    These are at most twice the pairs of different label, however large a label is: a smaller
    label has no more than half of the members, so that each of its members has as many to meet.
    """
    one = members.filter("label != main").alias("x")
    return one.join(members.alias("y"), F.col("x.key") == F.col("y.key"))


def _pairs_of_labels(members: DataFrame, percent: int) -> DataFrame:
    """Each pair of different label in ``members(key, rep, size, rest, label, main)`` of which
    sizes and places allow that it is similar: once for each bucket."""
    once = (F.col("y.label") == F.col("y.main")) | (F.col("x.rep") < F.col("y.rep"))
    return _met(members).filter(
        (F.col("x.label") != F.col("y.label")) & once
        & _sizes_allow(F.col("x.size"), F.col("y.size"), percent)
        & _rest_allows("x.", "y.", percent)).select(
        F.least("x.rep", "y.rep").alias("a"), F.greatest("x.rep", "y.rep").alias("b"))


def near_duplicates(docs: DataFrame, percent: int = 85, bands: int = BANDS,
                    rows: int = ROWS) -> DataFrame:
    """Every row of ``docs(doc_id, text)`` with ``n_shingles``, ``component_id`` and ``kept``.

    Two documents are linked if ``100 * common >= percent * union`` of their shingles. Null
    and empty texts have no shingle and no link. Rows without an id have no link and a null
    component, and are kept. Rows that share an id are one document that has each of their
    sets. Further columns are ignored.
    """
    spark = docs.sparkSession
    ship_code(spark)
    # Sets of n elements that differ are at most n / (n + 1) similar.
    smallest = -(-percent // (100 - percent)) if percent < 100 else 1 << 62
    features = written(_features(docs, bands, rows, smallest), "shingle-sets")
    usable = features.filter(F.col("doc_id").isNotNull() & F.col("set_print").isNotNull())
    sets = written(usable.groupBy("set_print").agg(
        F.min("doc_id").alias("rep"), F.max("n_shingles").alias("size"),
        F.max("signature").alias("signature"), F.max("buckets").alias("buckets")),
        "distinct-sets")
    entries = sets.filter(F.col("buckets").isNotNull()).select(
        "rep", "size", F.explode("buckets").alias("bucket"))
    # Joins use another form of the key than the aggregates, so that both sides are shuffled
    # for them and adaptive execution can split a frequent bucket.
    key = F.xxhash64("bucket").alias("key")
    shared = (entries.groupBy("bucket").agg(
        F.min("rep").alias("low"), F.max("rep").alias("high"), F.count(F.lit(1)).alias("n"))
        .filter(F.col("low") < F.col("high")).select(key, "n"))
    found = written(entries.select("rep", "size", key).join(shared, "key"), "shared-buckets")
    # The original of a group of copies is in the large buckets of most bands.
    central = written(found.groupBy("rep").agg(F.sum("n").alias("weight")), "weights")
    members = written(found.drop("n").join(central, "rep"), "buckets")
    wanted = central.select(F.col("rep").alias("doc_id"))
    texts = written(docs.select("doc_id", text_of().alias("text")).join(wanted, "doc_id")
                    .distinct(), "candidate-texts")

    # An id with several sets connects them.
    several = (usable.select("doc_id", "set_print").distinct().groupBy("doc_id").count()
               .filter("count > 1"))
    links = written(usable.join(several, "doc_id").join(sets, "set_print")
                    .select(F.col("doc_id").alias("a"), F.col("rep").alias("b")), "own-links")
    labels = None if links.isEmpty() else components(links)

    def connect(pairs: DataFrame) -> DataFrame | None:
        found = written(_confirmed(pairs, texts, percent), "confirmed")
        every = found if labels is None else found.union(labels.select("id", "label"))
        return components(written(every, "links"))

    def with_labels(rows: DataFrame) -> DataFrame:
        if labels is None:
            return rows.withColumn("label", F.col("rep"))
        return (rows.join(labels.withColumnRenamed("id", "rep"), "rep", "left")
                .withColumn("label", F.coalesce("label", "rep")))

    hubs = written(members.groupBy("key").agg(F.max(F.struct("weight", "rep", "size")).alias("hub"))
                   .select("key", "hub"), "hubs")
    met = members.join(hubs, "key").filter(
        (F.col("rep") != F.col("hub.rep"))
        & _sizes_allow(F.col("size"), F.col("hub.size"), percent))
    pairs = met.select(F.least("rep", "hub.rep").alias("a"), F.greatest("rep", "hub.rep").alias("b"))
    tested = written(_alike(pairs.distinct(), sets, percent), "pairs")
    labels = connect(tested)
    state = written(with_labels(members), "bucket-state")
    apart = (state.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high"))
             .filter(F.col("low") < F.col("high")).select("key"))
    reps = written(state.join(apart, "key").select(F.col("rep").alias("doc_id")).distinct(),
                   "open-reps")
    members = written(_front_shingles(texts, reps, percent).join(central, "rep"), "front-shingles")
    anchors = MORE_ANCHORS
    while True:
        state = written(with_labels(members), "bucket-state")
        per_label = state.groupBy("key", "label").agg(F.count(F.lit(1)).alias("n"))
        few = (F.col("n") * F.col("n") - F.col("squares")) <= OPEN_PAIRS * F.col("n")
        buckets = written(per_label.groupBy("key").agg(
            F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("squares"),
            F.count(F.lit(1)).alias("labels"), F.max(F.struct("n", "label")).alias("largest"))
            .filter(F.col("labels") > 1)
            .select("key", few.alias("few"), F.col("largest.label").alias("main")),
            "open-buckets")
        counts = buckets.agg(F.count(F.lit(1)), F.count_if(~F.col("few"))).first()
        if not counts[0]:
            break
        going = written(state.join(buckets, "key"), "open-members")
        pairs = _pairs_of_labels(going.filter("few"), percent)
        if counts[1]:
            # Anchors of a bucket are of its youngest groups.
            slot = F.pmod(F.xxhash64("rep"), F.lit(anchors))
            best = F.max(F.struct("label", "weight", "rep", "size", "rest"))
            chosen = written(going.filter(~F.col("few")).groupBy("key", slot.alias("slot"))
                             .agg(best.alias("anchor")).select("key", "anchor"), "anchors")
            met = going.filter(~F.col("few")).join(chosen, "key").filter(
                (F.col("label") != F.col("anchor.label"))
                & _sizes_allow(F.col("size"), F.col("anchor.size"), percent)
                & _rest_allows("", "anchor.", percent))
            pairs = pairs.union(met.select(F.least("rep", "anchor.rep").alias("a"),
                                           F.greatest("rep", "anchor.rep").alias("b")))
            # An anchor has met all of its bucket.
            spent = chosen.select("key", F.col("anchor.rep").alias("rep"))
            members = written(going.filter(~F.col("few")).select("key", "rep", "size", "rest", "weight")
                              .join(spent, ["key", "rep"], "left_anti"), "buckets")
            anchors *= MORE_ANCHORS
        pairs = written(_alike(pairs.distinct(), sets, percent)
                        .join(tested, ["a", "b"], "left_anti"), "pairs")
        tested = written(tested.union(pairs), "tested")
        labels = connect(pairs)
        if not counts[1]:
            break
    joined = sets.select("set_print", "rep")
    if labels is not None:
        joined = (joined.join(labels.withColumnRenamed("id", "rep"), "rep", "left")
                  .withColumn("rep", F.coalesce("label", "rep")))
    groups = written(joined.select("set_print", F.col("rep").alias("component_id")), "groups")
    placed = features.join(groups, "set_print", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return placed.select("doc_id", "n_shingles", component.alias("component_id"),
                         F.col("doc_id").eqNullSafe(component).alias("kept"))
