"""Overlaps with benchmark items, found by spaced seeds.

A seed hashes some of the words in a short span and ignores the others, at places that a fixed
mask states. A passage in which words were substituted still shares seeds with its item as
long as the substitutions of some span fall on ignored places; the masks are chosen so that
this holds for every overlap there can be. Seeds of all texts are joined
with those of the items; around each hit both are laid side by side, and the longest stretch
with enough equal words decides.

Most seeds of a corpus hit nothing, so tasks drop those that a bit filter of the items' seeds
rules out before anything is shuffled. The filter has a fixed number of bits, whatever the
number of items: with very many items it only passes more.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import ship_code, slices, text_of, written
from riskloom.llm.hashing import GOLD, U, mix

# 1 is a word that counts. Every stretch of 12 to 23 words with a fifth of them
# substituted has a seed (a test enumerates them), and longer ones fall into such stretches, of
# which one has no more than its fifth.
MASKS = ("1110111", "11010010011", "11010001101")
SPAN = max(map(len, MASKS))
#: An overlap has so many words, or all of a shorter item, of which this share is equal.
LEAST_WORDS = 12
LEAST_EQUAL = 0.8
#: Items of so few words are found only when wholly equal.
WHOLE_WORDS = 5
#: Masks of items with fewer than LEAST_WORDS words, by their number of words.
SHORT_MASKS = {6: ("1111", "110011"), 7: ("11011",), 8: ("11011",), 9: ("110111",),
               10: ("111011", "11010011", "11111"), 11: ("1101011", "1110011")}
FILTER_BITS = 24

_WORD = re.compile(r"\w+")
#: Odd factors of the words of a mask.
_FACTORS = mix(GOLD * np.arange(1, SPAN + 1, dtype=U)) | U(1)


class _Hashes(dict):
    def __missing__(self, word: str) -> int:
        if len(self) >= 600_000:
            self.clear()
        self[word] = found = xxhash.xxh3_64_intdigest(word.encode())
        return found


def hashed_words(text: str | None, hashes: dict) -> np.ndarray:
    words = _WORD.findall((text or "").lower())
    return np.fromiter(map(hashes.__getitem__, words), U, len(words))


def masks_of(words: int) -> tuple[str, ...]:
    """The masks by which an item of so many words is found."""
    if words <= WHOLE_WORDS:
        return ("1" * words,) if words else ()
    return SHORT_MASKS.get(words, MASKS)


def all_seeds(words: np.ndarray, masks: list[str]) -> Iterator[np.ndarray]:
    """For each mask the seed that starts at each word, as far as the mask fits."""
    parts = [words * f for f in _FACTORS[:max(map(len, masks), default=0)]]
    for mask in masks:
        n = max(0, len(words) - len(mask) + 1)
        found = np.full(n, mix(np.array([int(mask, 2) * 1000 + len(mask)], U))[0])
        for i, mark in enumerate(mask):
            if mark == "1":
                found += parts[i][i:i + n]
        yield mix(found)


def longest_overlap(one: np.ndarray, two: np.ndarray, shift: int) -> tuple[int, int]:
    """Words and equal words of the longest stretch with ``LEAST_EQUAL`` equal ones when
    ``two``, the item, begins at place ``shift`` of ``one``. It begins and ends with an equal word
    or with the item's first or last."""
    start = max(0, -shift)
    stop = min(len(two), len(one) - shift)
    if stop <= start:
        return 0, 0
    equal = one[start + shift:stop + shift] == two[start:stop]
    # A stretch qualifies if these scores sum to zero or more.
    weight = round(LEAST_EQUAL / (1 - LEAST_EQUAL))
    sums = np.concatenate([[0], np.cumsum(np.where(equal, 1, -weight))])
    first_below = np.minimum.accumulate(sums)
    counts = np.concatenate([[0], np.cumsum(equal)])
    best = (0, 0)
    ends = np.flatnonzero(equal) + 1
    if stop == len(two) and not equal[-1]:
        ends = np.append(ends, len(equal))
    for end in ends:
        # The earliest start whose sum is not above the end's.
        at = int(np.searchsorted(-first_below, -sums[end]))
        while at < end and not equal[at] and start + at:
            at += 1
        if end - at > best[0] and sums[end] >= sums[at]:
            best = (int(end - at), int(counts[end] - counts[at]))
    return best


def whole_overlap(one: np.ndarray, two: np.ndarray, shift: int) -> tuple[int, int]:
    """Words and equal words of all of ``two`` at place ``shift`` of ``one``; zeros if it does
    not fit there or has too few equal words."""
    if shift < 0 or shift + len(two) > len(one):
        return 0, 0
    equal = int((one[shift:shift + len(two)] == two).sum())
    share = LEAST_EQUAL if len(two) > WHOLE_WORDS else 1
    return (len(two), equal) if equal >= share * len(two) else (0, 0)


def _item_rows(benchmark: DataFrame) -> DataFrame:
    """Word hashes of each item, and the seeds it is found by."""
    schema = ("item_id bigint, words array<bigint>, masks array<string>, "
              "hashes array<bigint>, places array<int>")

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Hashes()
        for batch in slices(batches):
            rows = []
            for text in batch.column(1).to_pylist():
                words = hashed_words(text, known)
                masks = list(masks_of(len(words)))
                found = list(all_seeds(words, masks))
                hashes = np.concatenate([words[:0], *found])
                places = np.concatenate([np.zeros(0, int), *(np.arange(len(f)) for f in found)])
                rows.append((words.view(np.int64), masks, hashes.view(np.int64),
                             places.astype(np.int32)))
            words, masks, hashes, places = zip(*rows)
            yield pa.record_batch({
                "item_id": batch.column(0), "words": pa.array(words, pa.list_(pa.int64())),
                "masks": pa.array(masks, pa.list_(pa.string())),
                "hashes": pa.array(hashes, pa.list_(pa.int64())),
                "places": pa.array(places, pa.list_(pa.int32()))})

    items = benchmark.filter(F.col("item_id").isNotNull()).select("item_id", text_of())
    return items.mapInArrow(describe, schema).filter(F.size("words") > 0)


def _filter_of(items: DataFrame) -> np.ndarray:
    """Two bits for each seed. At most 2**FILTER_BITS / 64 rows are fetched."""
    seed = items.select(F.explode("hashes").alias("h"))
    low = F.col("h").bitwiseAND((1 << FILTER_BITS) - 1)
    high = F.shiftrightunsigned("h", 64 - FILTER_BITS)
    bit = seed.select(F.explode(F.array(low, high)).alias("bit"))
    words = (bit.groupBy(F.shiftright("bit", 6).alias("word"))
             .agg(F.bit_or(F.expr("shiftleft(1L, CAST(bit & 63 AS INT))")).alias("bits"))
             .toArrow())
    found = np.zeros(1 << FILTER_BITS >> 6, np.int64)
    found[words.column("word").to_numpy()] = words.column("bits").to_numpy()
    return found.view(U)


def _passes(filter_: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """The places of hashes with both bits."""
    found = np.arange(len(hashes))
    for mask, shift in ((U((1 << FILTER_BITS) - 1), U(0)), (U(2 ** 64 - 1), U(64 - FILTER_BITS))):
        bit = (hashes[found] & mask) >> shift
        found = found[(filter_[(bit >> U(6)).astype(np.int64)] >> (bit & U(63)) & U(1)) > 0]
    return found


_HITS = "doc_id bigint, segment bigint, words array<bigint>, hashes array<bigint>, places array<int>"


def _hits(docs: DataFrame, masks: list[str], filter_: np.ndarray, reach: int) -> DataFrame:
    """The stretches of each text around seeds that pass the filter."""
    shared = docs.sparkSession.sparkContext.broadcast(filter_)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Hashes()
        for batch in slices(batches):
            rows = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = hashed_words(text, known)
                hashes, places = [words[:0]], [np.zeros(0, int)]
                for some in all_seeds(words, masks):
                    places.append(_passes(shared.value, some))
                    hashes.append(some[places[-1]])
                hashes, at = np.concatenate(hashes), np.concatenate(places)
                hit = np.argsort(at, kind="stable")
                at = at[hit]
                for group in np.split(np.arange(len(hit)),
                                      np.flatnonzero(np.diff(at) > 2 * reach) + 1):
                    if len(group):
                        a = max(0, int(at[group[0]]) - reach)
                        b = int(at[group[-1]]) + reach
                        rows.append((doc, a, words[a:b].view(np.int64),
                                     hashes[hit[group]].view(np.int64),
                                     (at[group] - a).astype(np.int32)))
            if rows:
                columns = zip(*rows)
                kinds = [pa.int64(), pa.int64(), *[pa.list_(pa.int64())] * 2,
                         pa.list_(pa.int32())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds)],
                    names=["doc_id", "segment", "words", "hashes", "places"])

    return docs.select("doc_id", text_of().alias("text")).mapInArrow(find, _HITS)


def overlaps(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, item_id, words, equal``: the longest overlap of a document with an item.

    Rows without an id have no overlap; rows that share one are taken together. Null and empty
    texts have none. Further columns are ignored.
    """
    ship_code(docs.sparkSession)
    items = written(_item_rows(benchmark), "benchmark-items")
    bounds = items.agg(F.max(F.size("words")), F.collect_set(F.array_join("masks", ","))).first()
    # There are at most as many kinds of masks as item lengths up to LEAST_WORDS.
    masks = sorted({m for kinds in bounds[1] for m in kinds.split(",")})
    reach = (bounds[0] or 0) + SPAN
    found = written(_hits(docs.filter(F.col("doc_id").isNotNull()), masks, _filter_of(items),
                          reach).withColumn("hit", F.monotonically_increasing_id()), "seed-hits")
    pair = lambda df, *names: df.select(
        *names, F.explode(F.arrays_zip("hashes", "places")).alias("s")).select(
        *names, F.col("s.hashes").alias("hash"), F.col("s.places").alias("place"))
    tests = pair(items, "item_id").withColumnRenamed("place", "item_place")
    laid = (pair(found, "hit").join(tests, "hash")
            .select("hit", "item_id", (F.col("place") - F.col("item_place")).alias("shift"))
            .distinct())
    both = (laid.join(found.select("hit", "doc_id", "words"), "hit")
            .join(items.select("item_id", F.col("words").alias("item_words")), "item_id")
            .select("doc_id", "item_id", "shift", "words", "item_words"))

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 3):
            rows = []
            for doc, item, shift, words, tested in zip(*(c.to_pylist() for c in batch.columns)):
                laid = longest_overlap if len(tested) >= LEAST_WORDS else whole_overlap
                length, equal = laid(np.array(words), np.array(tested), shift)
                if length >= min(LEAST_WORDS, len(tested)):
                    rows.append((doc, item, length, equal))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in zip(*rows)],
                    names=["doc_id", "item_id", "words", "equal"])

    verified = both.mapInArrow(verify, "doc_id bigint, item_id bigint, words bigint, equal bigint")
    best = F.max(F.struct("words", "equal"))
    return verified.groupBy("doc_id", "item_id").agg(best.alias("b")).select(
        "doc_id", "item_id", "b.words", "b.equal")


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Every row of ``docs`` with ``contaminated``, the number of items it overlaps with, and
    the item, words and equal words of its longest overlap (ties: the smallest item)."""
    best = F.max(F.struct("words", "equal", (-F.col("item_id")).alias("item")))
    per_doc = overlaps(docs, benchmark).groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n_items"), best.alias("b")).select(
        "doc_id", "n_items", (-F.col("b.item")).alias("item_id"),
        F.col("b.words").alias("overlap_words"), F.col("b.equal").alias("equal_words"))
    return docs.select("doc_id").join(per_doc, "doc_id", "left").select(
        "doc_id", F.col("n_items").isNotNull().alias("contaminated"),
        F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"),
        "item_id", "overlap_words", "equal_words")
