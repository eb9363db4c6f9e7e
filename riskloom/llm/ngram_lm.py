"""Log-probabilities of whole texts under a trigram model in the form of a backoff automaton.

A state remembers the last two words, the last one or none (the root). It has an arc for each
word that followed it in training, and a failure arc to the state that remembers one word
less; the root has arcs for the single words and one for unknown ones. A text is read once
from left to right: where the state has no arc for a token, failure arcs are followed until one
has. The arc that is taken tells the next state, and the weights of the path add up.

Weights: the root has ``p(w) = (c + 1) / (N + V + 1)``; an arc from a state ``h`` has
``(1 - m) c(hw) / c(h) + m p'(w)``, ``p'`` being the weight in the state that the failure arc
leads to, and the failure arc has ``m = (1 + c(h)) ** -g``, so that a state fails the less the
more often it was met. For each order, ``g`` makes the failure arcs carry in total the mass of
unseen followers by Good and Turing, the number of n-grams met once. The weights of a state sum
to 1.

The n-grams of all documents are counted. Documents are dealt to blocks of bounded size; a
block sends each distinct n-gram once, sorted and packed by ranges of their hashes; a range
adds up what all blocks sent and answers each block with counts in the order it asked. So a
block gets the part of the automaton that it needs, and nothing is broadcast. Words have
64-bit hashes; those of longer n-grams have so many bits that no more than a few n-grams in a
million share their hash with another, whatever the size of the corpus.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import ship_code, slices, text_of, written
from riskloom.llm.hashing import GOLD, U, mix
from riskloom.llm.neardup import WordHashes, words_of
from riskloom.llm.toxicity import held_out

#: Bytes of text in a block, about.
BLOCK_BYTES = 6 << 20
_END, _START = U(1), U(2)
#: The last bits of a hash of several words: a bigram, one that ends a text (from which nothing
#: follows), a trigram.
_KIND, _PAIR, _LAST_PAIR, _TRIPLE = U(3), U(0), U(1), U(2)
#: Failure weights are fitted on numbers of states by powers of two of their counts.
CLASSES = 48


def token_hashes(words: list[bytes], hashes: WordHashes) -> np.ndarray:
    """Hashes of the words and of the end."""
    found = np.fromiter(map(hashes.__getitem__, words), U, len(words))
    return np.append(found, _END)


def gram_bits(size: int) -> int:
    """Bits of the hashes of longer n-grams in a corpus of so many bytes."""
    return min(64, max(48, size.bit_length() + 18))


class Block:
    """The distinct n-grams of some documents and where the tokens have them.

    ``words`` and ``grams`` are ascending hashes, ``word_counts`` and ``gram_counts`` how often
    they occur in training. Of each token ``word``, ``pair`` and ``triple`` are the places of
    the n-grams that it ends there; ``before`` is the place of the word before it (of the end
    for a first token: texts begin as often as they end).
    """

    def __init__(self, documents: list[np.ndarray], trained: np.ndarray, bits: int = 64):
        self.lengths = np.array([len(d) for d in documents])
        tokens = np.concatenate(documents)
        self.first = np.zeros(len(tokens), bool)
        self.first[np.cumsum(self.lengths) - self.lengths] = True
        weight = np.repeat(trained, self.lengths).astype(float)
        self.words, self.word = np.unique(tokens, return_inverse=True)
        self.word_counts = np.bincount(self.word, weight, len(self.words)).astype(np.uint32)
        self.before = np.roll(self.word, 1)
        self.before[self.first] = np.searchsorted(self.words, _END)
        previous = np.where(self.first, _START, np.roll(tokens, 1))
        two = mix(mix(previous + GOLD) ^ tokens)
        # A first token ends no trigram; its place is never looked at.
        three = mix(mix(np.roll(two, 1) + (GOLD << U(1))) ^ tokens)[~self.first]
        shift = U(64 - bits)
        two = (two >> shift) & ~_KIND | np.where(tokens == _END, _LAST_PAIR, _PAIR)
        three = (three >> shift) & ~_KIND | _TRIPLE
        self.bits = bits
        self.grams, place = np.unique(np.concatenate([two, three]), return_inverse=True)
        self.gram_counts = np.bincount(place, np.concatenate([weight, weight[~self.first]]),
                                       len(self.grams)).astype(np.uint32)
        self.pair = place[:len(tokens)]
        self.triple = np.zeros(len(tokens), np.int64)
        self.triple[~self.first] = place[len(tokens):]

    def messages(self, bits: int) -> Iterator[tuple[int, bytes, bytes, bytes]]:
        """Range, packed words, packed longer n-grams and the counts of both, for each range of
        hashes that has some."""
        sides = [(self.words, self.word_counts, 64), (self.grams, self.gram_counts, self.bits)]
        found: dict[int, list] = {}
        for side, (keys, counts, width) in enumerate(sides):
            ranges = (keys >> U(width - bits)).astype(np.int64) if bits else np.zeros(
                len(keys), np.int64)
            bounds = np.flatnonzero(np.append(True, ranges[1:] != ranges[:-1]))
            for a, b in zip(bounds, np.append(bounds[1:], len(ranges))):
                own = found.setdefault(int(ranges[a]), [keys[:0], keys[:0], [], []])
                own[side], own[side + 2] = keys[a:b], counts[a:b]
        for range_, (words, grams, *counts) in sorted(found.items()):
            yield range_, pack_keys(words), pack_keys(grams), zlib.compress(
                np.concatenate(counts).astype(np.uint32).tobytes(), 1)


def pack_keys(keys: np.ndarray) -> bytes:
    """Ascending keys as differences of as few bytes as the largest needs."""
    if not len(keys):
        return b""
    steps = np.diff(keys, prepend=U(0))
    first, rest = steps[:1], steps[1:]
    width = max(1, (int(rest.max()).bit_length() + 7) // 8) if len(rest) else 1
    low = np.ascontiguousarray(rest.astype("<u8")).view(np.uint8).reshape(-1, 8)[:, :width]
    return bytes([width]) + first.astype("<u8").tobytes() + low.tobytes()


def unpack_keys(data: bytes) -> np.ndarray:
    if not data:
        return np.zeros(0, U)
    width = data[0]
    low = np.frombuffer(data, np.uint8, offset=9).reshape(-1, width)
    full = np.zeros((len(low) + 1, 8), np.uint8)
    full[1:, :width] = low
    full[0] = np.frombuffer(data, np.uint8, 8, offset=1)
    return np.cumsum(full.view("<u8").ravel(), dtype=U)


def failure_exponent(states: np.ndarray, mass: np.ndarray, once: int) -> float:
    """The ``g`` by which failure arcs ``(1 + c) ** -g`` carry a mass of ``once``.

    ``states`` and ``mass`` are the number of states and the sum of their counts for each power
    of two; states of a class fail alike. Kept off both ends, so that every path has a weight
    and seen followers have some of it.
    """
    some = states > 0
    mass = mass[some].astype(float)
    met = mass / states[some]
    wanted = min(max(once, 1), .99 * mass.sum())
    low, high = 0.0, 64.0
    for _ in range(100):
        middle = (low + high) / 2
        if (mass * (1 + met) ** -middle).sum() > wanted:
            low = middle
        else:
            high = middle
    return low


class Automaton:
    """The part of the model that a block's tokens can reach, given the training counts of the
    block's words and longer n-grams."""

    def __init__(self, word_counts: np.ndarray, gram_counts: np.ndarray, tokens: int, words: int,
                 exponents: tuple[float, float]):
        self.word_counts, self.gram_counts = word_counts.astype(float), gram_counts.astype(float)
        self.tokens, self.words, self.exponents = tokens, words, exponents

    def root(self, word: np.ndarray) -> np.ndarray:
        return (self.word_counts[word] + 1) / (self.tokens + self.words + 1)

    def walk(self, block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each token, in reading order: weight of the path, of the root's arc, known."""
        seen = [self.word_counts[block.word], self.gram_counts[block.pair],
                np.where(block.first, 0, self.gram_counts[block.triple])]
        # Words remembered by the longest state that has an arc for the token; -1: none knows it.
        level = sum((s > 0).astype(int) for s in seen) - 1
        # The arc that was taken tells the state in which the next token is read. A text starts
        # in the state of the start, which training has met unless it was empty.
        state = np.minimum(np.roll(level, 1) + 1, 2)
        state[block.first] = int(self.tokens > 0)
        met = [None, self.word_counts[block.before],
               np.where(block.first, 0, self.gram_counts[np.roll(block.pair, 1)])]
        arcs = [self.root(block.word)]
        log = np.zeros(len(level))
        failing = []
        with np.errstate(divide="ignore", invalid="ignore"):
            for k in (1, 2):
                fail = (1 + met[k]) ** -self.exponents[k - 1]
                arcs.append((1 - fail) * seen[k] / met[k] + fail * arcs[-1])
                failing.append(fail)
            for k in (2, 1):
                # Tokens whose state has no arc follow the failure arc.
                fails = (state == k) & (level < k)
                log[fails] += np.log10(failing[k - 1][fails])
                state = np.where(fails, k - 1, state)
            log += np.log10(np.choose(state, arcs))
        return log, np.log10(arcs[0]), seen[0] > 0


def _block_of(table: pa.Table | pa.RecordBatch, hashes: WordHashes, bits: int) -> Block:
    documents = [token_hashes(words_of(zlib.decompress(z).decode()), hashes)
                 for z in table.column("packed").to_pylist()]
    trained = ~np.array(table.column("held_out").to_pylist(), bool)
    return Block(documents, trained, bits)


_SCORED = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()),
                     ("n_tokens", pa.int64()), ("n_known", pa.int64()),
                     ("train_tokens", pa.int64()), ("base_score", pa.float64()),
                     ("score", pa.float64())])
_SCORED_SQL = ("doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, "
               "train_tokens bigint, base_score double, score double")


def _packed(docs: DataFrame, blocks: int) -> DataFrame:
    """Texts compressed for the shuffle, each row in the block its content falls into."""
    rows = docs.select("doc_id", text_of().alias("text"), held_out(folds=7, fold=2)
                       .alias("held_out"))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            packed = [zlib.compress(t.encode(), 1) for t in batch.column(1).to_pylist()]
            yield pa.record_batch({"doc_id": batch.column(0), "held_out": batch.column(2),
                                   "block": batch.column(3),
                                   "packed": pa.array(packed, pa.binary())})

    return rows.mapInArrow(pack, "doc_id bigint, held_out boolean, block bigint, packed binary")


def _classes(counts: np.ndarray) -> list[int]:
    """Numbers of n-grams by powers of two of their counts, then the sums of their counts."""
    met = counts[counts > 0]
    at = np.frexp(met.astype(float))[1] - 1
    return [*np.bincount(at, minlength=CLASSES).tolist(),
            *np.bincount(at, met, CLASSES).astype(np.int64).tolist()]


def _answers(packed: DataFrame, bits: int, width: int) -> DataFrame:
    """Training counts of each block's n-grams, and each range's share of the totals: tokens,
    words, bigrams and trigrams met once, and the classes of words and of bigrams."""

    def ask(table: pa.Table) -> pa.Table:
        block = table.column("block")[0].as_py()
        sent = list(_block_of(table, WordHashes(), width).messages(bits))
        ranges, words, grams, counts = zip(*sent)
        return pa.table({"block": pa.array([block] * len(sent), pa.int64()),
                         "range": pa.array(ranges, pa.int64()),
                         "words": pa.array(words, pa.binary()),
                         "grams": pa.array(grams, pa.binary()),
                         "counts": pa.array(counts, pa.binary())})

    def answer(table: pa.Table) -> pa.Table:
        counts = [np.frombuffer(zlib.decompress(c), np.uint32)
                  for c in table.column("counts").to_pylist()]
        totals, sizes, kinds = [], [], []
        for name, first in (("words", True), ("grams", False)):
            keys = [unpack_keys(k) for k in table.column(name).to_pylist()]
            own = [c[:len(k)] if first else c[len(c) - len(k):] for c, k in zip(counts, keys)]
            distinct, place = np.unique(np.concatenate(keys), return_inverse=True)
            total = np.bincount(place, np.concatenate(own), len(distinct)).astype(np.int64)
            cuts = np.cumsum([len(k) for k in keys])[:-1]
            totals.append(np.split(total[place], cuts))
            kinds.append((distinct & _KIND, total))
        (_, words), (kind, grams) = kinds
        pairs = (kind == _PAIR) | (kind == _LAST_PAIR)
        stats = [int(words.sum()), int((words > 0).sum()), int((grams[pairs] == 1).sum()),
                 int((grams[kind == _TRIPLE] == 1).sum()), *_classes(words),
                 *_classes(grams[kind == _PAIR])]
        replies = [zlib.compress(np.concatenate(x).astype("<u8").tobytes(), 1)
                   for x in zip(*totals)]
        sizes = [len(x) for x in totals[0]]
        return pa.table({
            "block": table.column("block"), "range": table.column("range"),
            "words": pa.array(sizes, pa.int64()), "replies": pa.array(replies, pa.binary()),
            "stats": pa.array([stats, *[None] * (len(counts) - 1)], pa.list_(pa.int64()))})

    asked = packed.groupBy("block").applyInArrow(
        ask, "block bigint, range bigint, words binary, grams binary, counts binary")
    return asked.groupBy("range").applyInArrow(
        answer, "block bigint, range bigint, words bigint, replies binary, stats array<bigint>")


def text_scores(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Scores of every row of ``docs(doc_id, text)``, learned from those not held out.

    Null and empty texts have the end as their one token. Rows without an id are held out;
    repeated rows count as often as they occur. Without training rows every token is unknown
    and has probability 1. Further columns are ignored.
    """
    spark = docs.sparkSession
    ship_code(spark)
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    bits = min(40, (2 * blocks - 1).bit_length())
    width = gram_bits(int(size))
    packed = _packed(docs, blocks)
    replies = written(_answers(packed, bits, width), "ngram-counts")
    stats = dict(replies.select(F.posexplode("stats")).groupBy("pos")
                 .agg(F.sum("col").cast("long")).collect())
    tokens, words, once_two, once_three = (stats.get(i, 0) for i in range(4))
    classes = np.array([stats.get(i, 0) for i in range(4, 4 + 4 * CLASSES)]).reshape(4, CLASSES)
    exponents = (failure_exponent(*classes[:2], once_two),
                 failure_exponent(*classes[2:], once_three))

    def walk(texts: pa.Table, counts: pa.Table) -> pa.Table:
        if not texts.num_rows:
            return _SCORED.empty_table()
        block = _block_of(texts, WordHashes(), width)
        counts = counts.sort_by("range")
        known = [np.frombuffer(zlib.decompress(c), "<u8")
                 for c in counts.column("replies").to_pylist()]
        sizes = counts.column("words").to_pylist()
        paths, roots, seen = Automaton(
            np.concatenate([k[:n] for k, n in zip(known, sizes)]),
            np.concatenate([k[n:] for k, n in zip(known, sizes)]),
            tokens, words, exponents).walk(block)
        starts = np.cumsum(block.lengths) - block.lengths
        sums = [np.add.reduceat(x, starts) for x in (seen.astype(np.int64), roots, paths)]
        rows = len(block.lengths)
        return pa.table([texts.column("doc_id").combine_chunks(),
                         texts.column("held_out").combine_chunks(),
                         pa.array(block.lengths, pa.int64()), pa.array(sums[0], pa.int64()),
                         pa.array([tokens] * rows, pa.int64()), pa.array(sums[1]),
                         pa.array(sums[2])], schema=_SCORED)

    return (packed.groupBy("block").cogroup(replies.groupBy("block"))
            .applyInArrow(walk, _SCORED_SQL))
