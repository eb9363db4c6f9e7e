"""Removal of repeated byte strings by prefix-free parsing.

Every string of ``WIDTH`` bytes holds a trigger: the least rolling hash of the short grams in
it. Neighbouring strings with the same trigger form a phrase, so texts are parsed where their
content says, and repeated passages are parsed alike. Phrases overlap by ``WIDTH - 1`` bytes,
so that each string lies whole in one phrase and no phrase suffix of that length needs what
follows it.

The dictionary holds each distinct phrase once, with its first place; all other occurrences
repeat it whole. What is left are distinct phrases with one trigger. A suffix array of the
dictionary orders their suffixes by the first ``WIDTH`` bytes; the parse, the rows and places
where phrases begin, orders equal ones, and all but the first are repeats. No suffix of a
phrase needs the phrases that follow it to be told from another, so the parse is ordered by
place and not by its own suffixes. As phrases with different triggers share no string of that
width, the dictionary is cut by triggers and its parts are sorted on many machines.

Phrases of most triggers meet whole in one task, where bytes are compared. Those of a frequent
trigger, such as a line in very many surroundings, are never gathered: their strings are dealt
out by content. These, and whole phrases, are compared by 128-bit hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.common import numbered, ship_code, slices, written
from riskloom.llm.hashing import GOLD, U, mix

WIDTH = 100
GRAM = 20
BLOCK = 1 << 18
#: Phrases, or suffixes, that a task sorts among themselves before it sends any.
SORTED_AT_ONCE = 1_000_000
#: A trigger with more phrases in a task, or in all tasks, is frequent: they are dealt out one
#: by one.
FREQUENT = 8
GATHERED = 4096
#: Bytes of a part of the dictionary that is sorted at once, and rows added to it at a time. A
#: phrase has at most 2 * WIDTH - GRAM bytes, so with these, and with what is left over of the
#: last trigger, a part stays below 2**RANK_BITS bytes.
DICTIONARY_BYTES = 900_000
DICTIONARY_ROWS = 2048
RANK_BITS = 21

_POSITION = U((1 << 20) - 1)
_BYTES_A = mix(np.arange(1, 257, dtype=U) * GOLD)
_BYTES_B = mix(_BYTES_A + GOLD)
_FACTORS = [int(x) | 1 for x in mix(np.arange(1000, 1010, dtype=U) * GOLD)]
PHRASE, WITNESS, REMOVED, FREQUENT_PHRASE = 0, 1, 2, 3


class Rolling:
    """Hashes of grams at every place of a block, by doubling their length."""

    def __init__(self, data: np.ndarray, table: np.ndarray):
        h = table[data]
        self.by_length = {}
        for i, m in enumerate((1, 2, 4, 8, 16)):
            h = h[:-m] * U(_FACTORS[i]) + h[m:]
            if m in (2, 8):
                h ^= h >> U(31)
            self.by_length[2 * m] = h

    def grams(self) -> np.ndarray:
        """At each place the hash of ``GRAM`` bytes."""
        long, short = self.by_length[16], self.by_length[4]
        return mix(long[:len(short) - 16] * U(_FACTORS[5]) + short[16:])

    def strings(self, at: np.ndarray) -> np.ndarray:
        """The hash of the ``WIDTH`` bytes at each of these places."""
        long, short = self.by_length[32], self.by_length[4]
        h = long[at] * U(_FACTORS[6]) + long[at + 32]
        h = h * U(_FACTORS[7]) + long[at + 64]
        return mix(h * U(_FACTORS[8]) + short[at + 96])


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    span = 1
    while 2 * span <= width:
        values = np.minimum(values[:-span], values[span:])
        span *= 2
    rest = width - span
    return np.minimum(values[:len(values) - rest], values[rest:]) if rest else values


def _blocks(rows: list[int], texts: list[str]) -> Iterator[tuple[np.ndarray, ...]]:
    """Bytes of many texts, with row and place of each; long texts run over several blocks."""
    held, size = [], 0
    for row, text in zip(rows, texts):
        data = text.encode()
        for at in range(0, max(1, len(data) - WIDTH + 1), BLOCK - WIDTH + 1):
            part = data[at:at + BLOCK]
            if len(part) < WIDTH:
                continue
            if size + len(part) > BLOCK and held:
                yield _block(held)
                held, size = [], 0
            held.append((row, at, part))
            size += len(part)
    if held:
        yield _block(held)


def _block(parts: list[tuple[int, int, bytes]]) -> tuple[np.ndarray, ...]:
    lengths = np.array([len(p) for _, _, p in parts])
    data = np.frombuffer(b"".join(p for _, _, p in parts), np.uint8)
    part = np.repeat(np.arange(len(parts)), lengths)
    first = np.cumsum(lengths) - lengths
    place = np.arange(len(data)) - first[part] + np.array([a for _, a, _ in parts])[part]
    return data, part, np.array([r for r, _, _ in parts], np.int64)[part], place


def parse(data: np.ndarray, part: np.ndarray) -> tuple[np.ndarray, ...]:
    """The phrases of a block: first string, number of strings, trigger hash, phrase hash."""
    rolling = Rolling(data, _BYTES_A)
    grams = rolling.grams()
    marked = (grams & ~_POSITION) | np.arange(len(grams), dtype=U)
    trigger = (_sliding_least(marked, WIDTH - GRAM + 1) & _POSITION).astype(np.int64)
    whole = part[:len(trigger)] == part[WIDTH - 1:WIDTH - 1 + len(trigger)]
    change = np.ones(len(trigger), bool)
    change[1:] = (trigger[1:] != trigger[:-1]) | ~whole[:-1]
    starts = np.flatnonzero(change & whole)
    if not len(starts):
        return starts, starts, starts.astype(U), starts.astype(U)
    last = np.ones(len(trigger), bool)
    last[:-1] = change[1:] | ~whole[1:]
    ends = np.flatnonzero(last & whole)
    count = ends - starts + 1
    prints = mix(rolling.strings(starts) * U(_FACTORS[9]) + rolling.strings(ends)
                 + count.astype(U))
    return starts, count, grams[trigger[starts]], prints


def merged_runs(rows: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple:
    """Intervals of each row with those that touch made one, in order."""
    if not len(rows):
        return rows, starts, ends
    order = np.lexsort((starts, rows))
    rows, starts, ends = rows[order], starts[order], ends[order]
    _, rank = np.unique(rows, return_inverse=True)
    lift = rank.astype(np.int64) << 40
    reach = np.maximum.accumulate(ends + lift)
    new = np.ones(len(rows), bool)
    new[1:] = starts[1:] + lift[1:] > reach[:-1]
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(rows)) - 1
    return rows[first], starts[first], reach[last] - lift[first]


def _firsts(keys: list[np.ndarray], rows: np.ndarray, places: np.ndarray) -> tuple:
    """The order by keys and corpus place, and which of that order are first of their key."""
    order = np.lexsort((places, rows, *keys[::-1]))
    first = np.zeros(len(order), bool)
    first[:1] = True
    for key in keys:
        k = key[order]
        first[1:] |= k[1:] != k[:-1]
    return order, first


def _table(key, print_, row, start, length, state) -> pa.RecordBatch:
    n = len(row)
    full = lambda x, kind: pa.array(np.broadcast_to(np.asarray(x), n).astype(kind))
    signed = lambda x: np.ascontiguousarray(x, U).view(np.int64)
    return pa.record_batch({
        "key": pa.array(signed(key)), "print": pa.array(signed(print_)),
        "row": full(row, np.int64), "start": full(start, np.int64),
        "length": full(length, np.int32), "state": full(state, np.int8)})


_ROWS = "key bigint, print bigint, row bigint, start bigint, length int, state tinyint"


def _removed(rows, starts, ends) -> pa.RecordBatch:
    rows, starts, ends = merged_runs(rows, starts, ends)
    return _table(mix(rows.astype(U) * GOLD + starts.astype(U)), np.zeros(len(rows), U),
                  rows, starts, ends - starts, REMOVED)


def _send_phrases(found: list[tuple]) -> Iterator[pa.RecordBatch]:
    """A task's dictionary: each phrase at its first place, and what repeats one here."""
    gram, print_, row, start, count = (np.concatenate(x) for x in zip(*found))
    order, first = _firsts([gram, print_], row, start)
    again = order[~first]
    yield _removed(row[again], start[again], start[again] + count[again] + WIDTH - 1)
    own = order[first]
    gram, print_, row, start, count = (x[own] for x in (gram, print_, row, start, count))
    grams, place, sizes = np.unique(gram, return_inverse=True, return_counts=True)
    frequent = sizes[place] > FREQUENT
    key = np.where(frequent, mix(gram + print_), gram)
    yield _table(key, print_, row, start, count + WIDTH - 1,
                 np.where(frequent, FREQUENT_PHRASE, PHRASE))
    told = grams[sizes > FREQUENT]
    zero = np.zeros(len(told), np.int64)
    yield _table(told, zero.astype(U), zero, zero, 0, WITNESS)


def _phrases(docs: DataFrame) -> DataFrame:
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in slices(batches):
            for data, part, row, place in _blocks(*(c.to_pylist() for c in batch.columns)):
                starts, count, gram, print_ = parse(data, part)
                held.append((gram, print_, row[starts], place[starts], count))
                size += len(starts)
                if size >= SORTED_AT_ONCE:
                    yield from _send_phrases(held)
                    held, size = [], 0
        if held:
            yield from _send_phrases(held)

    return docs.select("row", "text").mapInArrow(find, _ROWS)


_PARTS = ("key bigint, print bigint, row bigint, start bigint, data binary")


def _parts(one, two, rows, starts, data: list | None) -> pa.RecordBatch:
    signed = lambda x: pa.array(np.ascontiguousarray(x).astype(U).view(np.int64))
    return pa.record_batch({
        "key": signed(one), "print": signed(two), "row": pa.array(rows, pa.int64()),
        "start": pa.array(starts, pa.int64()),
        "data": pa.array(data, pa.binary()) if data else pa.nulls(len(rows), pa.binary())})


def suffix_ranks(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Ranks of the ``WIDTH`` bytes at these places; equal bytes have equal ranks.

    Ranks of 8 bytes give those of 24, these give those of 72, and two more of 24 bytes, the
    last four of which are new, settle the rest. ``data`` has less than 2**RANK_BITS bytes.
    """
    if len(data) >> RANK_BITS:
        raise ValueError("too many bytes to rank at once")

    def ranks(*parts: np.ndarray) -> np.ndarray:
        packed = parts[0].astype(U)
        for part in parts[1:]:
            packed = packed << U(RANK_BITS) | part.astype(U)
        return np.unique(packed, return_inverse=True)[1]

    if not len(at):
        return np.zeros(0, np.int64)
    windows = np.lib.stride_tricks.sliding_window_view(data, 8)
    words = ranks(np.ascontiguousarray(windows).view(">u8").ravel())
    short = ranks(words[:-16], words[8:-8], words[16:])
    long = ranks(short[at], short[at + 24], short[at + 48])
    return ranks(long, short[at + 72], short[at + WIDTH - 24])


def dictionary_order(data: bytes, lengths: np.ndarray, rows: np.ndarray, starts: np.ndarray
                     ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The suffix array of a dictionary, combined with its parse: row and place of each suffix
    of at least ``WIDTH`` bytes, ordered by its first bytes and, where these are equal, by the
    corpus; and whether it is the first of its kind.

    ``data`` has the phrases one after the other; the parse has ``rows`` and ``starts``.
    """
    count = lengths - WIDTH + 1
    phrase = np.repeat(np.arange(len(lengths)), count)
    offset = np.arange(len(phrase)) - (np.cumsum(count) - count)[phrase]
    at = (np.cumsum(lengths) - lengths)[phrase] + offset
    row, place = rows[phrase], starts[phrase] + offset
    order, first = _firsts([suffix_ranks(np.frombuffer(data, np.uint8), at)], row, place)
    return row[order], place[order], first


def _strings_of(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of every string of ``WIDTH`` bytes."""
    every = np.arange(len(data) - WIDTH + 1)
    return tuple(Rolling(data, table).strings(every) for table in (_BYTES_A, _BYTES_B))


def _contested_parts(rows: DataFrame) -> DataFrame:
    """The contested phrases of each text, and the strings of those with frequent triggers."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 2):
            phrases, strings = [], []
            columns = [batch.column(n).to_pylist() for n in (
                "row", "text", "starts", "lengths", "keys", "frequent")]
            for row, text, starts, lengths, keys, frequent in zip(*columns):
                data = text.encode() if starts else b""
                for start, length, key, often in zip(starts or [], lengths or [], keys or [],
                                                     frequent or []):
                    part = data[start:start + length]
                    if often:
                        one, two = _strings_of(np.frombuffer(part, np.uint8))
                        strings.append((one, two, np.full(len(one), row),
                                        start + np.arange(len(one))))
                    else:
                        phrases.append((key, row, start, part))
            if phrases:
                key, row, start, part = zip(*phrases)
                keys = np.array(key, np.int64).view(U)
                yield _parts(keys, np.zeros(len(keys), U), row, start, list(part))
            if strings:
                one, two, row, start = (np.concatenate(x) for x in zip(*strings))
                # What a task has several times it sends once.
                order, first = _firsts([one, two], row, start)
                again, own = order[~first], order[first]
                yield _parts(one[own], two[own], row[own], start[own], None)
                rows_, at, until = merged_runs(row[again], start[again], start[again] + WIDTH)
                lengths = until - at
                yield _parts(mix(rows_.astype(U) * GOLD + at.astype(U)), lengths, rows_, at,
                             [b""] * len(rows_))

    return rows.mapInArrow(find, _PARTS)


def _joined(phrases: list[tuple]) -> tuple:
    columns = list(zip(*phrases))
    return (*(np.concatenate(c) for c in columns[:4]), b"".join(columns[4]))


def _tail(phrases: list[tuple], key: int) -> tuple:
    """The phrases, in ascending order of their keys, from this key on."""
    *columns, data = _joined(phrases)
    keys = int(np.searchsorted(columns[0], key))
    return (*(c[keys:] for c in columns), data[int(columns[3][:keys].sum()):])


def _later_strings(parts: DataFrame) -> DataFrame:
    """Intervals of strings that start earlier too. Equal strings share a key, so a task takes
    keys one after the other and sorts whenever it has gathered enough: phrases by the suffix
    array of their dictionary, strings of frequent triggers by their hashes."""

    def runs(rows: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.RecordBatch:
        rows, starts, ends = merged_runs(rows, starts, ends)
        return pa.record_batch({"row": pa.array(rows, pa.int64()),
                                "start": pa.array(starts, pa.int64()),
                                "length": pa.array((ends - starts).astype(np.int32))})

    def later(one, two, row, start) -> pa.RecordBatch:
        order, first = _firsts([one, two], row, start)
        again = order[~first]
        return runs(row[again], start[again], start[again] + WIDTH)

    def repeated(phrases: list[tuple], before: int | None = None) -> pa.RecordBatch:
        *columns, data = _joined(phrases)
        if before is not None:
            keys = int(np.searchsorted(columns[0], before))
            columns = [c[:keys] for c in columns]
            data = data[:int(columns[3].sum())]
        _, row, start, length = columns
        row, place, first = dictionary_order(data, length, row, start)
        return runs(row[~first], place[~first], place[~first] + WIDTH)

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        strings: list[tuple] = []  # key, both hashes, row and start of strings
        phrases: list[tuple] = []  # key, row, start, length and bytes of phrases
        for batch in batches:
            for at in range(0, batch.num_rows, DICTIONARY_ROWS):
                piece = batch.slice(at, DICTIONARY_ROWS)
                key, print_, row, start = (piece.column(i).to_numpy() for i in range(4))
                length = pc.fill_null(pc.binary_length(piece.column(4)), -1).to_numpy()
                alone, whole, settled = length < 0, length > 0, length == 0
                strings.append((key[alone], key[alone].view(U), print_[alone].view(U),
                                row[alone], start[alone]))
                phrases.append((key[whole], row[whole], start[whole], length[whole],
                                b"".join(filter(None, piece.column(4).to_pylist()))))
                if settled.any():
                    yield runs(row[settled], start[settled], start[settled] + print_[settled])
                # More rows of the last key may follow.
                if sum(len(h[0]) for h in strings) >= SORTED_AT_ONCE:
                    every = [np.concatenate(x) for x in zip(*strings)]
                    open_ = every[0] == key[-1]
                    yield later(*(x[~open_] for x in every[1:]))
                    strings = [tuple(x[open_] for x in every)]
                if sum(len(p[4]) for p in phrases) >= DICTIONARY_BYTES:
                    yield repeated(phrases, key[-1])
                    phrases = [_tail(phrases, key[-1])]
        if strings:
            yield later(*(np.concatenate(x) for x in list(zip(*strings))[1:]))
            yield repeated(phrases)

    return (parts.repartition("key").sortWithinPartitions("key")
            .mapInArrow(settle, "row bigint, start bigint, length int"))


def _later_ones(rows: DataFrame) -> DataFrame:
    """Rows with ``later``: another row of this key and print comes before it."""
    order = Window.partitionBy("key", "print").orderBy("row", "start")
    return rows.withColumn("later", (F.row_number().over(order) > 1)
                           & F.col("state").isin(PHRASE, FREQUENT_PHRASE))


_RESULT = ("doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, "
           "kept_sha256 string")


def _cut(rows: DataFrame, with_text: bool) -> DataFrame:
    """The texts without what their intervals cover."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 2):
            out = []
            columns = [batch.column(n).to_pylist() for n in ("doc_id", "text", "starts", "lengths")]
            for doc, text, places, lengths in zip(*columns):
                data = text.encode()
                places, lengths = np.array(places or [], np.int64), np.array(lengths or [],
                                                                            np.int64)
                _, at, until = merged_runs(np.zeros(len(places), np.int64), places,
                                           places + lengths)
                bounds = [0, *np.column_stack([at, until]).ravel().tolist(), len(data)]
                kept = b"".join(data[a:b] for a, b in zip(bounds[::2], bounds[1::2]))
                out.append((doc, len(data), len(data) - len(kept), len(at),
                            hashlib.sha256(kept).hexdigest(),
                            kept.decode(errors="ignore") if with_text else None))
            columns = list(zip(*out))
            kinds = [pa.int64()] * 4 + [pa.string()] * 2
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "text"]
            width = 6 if with_text else 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns[:width], kinds)], names=names[:width])

    return rows.mapInArrow(cut, _RESULT + (", text string" if with_text else ""))


def without_repeats(docs: DataFrame, with_text: bool = False) -> DataFrame:
    """Every row of ``docs(doc_id, text)`` after removal of each byte that a ``WIDTH``-byte
    string covers which also starts earlier: in a document with a smaller id, or before in
    this one. Strings are judged on the input and do not cross documents.

    Null texts are empty. Rows that share an id are documents of their own in the order of
    their texts; null ids come last. Further columns are ignored. ``with_text`` adds the text
    that is left, without characters of which a part was removed.
    """
    ship_code(docs.sparkSession)
    texts = numbered(docs)
    by_key = Window.partitionBy("key")
    frequent = ((F.max((F.col("state") == WITNESS).cast("int")).over(by_key) == 1)
                | (F.count(F.lit(1)).over(by_key) > GATHERED)
                | (F.col("state") == FREQUENT_PHRASE))
    contested = (F.min("print").over(by_key) != F.max("print").over(by_key)) | F.col("frequent")
    removed = F.col("later") | (F.col("state") == REMOVED)
    # By key first: the partitioning then serves the finer window too.
    judged = _phrases(texts).withColumn("frequent", frequent).withColumn("contested", contested)
    settled = _later_ones(judged).withColumn("removed", removed)
    phrases = written(
        settled.filter((F.col("state") != WITNESS) & (F.col("removed") | F.col("contested")))
        .select("row", "start", "length", "removed", "frequent",
                F.when(~F.col("removed"), F.col("key")).alias("key")), "phrases")
    # Both joins below read one shuffle of the texts, so they ask for the same columns.
    lists = [F.collect_list("start").alias("starts"), F.collect_list("length").alias("lengths")]
    to_check = phrases.filter(~F.col("removed")).groupBy("row").agg(
        *lists, F.collect_list("key").alias("keys"), F.collect_list("frequent").alias("frequent"))
    later = _later_strings(_contested_parts(texts.join(to_check, "row", "left")))
    gone = (phrases.filter("removed").select("row", "start", "length").union(later)
            .groupBy("row").agg(*lists))
    return _cut(texts.join(gone, "row", "left"), with_text)
