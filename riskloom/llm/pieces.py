"""SentencePiece encoding and decoding by vectorised merge rounds.

The words of a batch that were not met before lie in one flat array of symbols. In each round
every segment finds the least rank among its pairs, all its pairs of that rank are merged from
the left at once, and the array is compacted; segments without a pair to merge leave it. No
piece has a space mark behind another sign, and some signs never stand side by side in any
piece, so segments end at such places without changing the ids.

Merging at once equals merging one after the other as long as no merge makes a pair of as good
a rank. Segments in which one does (runs of spaces, whose pieces all rank alike) are finished
one merge at a time.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from riskloom.llm.common import ship_code, slices, text_of

#: Words remembered by each Python worker, none of them longer than LONGEST signs; when the
#: table is full it starts anew.
REMEMBERED = 600_000
LONGEST = 200
#: Signs of new words that go through the rounds together.
AT_ONCE = 1 << 20

# The format's space mark, piece types, model type and default unknown surface.
MARK = "▁"
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
BPE = 2
UNKNOWN_SURFACE = " ⁇ "

_NONE = np.iinfo(np.int64).max
_WORD = re.compile(" +[^ ]*")


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field numbers and values of a serialised protocol buffer message."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = number()
        kind = key & 7
        if kind == 0:
            yield key >> 3, number()
            continue
        size = {1: 8, 5: 4}.get(kind) or number()
        yield key >> 3, data[at:at + size]
        at += size


def _one_byte(error: UnicodeDecodeError) -> tuple[str, int]:
    return "�", error.start + 1


codecs.register_error("riskloom_one_byte", _one_byte)


class PieceModel:
    """Pieces, merge ranks and surfaces of a BPE model file with byte fallback.

    The text must reach the merges as it is but for the space mark: a model that folds
    characters, drops spaces, or has pieces of the user's own is refused.
    """

    def __init__(self, path: str | None = None):
        with open(path or default_path(), "rb") as file:
            message = list(_fields(file.read()))
        self.pieces: list[str] = []
        scores, kinds = [], []
        for field, value in message:
            if field == 1:
                piece = dict(_fields(value))
                self.pieces.append(piece.get(1, b"").decode())
                scores.append(struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0)
                kinds.append(piece.get(3, NORMAL))
        trainer = dict(_fields(next((v for f, v in message if f == 2), b"")))
        normalizer = dict(_fields(next((v for f, v in message if f == 3), b"")))
        if trainer.get(3, 1) != BPE:
            raise ValueError("not a BPE model")
        if (normalizer.get(2) or not normalizer.get(5, 1) or normalizer.get(4, 1)
                or trainer.get(24, 0) or {USER_DEFINED, UNUSED} & set(kinds)):
            raise ValueError("a model that changes texts or has user-defined pieces")
        self.prefix = " " if normalizer.get(3, 1) else ""
        unknown = trainer.get(44, UNKNOWN_SURFACE.encode())
        self.unknown_id = kinds.index(UNKNOWN)
        normal = {p: i for i, p in enumerate(self.pieces) if kinds[i] == NORMAL}
        self._read_symbols(normal)
        self._read_pairs(normal, scores)
        self._read_outputs(kinds)
        self.by_word = not any(MARK in p.lstrip(MARK) for p in normal)
        self.surfaces = [
            bytes([int(p[3:5], 16)]) if k == BYTE else b"" if k == CONTROL else
            unknown if k == UNKNOWN else p.replace(MARK, " ").encode()
            for p, k in zip(self.pieces, kinds)]
        self.begins = np.array([k == NORMAL and p.startswith(MARK)
                                for p, k in zip(self.pieces, kinds)])
        self.controls = np.array([k == CONTROL for k in kinds])
        self.dtype = np.dtype("<u2" if len(self.pieces) <= 1 << 16 else "<u4")
        width = len(str(len(self.pieces))) + 1
        self.decimals = np.zeros((len(self.pieces), width), np.uint8)
        for i in range(len(self.pieces)):
            text = f"{i},".encode()
            self.decimals[i, :len(text)] = np.frombuffer(text, np.uint8)

    def _read_symbols(self, normal: dict[str, int]) -> None:
        """A number for each piece and for each sign that occurs inside a piece."""
        signs = sorted({c for p in normal for c in p})
        self.symbols = dict(normal)
        for sign in signs:
            self.symbols.setdefault(sign, len(self.pieces) + len(self.symbols) - len(normal))
        self.signs = np.array([ord(c) for c in signs], np.int64)
        self.sign_symbols = np.array([self.symbols[c] for c in signs], np.int64)
        self.limit = len(self.pieces) + len(self.symbols)

    def _read_pairs(self, normal: dict[str, int], scores: list[float]) -> None:
        """Rank and result of every pair of symbols that makes a piece; less is better."""
        order = {s: r for r, s in enumerate(sorted({scores[i] for i in normal.values()},
                                                   reverse=True))}
        found, beside = {}, set()
        for piece, i in normal.items():
            for cut in range(1, len(piece)):
                left, right = (self.symbols.get(p) for p in (piece[:cut], piece[cut:]))
                if left is not None and right is not None:
                    found[left * self.limit + right] = (order[scores[i]], i)
                beside.add(ord(piece[cut - 1]) << 32 | ord(piece[cut]))
        self.pairs = np.array(sorted(found), np.int64)
        values = np.array([found[k] for k in self.pairs.tolist()], np.int64).reshape(-1, 2)
        self.ranks, self.results = values[:, 0].copy(), values[:, 1].copy()
        self.beside = np.array(sorted(beside), np.int64)

    def _read_outputs(self, kinds: list[int]) -> None:
        self.byte_ids = np.full(256, -1, np.int64)
        for i, kind in enumerate(kinds):
            if kind == BYTE:
                self.byte_ids[int(self.pieces[i][3:5], 16)] = i
        self.falls_back = bool((self.byte_ids >= 0).all())

    # -- encoding --------------------------------------------------------------

    def _lookup(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and result of each pair; the rank of no pair is _NONE."""
        if not len(self.pairs):
            return np.full(len(left), _NONE), np.zeros(len(left), np.int64)
        key = left * self.limit + right
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        known = (self.pairs[at] == key) & (left >= 0) & (right >= 0)
        return np.where(known, self.ranks[at], _NONE), self.results[at]

    def _one_by_one(self, symbols: list[int]) -> list[int]:
        """The best pair first, of equals the leftmost, until none is left."""
        after = list(range(1, len(symbols) + 1))
        before = list(range(-1, len(symbols) - 1))
        gone = [False] * len(symbols)
        heap: list[tuple[int, int, int, int, int]] = []

        def offer(lefts: list[int]) -> None:
            lefts = [i for i in lefts if i >= 0 and after[i] < len(symbols)]
            one, two = ([symbols[i] for i in lefts], [symbols[after[i]] for i in lefts])
            ranks, results = self._lookup(np.array(one, np.int64), np.array(two, np.int64))
            for i, a, b, rank, made in zip(lefts, one, two, ranks.tolist(), results.tolist()):
                if rank != _NONE:
                    heapq.heappush(heap, (rank, i, a, b, made))

        offer(list(range(len(symbols) - 1)))
        while heap:
            _, i, a, b, made = heapq.heappop(heap)
            j = after[i]
            if gone[i] or j >= len(symbols) or symbols[i] != a or symbols[j] != b:
                continue
            symbols[i], gone[j] = made, True
            after[i] = after[j]
            if after[i] < len(symbols):
                before[after[i]] = i
            offer([before[i], i])
        return [s for s, dead in zip(symbols, gone) if not dead]

    def merge(self, symbols: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols after all merges and the places at which they began.

        ``first`` marks the symbols that begin a segment; no merge crosses into one.
        """
        place = np.arange(len(symbols))
        done_symbols, done_places = [], []
        rank, made = self._pair_ranks(symbols, first, np.arange(len(symbols)))
        while len(symbols):
            starts = np.flatnonzero(first)
            segment = np.cumsum(first) - 1
            best = np.minimum.reduceat(rank, starts)
            # Compaction: segments that are finished leave the arrays.
            live = (best != _NONE)[segment]
            if not live.all():
                done_symbols.append(symbols[~live])
                done_places.append(place[~live])
                symbols, first, rank, made, place = (
                    x[live] for x in (symbols, first, rank, made, place))
                continue
            # Of pairs that overlap every other one is taken, beginning from the left.
            wanted = np.flatnonzero(rank == best[segment])
            run = np.ones(len(wanted), bool)
            run[1:] = wanted[1:] != wanted[:-1] + 1
            turn = np.arange(len(wanted))
            turn -= np.maximum.accumulate(np.where(run, turn, 0))
            taken = wanted[turn % 2 == 0]
            least = best[segment[taken]]
            # A pair of the new symbol with what still follows it, seen one after the other.
            follows = np.minimum(taken + 2, len(symbols) - 1)
            beyond = (taken + 2 < len(symbols)) & (segment[follows] == segment[taken])
            early = np.where(beyond, self._lookup(made[taken], symbols[follows])[0], _NONE)
            merged = symbols.copy()
            merged[taken] = made[taken]
            keep = np.ones(len(symbols), bool)
            keep[taken + 1] = False
            at = (np.cumsum(keep) - 1)[taken]
            now, now_first = merged[keep], first[keep]
            now_rank, now_made = rank[keep], made[keep]
            touched = np.unique(np.concatenate([at, at[at > 0] - 1]))
            now_rank[touched], now_made[touched] = self._pair_ranks(now, now_first, touched)
            behind = np.where((at > 0) & ~now_first[at], now_rank[at - 1], _NONE)
            several = np.bincount(segment[taken], minlength=len(starts))[segment[taken]] > 1
            unsafe = several & ((early <= least) | (now_rank[at] <= least) | (behind <= least))
            if unsafe.any():
                ends = np.append(starts[1:], len(symbols))
                for s in np.unique(segment[taken[unsafe]]).tolist():
                    whole = slice(starts[s], ends[s])
                    left = self._one_by_one(symbols[whole].tolist())
                    done_symbols.append(np.array(left, np.int64))
                    # Only the order within the segment matters from here on.
                    done_places.append(place[whole][:len(left)])
                stays = ~np.isin(segment, segment[taken[unsafe]])[keep]
                now, now_first, now_rank, now_made = (
                    x[stays] for x in (now, now_first, now_rank, now_made))
                place = place[keep][stays]
            else:
                place = place[keep]
            symbols, first, rank, made = now, now_first, now_rank, now_made
        every = np.concatenate([*done_places, np.zeros(0, np.int64)])
        order = np.argsort(every, kind="stable")
        return np.concatenate([*done_symbols, np.zeros(0, np.int64)])[order], every[order]

    def _pair_ranks(self, symbols: np.ndarray, first: np.ndarray,
                    at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of the pairs of the symbols at some places with their successors."""
        inner = at + 1 < len(symbols)
        following = np.minimum(at + 1, len(symbols) - 1)
        rank, made = self._lookup(symbols[at], symbols[following])
        return np.where(inner & ~first[following], rank, _NONE), made

    def words(self, words: list[str]) -> list[bytes]:
        """The ids of each word, which holds space marks instead of spaces, as ``dtype``."""
        signs = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").astype(np.int64)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        word = np.repeat(np.arange(len(words)), sizes)
        if not len(signs):
            return [b""] * len(words)
        at = np.minimum(np.searchsorted(self.signs, signs), len(self.signs) - 1)
        # A sign that no piece holds is its own negative number.
        symbols = np.where(self.signs[at] == signs, self.sign_symbols[at], -1 - signs)
        first = np.ones(len(signs), bool)
        if len(self.beside):
            near = signs[:-1] << 32 | signs[1:]
            spot = np.minimum(np.searchsorted(self.beside, near), len(self.beside) - 1)
            first[1:] = (word[1:] != word[:-1]) | (self.beside[spot] != near)
        symbols, places = self.merge(symbols, first)
        ids, counts = self._ids(symbols, signs, places)
        owner = np.repeat(word[places], counts)
        ends = np.searchsorted(owner, np.arange(len(words) + 1)) * self.dtype.itemsize
        code, ends = ids.astype(self.dtype).tobytes(), ends.tolist()
        return [code[i:j] for i, j in zip(ends, ends[1:])]

    def _ids(self, symbols: np.ndarray, signs: np.ndarray,
             places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of symbols, and how many each has: signs without a piece become bytes."""
        counts = np.ones(len(symbols), np.int64)
        strange = np.flatnonzero((symbols < 0) | (symbols >= len(self.pieces)))
        if not len(strange):
            return symbols, counts
        if not self.falls_back:
            ids = symbols.copy()
            ids[strange] = self.unknown_id
            return ids, counts
        codes = [chr(c).encode() for c in signs[places[strange]].tolist()]
        counts[strange] = list(map(len, codes))
        ids = np.repeat(symbols, counts)
        filled = np.repeat(np.isin(np.arange(len(symbols)), strange), counts)
        ids[filled] = self.byte_ids[np.frombuffer(b"".join(codes), np.uint8)]
        return ids, counts

    # -- decoding --------------------------------------------------------------

    def decode(self, ids: np.ndarray) -> str:
        """The text of the ids. Bytes that are not UTF-8 become U+FFFD, one each."""
        breaks = np.flatnonzero(self.controls[ids])
        if len(breaks):
            # Bytes on either side of a control piece are no character together.
            return self._decode_parts(ids, breaks)
        text = b"".join(map(self.surfaces.__getitem__, ids.tolist()))
        if self.prefix and len(ids):
            # The first piece that shows loses the space that encoding put before the text.
            shown = next((i for i in ids.tolist() if self.surfaces[i]), None)
            if shown is not None and self.begins[shown]:
                text = text[1:]
        return text.decode("utf-8", "riskloom_one_byte")

    def _decode_parts(self, ids: np.ndarray, breaks: np.ndarray) -> str:
        parts = [p[~self.controls[p]] for p in np.split(ids, breaks)]
        text, parts = "", [p for p in parts if len(p)]
        for i, part in enumerate(parts):
            found = self.decode(part)
            # Only the first part loses the leading space.
            text += " " + found if i and self.prefix and self.begins[part[0]] else found
        return text

    def decimal_list(self, ids: np.ndarray) -> bytes:
        """The ids in decimal, joined by commas."""
        digits = self.decimals[ids].ravel()
        return digits[digits != 0].tobytes()[:-1]


class PieceCoder:
    """Encodes whole texts; ids of words are remembered from text to text."""

    def __init__(self, path: str | None = None):
        self.model = PieceModel(path)
        self.known: dict[str, bytes] = {}

    def _learn(self, words: set[str]) -> dict[str, bytes]:
        """Ids of all these words; only short ones are remembered."""
        known = self.known
        new = [w for w in words if w not in known]
        if not new:
            return known
        if len(known) + len(new) > REMEMBERED:
            kept = {w: known[w] for w in words if w in known}
            known = self.known = {}
        else:
            kept = known
        found: dict[str, bytes] = {}
        new.sort(key=len)
        start = 0
        while start < len(new):
            stop, signs = start, 0
            while stop < len(new) and (stop == start or signs + len(new[stop]) <= AT_ONCE):
                signs += len(new[stop])
                stop += 1
            some = new[start:stop]
            ids = self.model.words([w.replace(" ", MARK) for w in some])
            found.update(zip(some, ids))
            start = stop
        known.update((w, i) for w, i in found.items() if len(w) <= LONGEST)
        if kept is known and len(new[-1]) <= LONGEST:
            return known
        return {**kept, **found}

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """The ids of each text. None is an empty text, and an empty text has no ids."""
        cut = []
        for text in texts:
            if not text:
                cut.append([])
                continue
            text = self.model.prefix + text.replace(MARK, " ")
            if not self.model.by_word:
                cut.append([text])
                continue
            head = 0 if text[0] == " " else len(text.split(" ", 1)[0])
            cut.append(([text[:head]] if head else []) + _WORD.findall(text, head))
        known = self._learn(set().union(*cut)).__getitem__
        return [np.frombuffer(b"".join(map(known, words)), self.model.dtype) for words in cut]

    def decode(self, ids: np.ndarray) -> str:
        return self.model.decode(ids)


_CODERS: dict[str | None, PieceCoder] = {}


def coder(path: str | None = None) -> PieceCoder:
    """The worker's own coder: the model file is read once."""
    if path not in _CODERS:
        _CODERS[path] = PieceCoder(path)
    return _CODERS[path]


def encode_texts(docs: DataFrame, model: str | None = None) -> DataFrame:
    """``doc_id`` and ``ids``, the ids of each whole ``text``; a null text has none."""
    ship_code(docs.sparkSession)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = coder(model).encode(batch.column(1).to_pylist())
            sizes = np.cumsum([0, *map(len, found)])
            values = np.concatenate([*found, np.zeros(0, np.int32)]).astype(np.int32)
            yield pa.record_batch({
                "doc_id": batch.column(0),
                "ids": pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pa.array(values))})

    return docs.select("doc_id", text_of().alias("text")).mapInArrow(
        encode, "doc_id bigint, ids array<int>")


def decode_ids(rows: DataFrame, model: str | None = None) -> DataFrame:
    """``doc_id`` and ``text``, the text of each row's ``ids``; no ids, or null, give none."""
    ship_code(rows.sparkSession)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = [coder(model).decode(np.array(ids or [], np.int64))
                     for ids in batch.column(1).to_pylist()]
            yield pa.record_batch({"doc_id": batch.column(0), "text": pa.array(texts, pa.string())})

    return rows.select("doc_id", "ids").mapInArrow(decode, "doc_id bigint, text string")


def piece_digest(docs: DataFrame, model: str | None = None) -> DataFrame:
    """Number and SHA-256 of each document's ids, and SHA-256 of the text decoded from them.

    One row for each row of ``docs``, repeated or null ids included. Null and empty texts have
    no ids. The ids travel no further than the task that made them, and nothing is shuffled.
    """
    ship_code(docs.sparkSession)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            work = coder(model)
            found = work.encode(batch.column(1).to_pylist())
            yield pa.record_batch({
                "doc_id": batch.column(0),
                "n_tokens": pa.array([len(i) for i in found], pa.int64()),
                "ids_sha256": pa.array(
                    [hashlib.sha256(work.model.decimal_list(i)).hexdigest() for i in found]),
                "decoded_sha256": pa.array(
                    [hashlib.sha256(work.decode(i).encode()).hexdigest() for i in found])})

    return docs.select("doc_id", text_of().alias("text")).mapInArrow(
        digest, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
