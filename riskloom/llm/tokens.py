"""Token ids of whole texts from a public tokenizer file.

A byte-level tokenizer cuts a text into words before it looks for merges. A word always begins
with a space that a letter or digit follows, behind the last of some letters, where letters
follow a mark (but for an apostrophe) or digit, and with the white space behind these. So a
batch of texts may be cut there, column-wise, and each distinct piece looked up among the pieces
met before; only new ones go to the tokenizer's model. The ids are those of the whole text.
Files of another kind, and texts in which an added token is spelled out, are encoded whole.
"""

from __future__ import annotations

import json
import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Pieces remembered by each Python worker, which keeps them from task to task; the older half
#: is forgotten first. Longer pieces than ``REMEMBERED_CHARS`` are not remembered, so that the
#: number bounds the memory.
REMEMBERED = 200_000
REMEMBERED_CHARS = 64
END_ID = 0

_ASCII = [chr(c) if c < 128 else "" for c in range(256)]
_ALNUM = np.array([c.isalnum() for c in _ASCII])
_LETTER = np.array([c.isalpha() for c in _ASCII])
_BLANK = np.array([c != "" and c in " \t\n\v\f\r" for c in _ASCII])
#: Marks and digits. What Python, but not the tokenizer, takes for white space is none.
_MARK = np.array([c != "" and not c.isspace() for c in _ASCII]) & ~_LETTER
_OTHER = _MARK | _BLANK
_SPACE, _APOSTROPHE = ord(" "), ord("'")
#: First byte of the letters from U+00C0 to U+00FF, and the second one of those that are signs.
_LATIN, _SIGNS = 0xC3, (0x97, 0xB7)
#: Words in one text for the tokenizer, and such texts at a time: it is slower on long texts.
_AT_ONCE = 100
_CALLS = 64


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _cuts_words_at_spaces(path: str) -> bool:
    with open(path, encoding="utf-8") as file:
        parts = json.load(file)
    cutter = parts.get("pre_tokenizer") or {}
    return (parts["model"].get("type") == "BPE" and cutter.get("type") == "ByteLevel"
            and not parts.get("normalizer") and not cutter.get("add_prefix_space", True)
            and cutter.get("use_regex", True))


class Encoder:
    """Encodes texts to little-endian unsigned 16- or 32-bit ids."""

    def __init__(self, path: str | None = None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        path = path or default_path()
        self.tokenizer = Tokenizer.from_file(path)
        # The library looks for added tokens before it cuts words, so texts that spell one
        # out go to it whole.
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.added = added
        words = [t for t in added if not t.strip() or t.strip().isalnum()]
        self.added_words = re.compile("|".join(map(re.escape, words))) if words else None
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.by_piece = _cuts_words_at_spaces(path)
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        names = self.tokenizer.get_vocab()
        #: Of a space and of a line end, the tokens that begin with it.
        self.opens = {}
        for first in " \n" if self.by_piece else "":
            name = self.tokenizer.encode(first, add_special_tokens=False).tokens[0] if names else ""
            opens = self.opens[first] = np.zeros(max(names.values(), default=0) + 1, bool)
            opens[[i for x, i in names.items() if x.startswith(name)]] = True

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, self.dtype) for e in found]

    def _words(self, words: list[str], first: str) -> list[bytes]:
        """Ids of words that begin with ``first``, a letter or digit behind it, and have no other."""
        opens, codes = self.opens[first], []
        for start in range(0, len(words), _AT_ONCE * _CALLS):
            some = words[start:start + _AT_ONCE * _CALLS]
            ids = np.concatenate(self._ids(["".join(some[i:i + _AT_ONCE])
                                            for i in range(0, len(some), _AT_ONCE)]))
            # A token that begins so begins a word, and nothing else does.
            bounds = (np.append(np.flatnonzero(opens[ids]), len(ids))
                      * ids.itemsize).tolist()
            if len(bounds) != len(some) + 1:
                raise ValueError("the tokenizer joins words over white space")
            code = ids.tobytes()
            codes += [code[i:j] for i, j in zip(bounds, bounds[1:])]
        return codes

    def _look_up(self, pieces: list[str]) -> list[bytes]:
        """The ids of distinct pieces."""
        if len(self.young) > REMEMBERED // 2:
            self.old, self.young = self.young, {}
        young, old = self.young, self.old
        codes = list(map(young.get, pieces))
        words: dict[str, list[int]] = {" ": [], "\n": [], "": []}
        for i in [i for i, code in enumerate(codes) if code is None]:
            piece = pieces[i]
            if (code := old.get(piece)) is not None:
                codes[i] = young[piece] = code
            elif (piece[0] in words and piece[1:].isalnum()
                  and not (self.added_words and self.added_words.search(piece))):
                words[piece[0]].append(i)
            else:
                words[""].append(i)
        others = words.pop("")
        found = [ids.tobytes() for ids in self._ids([pieces[i] for i in others])]
        for first, places in words.items():
            found += self._words([pieces[i] for i in places], first)
            others += places
        for i, code in zip(others, found):
            codes[i] = code
            if len(pieces[i]) <= REMEMBERED_CHARS:
                if len(young) > REMEMBERED // 2:
                    self.old, self.young = young, {}
                    young = self.young
                young[pieces[i]] = code
        return codes

    def _cut(self, texts: pa.LargeStringArray) -> tuple[pa.LargeStringArray, np.ndarray]:
        """The pieces of all texts, and the number of the first one of each text."""
        _, bounds, data = texts.buffers()
        bounds = np.frombuffer(bounds, np.int64)[texts.offset:texts.offset + len(texts) + 1]
        data = np.frombuffer(data or b"", np.uint8)[bounds[0]:bounds[-1]]
        bounds = bounds - bounds[0]
        begins = np.zeros(len(data) + 1, bool)
        before, after = data[:-1], data[1:]
        spaces = np.flatnonzero(before == _SPACE)
        begins[spaces[_ALNUM[data[spaces + 1]]]] = True
        foreign = spaces[data[spaces + 1] >= 0xC0]
        begins[foreign[_alnum(data, foreign + 1)]] = True
        letters = _LETTER[data]
        latin = np.flatnonzero(before == _LATIN)
        latin = latin[~np.isin(data[latin + 1], _SIGNS)]
        marks = _MARK[data]
        begins[1:-1] |= marks[:-1] & _BLANK[after]
        marks &= data != _APOSTROPHE
        letters[latin] = True
        begins[1:-1] |= marks[:-1] & letters[1:]
        letters[latin] = False
        letters[latin + 1] = True
        begins[1:-1] |= letters[:-1] & _OTHER[after]
        filled = np.flatnonzero(np.diff(bounds))
        # A space that ends a text begins no word of the next one.
        ends = bounds[filled + 1] - 1
        begins[ends[data[ends] == _SPACE]] = False
        for added in self.added:
            for i in np.flatnonzero(pc.match_substring(texts, added).to_numpy(False)):
                begins[bounds[i]:bounds[i + 1]] = False
        begins[bounds[filled]] = True
        begins[-1] = True
        starts = np.flatnonzero(begins)
        pieces = pa.LargeStringArray.from_buffers(
            len(starts) - 1, pa.py_buffer(starts.astype(np.int64)), pa.py_buffer(data))
        return pieces, np.searchsorted(starts, bounds)

    def encode(self, texts: list[str | None] | pa.Array, end: int | None = END_ID
               ) -> list[np.ndarray]:
        """The ids of each text, followed by ``end`` if that is given. None is an empty text."""
        tail = b"" if end is None else np.array([end], self.dtype).tobytes()
        texts = (texts if isinstance(texts, pa.Array) else pa.array(texts, pa.large_string())
                 ).cast(pa.large_string()).fill_null("")
        if not len(texts):
            return []
        if not self.by_piece:
            codes = [ids.tobytes() for ids in self._ids(texts.to_pylist())]
        else:
            pieces, firsts = self._cut(texts)
            distinct = pieces.dictionary_encode()
            found = pa.array(self._look_up(distinct.dictionary.to_numpy(False).tolist()), pa.large_binary())
            _, bounds, data = found.take(distinct.indices).buffers()
            bounds = np.frombuffer(bounds, np.int64)[firsts].tolist()
            data = memoryview(data or b"")
            codes = [bytes(data[i:j]) for i, j in zip(bounds, bounds[1:])]
        return [np.frombuffer(code + tail, self.dtype) for code in codes]


def _alnum(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether the UTF-8 characters of several bytes that begin at these places are letters or
    digits."""
    lead, *rest = (np.take(data, at + i, mode="clip").astype(np.int32) for i in range(4))
    one, two, three = (x & 0x3F for x in rest)
    point = np.where(lead < 0xE0, (lead & 0x1F) << 6 | one,
                     np.where(lead < 0xF0, (lead & 0x0F) << 12 | one << 6 | two,
                              (lead & 0x07) << 18 | one << 12 | two << 6 | three))
    points, which = np.unique(point, return_inverse=True)
    return np.array([chr(p).isalnum() for p in points.tolist()], bool)[which]


_ENCODERS: dict[str | None, Encoder] = {}


def encoder(path: str | None = None) -> Encoder:
    """The worker's own encoder: the file is read once."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]
