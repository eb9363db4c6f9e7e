import hashlib
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from riskloom.llm import pieces
from tests.llm.fixtures import awkward_rows, docs_frame, prose


@pytest.fixture(scope="module")
def coder():
    return pieces.PieceCoder()


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=pieces.default_path())


PARTS = ["a", "b", "the", " ", "  ", "    ", "\n", "▁", "é", "中", "国", "🙂", "\x00", "<s>",
         "<0x41>", "ing", "er", "1", "=", "\t", "ß", " the", "aaa", "----", "ÿ", "́"]


def texts(most):
    return st.lists(st.sampled_from(PARTS), max_size=most).map("".join)


@settings(max_examples=500, deadline=None)
@given(text=st.one_of(texts(30), st.text(max_size=30)))
def test_ids_and_text_are_the_library_s(coder, library, text):
    want = library.encode(text)
    got = coder.encode([text])[0]
    assert got.tolist() == want
    assert coder.decode(got) == library.decode(want)
    assert coder.model.decimal_list(got) == ",".join(map(str, want)).encode()


IDS = st.lists(st.one_of(st.sampled_from([0, 1, 2, 259, 28705]), st.integers(3, 258),
                         st.integers(190, 258), st.integers(0, 31999)), max_size=8)


@settings(max_examples=500, deadline=None)
@given(ids=IDS)
def test_any_ids_decode_as_in_the_library(coder, library, ids):
    assert coder.decode(np.array(ids, np.int64)) == library.decode(ids)


@pytest.mark.parametrize("text", [
    "abcdefghijklmnop" * 2000, " " * 3000, "a" * 5001, "x" + " " * 777 + "y", "=-" * 900,
    prose(1, 400).replace(" ", ""), prose(2, 3000), "\n\n\n  \t" * 50])
def test_long_words_and_runs(coder, library, text):
    assert coder.encode([text])[0].tolist() == library.encode(text)


@settings(max_examples=100, deadline=None)
@given(text=texts(40))
def test_merges_at_once_are_those_one_after_the_other(coder, text):
    model = coder.model
    signs = np.frombuffer(text.replace(" ", "▁").encode("utf-32-le"), "<u4").astype(np.int64)
    symbols = np.array([model.symbols.get(chr(c), -1 - c) for c in signs.tolist()], np.int64)
    first = np.arange(len(symbols)) == 0
    assert model.merge(symbols, first)[0].tolist() == model._one_by_one(symbols.tolist())


def test_forgetting_changes_nothing(monkeypatch, library):
    monkeypatch.setattr(pieces, "REMEMBERED", 4)
    monkeypatch.setattr(pieces, "LONGEST", 6)
    small = pieces.PieceCoder()
    found = ["a b c d e", "e d c b a longer-word", "g h longer-word  i", None, ""]
    for _ in range(2):
        assert [i.tolist() for i in small.encode(found)] == [library.encode(t or "") for t in found]
        assert all(len(w) <= 6 for w in small.known)


def test_models_of_another_kind_are_refused(tmp_path):
    path = tmp_path / "other.model"
    path.write_bytes(b"\x12\x02\x18\x01")  # a trainer's part that names another model type
    with pytest.raises(ValueError):
        pieces.PieceModel(str(path))


@pytest.mark.parametrize("rows", [awkward_rows(), []])
def test_digest_of_awkward_rows(spark, library, rows):
    def sha(text):
        return hashlib.sha256(text.encode()).hexdigest()

    want = Counter()
    for doc, text in rows:
        ids = library.encode(text or "")
        want[(doc, len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids)))] += 1
    got = pieces.piece_digest(docs_frame(spark, rows))
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert Counter(map(tuple, got.collect())) == want


def test_texts_come_back(spark, library):
    rows = [(i, t) for i, (d, t) in enumerate(awkward_rows())]
    ids = pieces.encode_texts(docs_frame(spark, rows))
    assert {r.doc_id: r.ids for r in ids.collect()} == {d: library.encode(t or "") for d, t in rows}
    back = pieces.decode_ids(ids)
    assert {r.doc_id: r.text for r in back.collect()} == {d: t or "" for d, t in rows}
    empty = spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>")
    assert {r.text for r in pieces.decode_ids(empty).collect()} == {""}
