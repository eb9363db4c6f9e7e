import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from riskloom.llm import packing, token_files, tokens
from tests.llm.fixtures import awkward_rows, docs_frame


@pytest.fixture(scope="module")
def encoder():
    return tokens.Encoder()


# The library itself, as it comes from the file.
LIBRARY = Tokenizer.from_file(tokens.default_path())


def ids_of(encoder, text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids + [0]


def test_added_tokens_are_those_of_the_library(encoder):
    for text in ("a<|endoftext|>b", " <|endoftext|> a b", "a b <|endoftext|>"):
        assert encoder.encode([text])[0].tolist() == ids_of(encoder, text)
    assert 50256 in ids_of(encoder, "a<|endoftext|>b")


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@settings(max_examples=300, deadline=None)
@given(text=st.text(st.sampled_from(" \n\t\x1c.,'a bé1²_<|endoftext|>sü中🙂́ "), max_size=40))
def test_ids_are_those_of_the_whole_text(encoder, text):
    assert encoder.encode([text])[0].tolist() == ids_of(encoder, text)


def test_forgetting_changes_nothing(monkeypatch):
    monkeypatch.setattr(tokens, "REMEMBERED", 4)
    small, texts = tokens.Encoder(), ["a b c d e f", "f e d c b a g", "a b, c", "g h i j k"]
    for text in texts * 2:
        assert small.encode([text])[0].tolist() == ids_of(small, text)


@settings(max_examples=500, deadline=None)
@given(texts=st.lists(st.lists(st.sampled_from(
    [" ", "  ", "\n", "\r\n", "\t", "\x0b", "\x1c", "\x85", "\xa0", "\u3000", "'", "'s", "'ll", ".", "..",
     ", ", "_", "0", "12", "²", "a", "ab", "The", "é", "×", "÷", "Ã", "ж", "中", "🙂", "\u0301", "\x00",
     "<|endoftext|>"]), max_size=12).map("".join), max_size=5))
def test_ids_of_a_batch_are_those_of_each_text(encoder, texts):
    wanted = [ids_of(encoder, text) for text in texts]
    assert [ids.tolist() for ids in encoder.encode(texts)] == wanted
    column = pa.chunked_array([["x y"], ["a " + t for t in texts] + ["b"]], pa.string())
    part = column.chunk(1).slice(0, len(texts))
    assert ([ids.tolist() for ids in encoder.encode(part)]
            == [ids_of(encoder, "a " + text) for text in texts])


def test_a_word_goes_to_the_tokenizer_once_whatever_follows_it(monkeypatch):
    fresh, given = tokens.Encoder(), []
    library = fresh._ids
    monkeypatch.setattr(fresh, "_ids", lambda texts: given.extend(texts) or library(texts))
    texts = ["a zeppelin, a zeppelin. A zeppelin", "no zeppelin: zeppelin\nzeppelin", "a zeppelin"]
    for text in texts:
        assert fresh.encode([text])[0].tolist() == ids_of(fresh, text)
    assert "".join(given).count(" zeppelin") == 1


def test_what_a_worker_remembers_is_bounded(monkeypatch):
    monkeypatch.setattr(tokens, "REMEMBERED", 100)
    fresh = tokens.Encoder()
    text = " ".join(f"{'abc'[i % 3] * (i // 3 + 1)}x" for i in range(600))
    for _ in range(2):
        assert fresh.encode([text])[0].tolist() == ids_of(fresh, text)
    assert len(fresh.young) + len(fresh.old) <= 150
    assert max(map(len, [*fresh.young, *fresh.old])) <= tokens.REMEMBERED_CHARS
    assert tokens.REMEMBERED <= 200_000


@pytest.mark.parametrize("rows", [awkward_rows(), []])
def test_token_files_hold_every_document(spark, encoder, rows):
    got = token_files.token_digest(docs_frame(spark, rows)).collect()
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    start, want = 0, []
    for doc, text in order:
        ids = ids_of(encoder, text)
        want.append((doc, start, len(ids), crc(ids)))
        start += len(ids)
    assert Counter(tuple(r) for r in got) == Counter(want)


def test_token_files_are_equal_sequences_with_masks(tmp_path, monkeypatch):
    monkeypatch.setattr(token_files, "BATCH", 2)
    out = token_files.SequenceWriter(str(tmp_path / "a.arrow"), np.dtype("<u2"), 8)
    runs = [np.arange(n, dtype="<u2") for n in (3, 0, 30, 7, 1)]
    for run in runs:
        out.add(run)
    out.close()
    reader = token_files.SequenceReader(str(tmp_path / "a.arrow"))
    every = np.concatenate(runs)
    ids, masks = zip(*(reader.sequences(b) for b in range(reader.file.num_record_batches)))
    flat = np.concatenate([i.ravel() for i in ids])
    mask = np.concatenate([m.ravel() for m in masks])
    assert len(flat) % 8 == 0 and (flat[mask] == every).all() and mask.sum() == len(every)
    at = 0
    for run in runs:
        assert reader.ids(at, len(run)).tolist() == run.tolist()
        at += len(run)


def check_packing(rows, encoder, got):
    by_sequence, pieces = defaultdict(list), Counter()
    for r in got:
        by_sequence[r.sequence_id].append(r)
        pieces[(r.doc_id, r.piece, r.start, r.length, r.ids_crc32)] += 1
    want = Counter()
    for doc, text in rows:
        ids = ids_of(encoder, text)
        for k, (start, length) in enumerate(packing.cut_points(len(ids))):
            want[(doc, k, start, length, crc(ids[start:start + length]))] += 1
    assert pieces == want
    for parts in by_sequence.values():
        at = 0
        for r in sorted(parts, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= packing.CAPACITY
    return len(by_sequence), sum(r.length for r in got)


@pytest.mark.parametrize("rows", [awkward_rows(), []])
def test_every_piece_is_packed_once(spark, encoder, rows):
    check_packing(rows, encoder, packing.pack(docs_frame(spark, rows)).collect())


def test_packing_of_several_shards_is_tight(spark, encoder, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    got = packing.pack(docs, shard_items=40).collect()
    sequences, ids = check_packing(rows, encoder, got)
    assert sequences <= 1.02 * ids / packing.CAPACITY + 1


@pytest.mark.parametrize("n, points", [
    (1, [(0, 1)]), (2048, [(0, 2048)]), (2049, [(0, 1), (1, 2048)]),
    (5000, [(0, 904), (904, 2048), (2952, 2048)])])
def test_only_the_first_piece_is_shorter(n, points):
    assert packing.cut_points(n) == points


def test_breeding_keeps_every_piece_and_never_gets_worse():
    random = np.random.default_rng(3)
    shard = packing.Shard(random.integers(1, 100, 300), 100, random)
    first = shard.first_packings(4)
    best = shard.evolve(first, 10, 4)[0]
    for packed in [*first, best, shard.cross(first[0], first[1]), shard.mutate(best)]:
        assert (packed >= 0).all() and shard.fills(packed).max() <= 100
        assert shard.fills(packed).min() > 0
    assert shard.fitness(best) >= max(map(shard.fitness, first))
    assert -shard.fitness(best)[0] <= 1.03 * shard.least
