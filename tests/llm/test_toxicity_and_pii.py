import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from riskloom.llm import pii, toxicity
from tests.llm.fixtures import awkward_rows, docs_frame


# -- toxicity ----------------------------------------------------------------------

def test_pairs_of_terms_count_together():
    """Neither word alone tells; only both together are toxic."""
    rnd = np.random.default_rng(5)
    texts, toxic = [], []
    for _ in range(1500):
        a, b = (rnd.random(2) < .5).tolist()
        texts.append(" ".join(["filler"] * 3 + ["insult"] * a + ["group"] * b))
        toxic.append(int(a and b))
    model = toxicity.fit([toxicity.terms_of(t) for t in texts], np.array(toxic))
    scores = model.score(["filler insult group", "filler insult", "filler group", "filler"])
    assert scores[0] > .9 and (scores[1:] < .1).all()


def test_a_pair_counts_whose_single_terms_do_not_tell():
    rnd = np.random.default_rng(5)
    texts, toxic = [], []
    for _ in range(1500):
        a, b = (rnd.random(2) < .5).astype(int)
        texts.append(" ".join(["filler"] + ["insult"] * a + ["group"] * b))
        toxic.append(int(a == b))
    model = toxicity.fit([toxicity.terms_of(t) for t in texts], np.array(toxic))
    scores = model.score(["filler insult group", "filler", "filler insult", "filler group"])
    assert (scores[:2] > .9).all() and (scores[2:] < .1).all()


def test_few_labels_are_learned_from():
    rnd = np.random.default_rng(2)

    def text(insults):
        return " ".join([f"w{int(i)}" for i in 9000 * rnd.random(100) ** 2] + insults)

    insults = [["moron", "trash"], ["trash", "scum"], ["scum", "moron"]]
    texts = [text(insults[i % 3] if i < 9 else []) for i in range(70)]
    documents = [toxicity.terms_of(t) for t in texts]
    model = toxicity.fit(documents, np.arange(70) < 9)
    assert set(model.terms) == set(np.concatenate(documents)) and (model.weights != 0).all()
    new = model.score([text(insults[i % 3] if i < 30 else []) for i in range(200)])
    assert (new[:30] >= .5).all() and (new[30:] < .5).all()


def test_held_out_documents_are_told_apart(spark):
    rnd = np.random.default_rng(1)
    rows = [(i, " ".join(f"w{rnd.integers(0, 300)}" for _ in range(60))
             + (" Idiot!" if i % 6 == 0 else "")) for i in range(600)]
    labels = spark.createDataFrame([(i, int(i % 6 == 0)) for i, _ in rows], "doc_id long, toxic int")
    got = toxicity.toxicity_scores(docs_frame(spark, rows), labels).collect()
    assert len(got) == 600
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert r.predicted == int(r.score >= .5) == int(r.doc_id % 6 == 0)


@pytest.mark.parametrize("labels", [
    [], [(1, 1), (1, 0), (2, None), (None, 1), (12, 0), (99, 1)]])
def test_toxicity_of_awkward_rows(spark, labels):
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    got = toxicity.toxicity_scores(docs_frame(spark, awkward_rows()), marks).collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in awkward_rows())
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= .5) for r in got)
    assert all(r.held_out for r in got if r.doc_id is None)
    assert toxicity.toxicity_scores(docs_frame(spark, []), marks).count() == 0


def test_toxicity_learns_from_documents_not_held_out_only(spark):
    held = [i for i in range(400) if zlib.crc32(str(i).encode()) % 5 == 0]
    rows = [(i, "idiot" if i in held else "word") for i in range(400)]
    labels = spark.createDataFrame([(i, int(i in held)) for i, _ in rows], "doc_id long, toxic int")
    got = toxicity.toxicity_scores(docs_frame(spark, rows), labels)
    assert got.filter("predicted = 1").count() == 0


def test_sample_has_one_row_of_an_id_and_bounded_bytes(spark, monkeypatch):
    fitted = []
    monkeypatch.setattr(toxicity, "fit", lambda documents, toxic: fitted.append(
        (documents, toxic.tolist())))
    used = [i for i in range(60) if zlib.crc32(str(i).encode()) % 5]
    rows = [(i, f"w{i} " + " ".join(f"x{j}" for j in range(9))) for i in used] * 3
    rows += [(used[0], f"zz{j}") for j in range(500)] + [(used[1], None)]
    labels = spark.createDataFrame([(i, i % 2) for i in used] * 2, "doc_id long, toxic int")
    for limit in (toxicity.SAMPLE_BYTES, 200, 1):
        toxicity.learn(docs_frame(spark, rows), labels, sample_bytes=limit)
        documents, toxic = fitted.pop()
        assert sum(d.nbytes for d in documents) <= max(limit, 40)
        assert 1 <= len(documents) <= len(used) and len(toxic) == len(documents)
        if limit > 200:
            assert sorted(map(len, documents)) == [0] + [10] * (len(used) - 1)


# -- personal data -----------------------------------------------------------------

def luhn(digits):
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10))
               for i, c in enumerate(reversed(digits))) % 10 == 0


def brute(text):
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    rules = [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         lambda m: all(int(p) <= 255 for p in m[0].split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 16 <= len(digits(m)) <= 19 and luhn(digits(m))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 8 <= len(digits(m)) <= 15),
    ]
    return [(k, *m.span()) for k, p, ok in rules for m in re.finditer(p, text) if ok(m)]


@settings(max_examples=500, deadline=None)
@given(text=st.text(st.sampled_from("a1.@ +-(9é0"), max_size=60))
def test_base_spans_of_any_text(text):
    assert pii.base_spans(text) == brute(text)


@pytest.mark.parametrize("text", [
    "x 4111-1111-1111-1111, 4111 1111 1111 1111y 4111111111111112", "+1 (743) 555-3824 1.2.3.4.5.6.7.8",
    "a@b.c@d.e.f é@x.y a..b@c-d.e", "1" * 3000, "a" * 3000 + "@", "0010.02.3.255 256.1.1.1 1.1.1.256"])
def test_base_spans(text):
    assert pii.base_spans(text) == brute(text)


def test_spans_of_awkward_rows(spark):
    rows = awkward_rows() + [(20, "call 555-123-4567 now"), (21, "ä a@b.com, +1 (743) 555-3824."),
                             (22, "order 555-123-4567-1234-1")]
    got = pii.find_spans(docs_frame(spark, rows)).collect()
    text = {r[0]: r[1] or "" for r in rows}
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in rows)
    for r in got:
        if r.doc_id in (None, 14):
            continue
        base = brute(text[r.doc_id])
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [
            sum(k == x for x, _, _ in base) for k in pii.KINDS]
        assert set(filter(None, joined.split(","))) <= set(r.spans.split(","))
    assert pii.find_spans(docs_frame(spark, [])).count() == 0


def test_votes_settle_loose_candidates():
    texts = (["call +1 (743) 555-3824 today"] * 40 + ["phone: 743-555-3824 today"] * 5
             + ["order 4111 1111 1111 1112 shipped"] * 30)
    codes = Counter(s["code"] for t in texts for side in pii.candidates(t) for s in side)
    names = sorted(codes)
    counts = np.array([codes[c] for c in names], float)
    model = pii.SpanClassifier(names, counts, pii.estimate(names, counts))
    loose = lambda t: [model.accepts(s["code"]) for s in pii.candidates(t)[1]]
    assert loose("phone: 743-555-3824 today") == [True]
    assert loose("order 4111 1111 1111 1112 shipped") == [False]


def test_masking_replaces_overlapping_spans_once():
    span = lambda k, a, b: {"kind": pii.KINDS.index(k), "start": a, "end": b}
    assert pii.masked("0123456789", [span("ip", 2, 5), span("phone", 4, 7)]) == "01[IP]789"
    assert pii.masked("abc", [span("card", 0, 3)]) == "[CARD]"


def test_masked_documents_keep_columns_and_nulls(spark):
    rows = [(1, "mail a@b.com"), (2, None), (3, "")]
    got = pii.mask(docs_frame(spark, rows))
    assert got.columns == docs_frame(spark, rows).columns
    assert {r.doc_id: r.text for r in got.collect()} == {1: "mail [EMAIL]", 2: None, 3: ""}
