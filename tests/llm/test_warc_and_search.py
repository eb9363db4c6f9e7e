import hashlib
import io
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from riskloom.llm import topk, warc


# -- archives ----------------------------------------------------------------------

def pages_frame(spark, rows):
    schema = "page_id long, url string, html string, digest string, first string, archive string"
    return spark.createDataFrame([(*r, "x", "x", "x") for r in rows], schema)


LONG = "<p>é" + "x" * 200
PAGES = [(3, "u3", LONG), (1, "u\r\n1", LONG), (2, None, LONG), (1, "again", LONG), (4, "u4", "short"),
         (5, "u5", "short"), (6, "u6", None), (7, "u7", ""), (8, "u8", "z" * 100), (9, "u9", "z" * 100),
         (10, "u10", "z" * 99), (11, "u11", "z" * 99), (None, "n", LONG), (12, "u12", "y" * 300_000),
         (None, "n1", "q" * 150), (None, "n2", "q" * 150)]


def expected(rows):
    first = {}
    for page, _, html in rows:
        if page is not None and len((html or "").encode()) >= 100:
            first[html] = min(first.get(html, page), page)
    out = []
    for page, _, html in rows:
        data = (html or "").encode()
        target = first.get(html) if len(data) >= 100 else None
        revisit = target is not None and target != page
        out.append((page, len(data), hashlib.sha256(data).hexdigest(),
                    "revisit" if revisit else "response", target if revisit else None))
    return Counter(out)


@pytest.mark.parametrize("rows", [PAGES, []])
def test_archives_come_back(spark, rows):
    pages = pages_frame(spark, rows).repartition(3)
    assert Counter(map(tuple, warc.archive_round_trip(pages).collect())) == expected(rows)


def test_contents_and_addresses_come_back(spark, tmp_path):
    archives = warc.write_archives(warc.plan_records(pages_frame(spark, PAGES)), str(tmp_path))
    got = warc.read_archives(archives).collect()
    assert Counter((r.page_id, r.url) for r in got) == Counter((p, u or "") for p, u, _ in PAGES)
    html = {(p, u or ""): h or "" for p, u, h in PAGES}
    for r in got:
        assert r.html == (html[(r.page_id, r.url)] if r.record_type == "response" else None)


def test_records_have_ids_of_their_own_and_revisits_name_their_original(spark, tmp_path):
    pages = PAGES + [(20, "http://a.org/x%20y?q=1#z", "w" * 120), (21, "http://a.org/ü z", "w" * 120)]
    listed = warc.write_archives(warc.plan_records(pages_frame(spark, pages)), str(tmp_path))
    records = []
    for row in listed.collect():
        with open(row.archive, "rb") as stream:
            records += warc.read_records(stream)
    by_id = {r.headers["WARC-Record-ID"]: r for r in records}
    assert len(records) == len(by_id) == len(pages)
    revisits = [r.headers for r in records if r.kind == "revisit"]
    assert len(revisits) == 5
    for headers in revisits:
        original = by_id[headers["WARC-Refers-To"]]
        assert original.kind == "response"
        assert original.headers["Page-Id"] == headers["Refers-To-Page"]
        assert original.headers["WARC-Payload-Digest"] == headers["WARC-Payload-Digest"]
    addresses = {r.headers["WARC-Target-URI"] for r in records}
    assert {"http://a.org/x%20y?q=1#z", "http://a.org/%C3%BC%20z", "u%0D%0A1", "about:blank"} <= addresses
    assert all(a.isascii() and " " not in a for a in addresses)


def some_records(count=5):
    rnd = random.Random(1)
    contents = [bytes(rnd.randrange(256) for _ in range(rnd.choice([0, 10, 200_000])))
                for _ in range(count)] + [b"\r\n\r\nWARC/1.1\r\n\r\n"]
    members = [warc.record_bytes({"WARC-Type": "response", "WARC-Payload-Digest": "sha256:"
                                  + hashlib.sha256(c).hexdigest()}, c) for c in contents]
    return contents, members


def test_each_record_is_a_member_of_its_own():
    contents, members = some_records()
    for content, member in zip(contents, members):
        assert zlib.decompress(member, 31).endswith(content + b"\r\n\r\n")
    read = list(warc.read_records(io.BytesIO(b"".join(members))))
    assert [r.content for r in read] == contents


def test_damage_is_noticed():
    _, members = some_records()
    whole = b"".join(members)
    for broken in (whole[:-3], whole[:len(members[0]) + 7]):
        with pytest.raises(warc.WarcError):
            list(warc.read_records(io.BytesIO(broken)))
    plain = zlib.decompress(warc.record_bytes({"WARC-Type": "revisit"}, b"abc"), 31)
    for damage in (plain.replace(b"abc", b"abd"), plain.replace(b"Length: 3", b"Length: 4"),
                   plain.replace(b"WARC/1.1", b"HTTP/1.1")):
        packer = zlib.compressobj(wbits=31)
        with pytest.raises(warc.WarcError):
            list(warc.read_records(io.BytesIO(packer.compress(damage) + packer.flush())))


# -- search ------------------------------------------------------------------------

def vectors_frame(spark, rows):
    schema = "vec_id long, embedding array<float>, label string, score string, query_id string"
    return spark.createDataFrame([(*r, "x", "x", "x") for r in rows], schema)


def best_by_brute_force(rows, k=5, every=50):
    sound = [(i, np.floor(256 * np.array(v, np.float32).astype(float))) for i, v in rows
             if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    out, asked = [], {}
    for i, v in sound:
        if i % every == 0:
            asked[i] = min(asked.get(i, tuple(v)), tuple(v))
    for q, v in asked.items():
        scores = sorted((-int(np.dot(v, w)), i) for i, w in sound if i != q and len(w) == len(v))
        out += [(q, rank, i, -s) for rank, (s, i) in enumerate(scores[:k], 1)]
    return Counter(out)


def random_vectors(count, size=6, seed=1):
    rnd = np.random.default_rng(seed)
    return [(i, rnd.normal(size=size).astype(np.float32).tolist()) for i in range(count)]


@pytest.mark.parametrize("rows, shard", [
    (random_vectors(400), 8192), (random_vectors(400), 30), (random_vectors(3), 8192), ([], 10),
    ([(0, [1.0, 2.0])], 10)])
def test_search_is_exact(spark, rows, shard):
    got = topk.top_k(vectors_frame(spark, rows), shard_rows=shard).collect()
    assert Counter(map(tuple, got)) == best_by_brute_force(rows)


def test_a_task_of_the_search_holds_a_bounded_block_of_queries(spark, monkeypatch):
    rows, sent = random_vectors(3000), []
    search = topk._search_shards

    def spy(shards, asked, k):
        sent.append((max(r["count"] for r in asked.groupBy("visits", "asked_block").count().collect()),
                     shards.groupBy("shard", "block").count().count()))
        return search(shards, asked, k)

    monkeypatch.setattr(topk, "_search_shards", spy)
    got = topk.top_k(vectors_frame(spark, rows), shard_rows=1500, query_bytes=10 * 6 * 8).collect()
    assert Counter(map(tuple, got)) == best_by_brute_force(rows)
    assert all(most <= 25 and pairs == 6 for most, pairs in sent)


def test_search_of_awkward_vectors(spark):
    rows = random_vectors(120) + [
        (50, [0.5] * 6), (200, None), (201, []), (202, [1.0, None, 1.0, 1.0, 1.0, 1.0]),
        (203, [float("nan")] * 6), (204, [float("inf")] * 6), (None, [1.0] * 6), (250, [1.0, 2.0]),
        (251, [1.0, 2.0]), (300, [0.0] * 6)]
    rows += [(400 + i, [0.25] * 6) for i in range(90)]  # ties
    got = topk.top_k(vectors_frame(spark, rows), shard_rows=40).collect()
    assert Counter(map(tuple, got)) == best_by_brute_force(rows)


def clustered_vectors(count, clusters=8, size=10, seed=4):
    rnd = np.random.default_rng(seed)
    middles = 4 * np.eye(size)[:clusters]
    return [(i, (middles[rnd.integers(clusters)] + rnd.normal(size=size) / 20)
             .astype(np.float32).tolist()) for i in range(count)]


def test_queries_go_to_few_shards_of_clustered_vectors(spark, monkeypatch):
    rows, sent = clustered_vectors(4000), []
    search = topk._search_shards

    def spy(shards, asked, k):
        sent.append((asked.count(), shards.count()))
        return search(shards, asked, k)

    monkeypatch.setattr(topk, "_search_shards", spy)
    got = topk.top_k(vectors_frame(spark, rows), shard_rows=250, query_bytes=20 * 10 * 8).collect()
    assert Counter(map(tuple, got)) == best_by_brute_force(rows)
    # 80 queries, 16 shards and more: all of them would be 1,280 visits or more.
    assert sum(visits for visits, _ in sent) <= 400


@pytest.mark.parametrize("hot", [[1.0] * 6, [-3.0] * 6])
def test_search_among_many_equal_vectors(spark, hot):
    """A third of all rows is one vector: its cell is split into shards of bounded size."""
    rows = random_vectors(300) + [(1000 + i, hot) for i in range(150)]
    got = topk.top_k(vectors_frame(spark, rows), shard_rows=20).collect()
    assert Counter(map(tuple, got)) == best_by_brute_force(rows)


def test_cells_bound_what_is_in_them():
    rnd = np.random.default_rng(6)
    vectors = np.floor(256 * rnd.normal(size=(600, 5)))
    cells = topk.Cells.fitted(vectors[:200], 12)
    place, away = cells.nearest(vectors)
    cells.measure({c: (int((place == c).sum()), float(away[place == c].max()))
                   for c in np.unique(place)}, 40)
    queries = np.floor(256 * rnd.normal(size=(20, 5)))
    bounds = cells.bounds(queries)
    for c in np.unique(place):
        assert (bounds[:, c] >= (queries @ vectors[place == c].T).max(axis=1)).all()
    assert cells.first[-1] == sum(-(-int((place == c).sum()) // 80) for c in np.unique(place))


def test_bounds_of_nodes_hold():
    rnd = np.random.default_rng(3)
    vectors = np.floor(256 * rnd.normal(size=(500, 5)))
    root = topk.build(np.arange(500), vectors, 10)
    queries = np.floor(256 * rnd.normal(size=(20, 5)))
    search = topk.Search(np.full(20, -1), queries, np.full(20, -np.inf), 3)

    def check(node):
        below = [node.vectors] if node.ids is not None else [check(c) for c in node.children]
        below = np.concatenate(below)
        assert (search.bounds(node, np.arange(20)) >= (queries @ below.T).max(axis=1)).all()
        return below

    assert len(check(root)) == 500
