import hashlib
import math
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from riskloom.llm import codes

SCHEMA = "vec_id long, embedding array<float>, label int, code string, vector int, cell int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 1) for r in rows], SCHEMA)


def brute(rows, parts=16, size=64, rounds=2):
    """The definition in plain Python; rows are (vec_id, embedding, label)."""
    kept = [(i, [math.floor(256 * np.float64(np.float32(x))) for x in v], label)
            for i, v, label in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not kept:
        return [], hashlib.sha256(b"").hexdigest()
    width = len(kept[0][1])
    alike = [r for r in kept if len(r[1]) == width]
    bounds = codes.part_bounds(width, parts)
    books = [[v[a:b] for _, v, _ in alike[:size]] for a, b in bounds]

    def assign():
        out = []
        for _, v, _ in alike:
            row = []
            for book, (a, b) in zip(books, bounds):
                row.append(min((sum((x - y) ** 2 for x, y in zip(v[a:b], c)), e)
                               for e, c in enumerate(book)))
            out.append(row)
        return out

    for _ in range(rounds):
        found = assign()
        for p, (a, b) in enumerate(bounds):
            members = defaultdict(list)
            for (_, v, _), row in zip(alike, found):
                members[row[p][1]].append(v[a:b])
            for e, some in members.items():
                books[p][e] = [sum(x) // len(some) for x in zip(*some)]
    found = assign()
    errors = [sum(d for d, _ in row) for row in found]
    by_label = defaultdict(int)
    for (_, _, label), error in zip(alike, errors):
        by_label[label] += error
    out = [(i, "".join(f"{e:02x}" for _, e in row), error, by_label[label])
           for (i, _, label), row, error in zip(alike, found, errors)]
    odd = [(i, None, None, by_label.get(label)) for i, v, label in kept if len(v) != width]
    digest = ",".join(str(x) for book in books for entry in book for x in entry)
    return out + odd, hashlib.sha256(digest.encode()).hexdigest()


def check(spark, rows):
    want, digest = brute(rows)
    df = codes.vector_codes(frame(spark, rows))
    assert df.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    got = df.collect()
    assert sorted(map(repr, [tuple(r)[:4] for r in got])) == sorted(map(repr, want))
    assert {r.codebooks_sha256 for r in got} <= {digest}


def vectors(seed, count, width):
    rnd = np.random.default_rng(seed)
    return [(int(i), [float(x) for x in rnd.normal(size=width).astype(np.float32)],
             None if i % 7 == 0 else int(i % 3)) for i in rnd.permutation(count)]


def test_codes_are_those_of_the_definition(spark):
    check(spark, vectors(1, 230, 32))


def test_awkward_vectors(spark):
    rows = vectors(2, 90, 16)
    rows += [(500, None, 1), (501, [None] + [0.0] * 15, 1), (502, [math.inf] * 16, 1),
             (503, [math.nan] * 16, 1), (504, [0.5] * 4, 1), (505, [], 2), (None, [0.25] * 16, 9),
             (0, [1.0] * 16, None), (0, [1.0] * 16, None), (3, rows[0][1], 2)]
    check(spark, rows)


@pytest.mark.parametrize("rows", [
    [], [(1, None, 1)], [(1, [0.5] * 16, None)], [(1, [], 1), (2, [], 2)],
    [(i, [0.0] * 16, 1) for i in range(80)],       # every entry is the same
    [(i, [float(i % 5)] * 19, 1) for i in range(70)]])
def test_small_and_equal_tables(spark, rows):
    check(spark, rows)


def test_components_beyond_the_range_fail(spark):
    with pytest.raises(Exception, match="beyond"):
        codes.vector_codes(frame(spark, [(1, [1e30] * 16, 1)])).collect()


@settings(max_examples=200, deadline=None)
@given(data=st.data())
def test_balls_find_the_nearest_entry(data):
    width = data.draw(st.integers(1, 3))
    spots = st.lists(st.integers(-6, 6), min_size=width, max_size=width)
    entries = np.array(data.draw(st.lists(spots, min_size=1, max_size=20)), np.int64)
    points = np.array(data.draw(st.lists(spots, min_size=1, max_size=30)), np.int64)
    held = np.array(data.draw(st.lists(st.integers(0, len(entries) - 1), min_size=len(points),
                                       max_size=len(points))), np.int64)
    balls = codes.Balls(entries)
    apart = ((points[:, None] - entries[None]) ** 2).sum(axis=2)
    for start in (held, balls.guess(points)):
        found, best = balls.nearest(points, start)
        assert (found == apart.argmin(axis=1)).all() and (best == apart.min(axis=1)).all()


def test_stable_cores_and_rings_save_work():
    rnd = np.random.default_rng(3)
    entries = rnd.integers(-2000, 2000, (64, 4))
    points = entries[rnd.integers(0, 64, 5000)] + rnd.integers(-60, 60, (5000, 4))
    balls = codes.Balls(entries)
    found, _ = balls.nearest(points, balls.guess(points))
    balls.compared = 0
    again, _ = balls.nearest(points, found)
    assert (again == found).all()
    assert balls.compared < 5000 * 64 // 20
