import hashlib
import itertools
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from riskloom.llm import decontam, neardup, ngram_lm, repeats
from riskloom.llm.graphs import components
from tests.llm.fixtures import awkward_rows, docs_frame, prose


# -- repeated strings --------------------------------------------------------------

def cut_by_brute_force(rows, width=100):
    """Expected rows; documents in the order of ids, then texts, without an id last."""
    seen, out = set(), []
    for doc, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] or "")):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for at in range(len(data) - width + 1):
            window = data[at:at + width]
            if window in seen:
                gone[at:at + width] = b"\1" * width
            seen.add(window)
        kept = bytes(c for c, g in zip(data, gone) if not g)
        runs = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((doc, len(data), len(data) - len(kept), runs, hashlib.sha256(kept).hexdigest()))
    return Counter(out)


def passages(seed):
    """Documents that share passages, lines and rotations, some with a changed byte."""
    rnd = random.Random(seed)
    parts = [prose(100 + i, rnd.randint(5, 60)) for i in range(6)] + ["ab" * 90, "-" * 130]
    rows = []
    for i in range(30):
        text = "\n".join(rnd.choice(parts) if rnd.random() < .6 else prose(1000 * seed + i, 20)
                         for _ in range(rnd.randint(1, 5)))
        if rnd.random() < .3 and text:
            k = rnd.randrange(len(text))
            text = text[:k] + "~" + text[k + 1:]
        rows.append((i, text))
    return rows


@pytest.mark.parametrize("rows", [passages(1), passages(2), awkward_rows(), []])
def test_repeats_match_brute_force(spark, rows, monkeypatch):
    got = repeats.without_repeats(docs_frame(spark, rows)).collect()
    assert Counter(tuple(r) for r in got) == cut_by_brute_force(rows)


def test_repeats_in_many_small_blocks_and_tasks(spark):
    rows = passages(3)
    docs = docs_frame(spark, rows).repartition(7)
    got = repeats.without_repeats(docs).collect()
    assert Counter(tuple(r) for r in got) == cut_by_brute_force(rows)


def test_frequent_triggers_are_dealt_out(spark):
    """A line in many surroundings: its trigger has a phrase for each of them."""
    line = prose(77, 12)[:80]
    rows = [(i, prose(500 + i, 8) + line + prose(900 + i, 8)) for i in range(60)]
    rows += [(100 + i, prose(500 + i, 8)[-30:] + line + "!") for i in range(60)]
    got = repeats.without_repeats(docs_frame(spark, rows)).collect()
    want = cut_by_brute_force(rows)
    assert Counter(tuple(r) for r in got) == want and any(r[2] for r in want)


def test_triggers_of_many_tasks_are_dealt_out(spark, monkeypatch):
    monkeypatch.setattr(repeats, "GATHERED", 2)
    rows = passages(4)
    got = repeats.without_repeats(docs_frame(spark, rows).repartition(5)).collect()
    assert Counter(tuple(r) for r in got) == cut_by_brute_force(rows)


@pytest.mark.parametrize("letters", ["ab", "abcdefghé \xff"])
def test_dictionary_order_is_that_of_sorted_suffixes(letters):
    """Against suffixes cut out and sorted, ties by row and place."""
    rnd = random.Random(len(letters))
    line = "".join(rnd.choice(letters) for _ in range(130))
    phrases = [line[rnd.randrange(20):][:rnd.randint(100, 110)] + line[:rnd.randrange(60)]
               for _ in range(40)] + ["a" * 180, "a" * 100]
    phrases = [p.encode("latin-1") for p in phrases]
    rows = np.array([rnd.randrange(9) for _ in phrases])
    starts = np.array([1000 * i for i in rnd.sample(range(100), len(phrases))])
    row, place, first = repeats.dictionary_order(
        b"".join(phrases), np.array([len(p) for p in phrases]), rows, starts)
    want = sorted((p[i:i + 100], int(r), int(s) + i) for p, r, s in zip(phrases, rows, starts)
                  for i in range(len(p) - 99))
    assert list(zip(row.tolist(), place.tolist())) == [w[1:] for w in want]
    assert first.tolist() == [i == 0 or want[i - 1][0] != w[0] for i, w in enumerate(want)]


def test_dictionary_is_sorted_in_parts(monkeypatch, spark):
    """Parts that end within a trigger keep its phrases for the next."""
    monkeypatch.setattr(repeats, "DICTIONARY_BYTES", 500)
    monkeypatch.setattr(repeats, "DICTIONARY_ROWS", 3)
    rows = passages(5) + [(500 + i, prose(9, 30) + prose(700 + i, 3)) for i in range(80)]
    got = repeats.without_repeats(docs_frame(spark, rows).repartition(3)).collect()
    assert Counter(tuple(r) for r in got) == cut_by_brute_force(rows)


def test_phrases_hold_every_string_once():
    data = np.frombuffer(prose(8, 900).encode(), np.uint8)
    starts, count, _, _ = repeats.parse(data, np.zeros(len(data), int))
    places = np.concatenate([np.arange(s, s + n) for s, n in zip(starts, count)])
    assert places.tolist() == list(range(len(data) - repeats.WIDTH + 1))


# -- near duplicates ---------------------------------------------------------------

def shingle_sets(rows):
    return [(doc, neardup._shingle_set(text or "")) for doc, text in rows]


def groups_by_brute_force(rows, percent):
    sets = [(d, s) for d, s in shingle_sets(rows) if d is not None]
    parent = {d: d for d, _ in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, s) in enumerate(sets):
        for b, t in sets[:i]:
            if neardup.similar(s, t, percent):
                one, two = find(a), find(b)
                parent[max(one, two)] = min(one, two)
    return {d: find(d) for d in parent}


def family(seed, copies, words=120):
    """A text and copies with a few words changed, so that only some pairs are linked."""
    rnd = random.Random(seed)
    base = prose(seed, words).split(" ")
    out = []
    for _ in range(copies):
        text = list(base)
        for _ in range(rnd.randint(0, 4)):
            text[rnd.randrange(len(text))] = f"w{rnd.randrange(10**6)}"
        out.append(" ".join(text))
    return out


@pytest.mark.parametrize("percent", [85, 80])
def test_groups_match_brute_force(spark, percent, monkeypatch):
    monkeypatch.setattr(neardup, "OPEN_PAIRS", 2)
    texts = [t for s in range(6) for t in family(s, 12)] + [prose(50 + i, 9) for i in range(10)]
    rows = list(enumerate(random.Random(1).sample(texts, len(texts)))) + [(200, texts[0])]
    got = neardup.near_duplicates(docs_frame(spark, rows), percent).collect()
    want, sizes = groups_by_brute_force(rows, percent), dict(shingle_sets(rows))
    assert {r.doc_id: r.component_id for r in got} == want
    for r in got:
        assert r.n_shingles == len(sizes[r.doc_id]) and r.kept == (r.doc_id == r.component_id)


def test_groups_of_awkward_rows(spark):
    rows = awkward_rows()
    got = neardup.near_duplicates(docs_frame(spark, rows)).collect()
    assert Counter(r.doc_id for r in got) == Counter(d for d, _ in rows)
    want = groups_by_brute_force(rows, 85)
    for r in got:
        assert r.component_id == want.get(r.doc_id) and r.kept == (r.doc_id == r.component_id)
    assert want[2] == want[3] == 1
    assert neardup.near_duplicates(docs_frame(spark, [])).count() == 0


def test_members_of_one_label_never_meet(spark):
    """A large group with an outsider: the pairs that are formed grow with its size only."""
    n = 20_000
    rows = spark.range(n + 3).selectExpr(
        "7L AS key", "id AS rep", "100L AS size", "95L AS rest", "1L AS weight",
        f"IF(id < {n}, 0L, {n} + id % 2) AS label", "0L AS main")
    assert neardup._met(rows).count() == 3 * (n + 3)
    got = neardup._pairs_of_labels(rows, 80)
    assert got.count() == got.distinct().count() == 3 * n + 2
    assert got.filter("a >= b").isEmpty()


def test_signatures_estimate_similarity():
    rnd = np.random.default_rng(2)
    pool = rnd.integers(0, 2**63, 1200).astype(np.uint64)
    one, two = pool[:1000], pool[200:]
    elements = np.concatenate([one, two, pool[:3]])
    owners = np.repeat([0, 1, 2], [1000, 1000, 3])
    a, b, small = neardup.super_minhash(elements, owners, 3, 512)
    assert abs((a == b).mean() - 800 / 1200) < .08
    assert (small < np.iinfo(np.uint64).max).all()
    again = neardup.super_minhash(elements[::-1], owners[::-1], 3, 512)
    assert (again == np.stack([a, b, small])).all()


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(300, 300)]
    got = dict(map(tuple, components(spark.createDataFrame(links, "a long, b long")).collect()))
    assert got == ({i: 0 for i in range(41)} | {100 + i: 100 for i in range(30)} | {300: 300})


# -- language model ----------------------------------------------------------------

def exponent_by_brute_force(counts, once):
    """Of one order, by the mean count of the states of each power of two."""
    classes = {}
    for c in counts:
        classes.setdefault(c.bit_length(), []).append(c)
    groups = [(sum(g), sum(g) / len(g)) for g in classes.values()]
    wanted = min(max(once, 1), .99 * sum(m for m, _ in groups))
    low, high = 0, 64
    for _ in range(100):
        g = (low + high) / 2
        low, high = (g, high) if sum(m * (1 + c) ** -g for m, c in groups) > wanted else (low, g)
    return low


def scores_by_brute_force(rows, order=3):
    """The recursion of the weights over contexts of up to ``order - 1`` words."""
    tokens = lambda t: (t or "").encode().lower().split() + [None]
    held = [d is None or zlib.crc32(str(d).encode()) % 7 == 2 for d, _ in rows]
    grams, after = [Counter(), Counter(), Counter()], [Counter(), Counter(), Counter()]
    for (_, text), h in zip(rows, held):
        words = [0, *tokens(text)]
        for i in range(1, len(words) if not h else 0):
            for k in range(min(i + 1, 3)):
                grams[k][tuple(words[i - k:i + 1])] += 1
                after[k][tuple(words[i - k:i])] += 1
    n, v = sum(grams[0].values()), len(grams[0])
    exponents = [0, *(exponent_by_brute_force(after[k].values(),
                                              sum(c == 1 for c in grams[k].values()))
                      for k in (1, 2))]

    def weight(context, word):
        if not context:
            return (grams[0][(word,)] + 1) / (n + v + 1)
        k, shorter = len(context), weight(context[1:], word)
        met = after[k][context]
        fail = (1 + met) ** -exponents[k]
        return (1 - fail) * grams[k][(*context, word)] / met + fail * shorter if met else shorter

    out = []
    for (doc, text), h in zip(rows, held):
        words, base, score = [0, *tokens(text)], 0, 0
        for i in range(1, len(words)):
            base += math.log10(weight((), words[i]))
            score += math.log10(weight(tuple(words[max(0, i - order + 1):i]), words[i]))
        out.append((str(doc), h, len(words) - 1, sum(grams[0][(w,)] > 0 for w in words[1:]), n,
                    round(base, 6), round(score, 6)))
    return Counter(out)


@pytest.mark.parametrize("rows, block", [(awkward_rows(), 1 << 20), (awkward_rows(), 700),
                                         ([], 1 << 20), ([(None, "a b")], 1 << 20)])
def test_scores_match_brute_force(spark, rows, block):
    got = ngram_lm.text_scores(docs_frame(spark, rows), block).collect()
    assert Counter((str(r[0]), *tuple(r)[1:5], round(r[5], 6), round(r[6], 6))
                   for r in got) == scores_by_brute_force(rows)


def test_longer_states_help_with_held_out_texts(spark):
    """Texts that follow patterns of three words, and repeated ones: better than by bigrams."""
    rnd = random.Random(8)
    verses = [" ".join(rnd.choice("a b c d e f".split()) for _ in range(3)) for _ in range(30)]
    rows = [(i, " ".join(rnd.choice(verses) for _ in range(20))) for i in range(200)]
    got = {r.doc_id: r for r in ngram_lm.text_scores(docs_frame(spark, rows)).collect()}
    assert Counter((str(r[0]), *tuple(r)[1:5], round(r[5], 6), round(r[6], 6))
                   for r in got.values()) == scores_by_brute_force(rows)
    short = sum(s[-1] for s in scores_by_brute_force(rows, order=2) if s[1])
    assert sum(r.score for r in got.values() if r.held_out) > short


def test_arcs_of_a_state_sum_to_one():
    hashes = neardup.WordHashes()
    texts = ("a b a c", "b a", "c c d", "a b c")
    docs = [ngram_lm.token_hashes(t.encode().split(), hashes) for t in texts]
    trained = ngram_lm.Block(docs, np.array([True, True, False, True]))
    tokens = [t for d, h in zip(docs, (1, 1, 0, 1)) if h for t in d]
    find = lambda keys, counts, wanted: np.array(
        [counts[np.searchsorted(keys, k)] if k in keys else 0 for k in wanted])
    # From states of two words, of one, of the start and of the root to every known token, and
    # to the unknown one.
    for state in ([b"a", b"b"], [b"b", b"a"], [b"c", b"b"], [b"d", b"zz"], []):
        total = 0
        for word in ([b"a"], [b"b"], [b"c"], [b"zz"], []):
            block = ngram_lm.Block([ngram_lm.token_hashes(state + word, hashes)],
                                   np.array([True]))
            model = ngram_lm.Automaton(
                find(trained.words, trained.word_counts, block.words),
                find(trained.grams, trained.gram_counts, block.grams),
                len(tokens), len(set(tokens)), (.4, .7))
            total += 10 ** model.walk(block)[0][len(state)]
        assert math.isclose(total, 1, rel_tol=1e-9), state


def test_failure_arcs_carry_the_mass_of_unseen_followers():
    states, mass = np.array([50, 0, 20, 3]), np.array([50, 0, 110, 31])
    g = ngram_lm.failure_exponent(states, mass, 70)
    met = np.array([1, 110 / 20, 31 / 3])
    assert math.isclose((mass[[0, 2, 3]] * (1 + met) ** -g).sum(), 70, rel_tol=1e-9)


def test_packed_keys_come_back():
    rnd = np.random.default_rng(0)
    for n in (0, 1, 2, 1000):
        keys = np.unique(rnd.integers(0, 2**64, n, dtype=np.uint64))
        assert (ngram_lm.unpack_keys(ngram_lm.pack_keys(keys)) == keys).all()


# -- benchmark overlaps ------------------------------------------------------------

def items_frame(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], "item_id long, text string, words string")


ITEMS = [(1, prose(201, 30)), (2, prose(202, 15)), (3, "only five short words here"), (4, ""),
         (5, None), (None, prose(203, 20)), (6, prose(201, 30))]


def words_of_item(item):
    return decontam._WORD.findall(dict(ITEMS)[item].lower())


def test_overlaps_survive_substitutions(spark):
    def broken(item, every):
        words = words_of_item(item)
        words[2::every] = [f"zq{i}" for i in range(len(words[2::every]))]
        return " ".join(words)

    rows = [(1, prose(301, 50)), (2, prose(302, 9) + " " + " ".join(words_of_item(1)) + " end"),
            (3, prose(303, 400) + " " + broken(1, 6)), (4, broken(2, 7)), (5, broken(1, 2)),
            (6, "x only five, SHORT words here y"), (7, "only five short word here"),
            (8, " ".join(words_of_item(1)[:11])), (9, " ".join(words_of_item(1)[5:18])),
            (10, None), (11, ""), (None, " ".join(words_of_item(1))), (2, "another text")]
    got = decontam.contamination(docs_frame(spark, rows), items_frame(spark, ITEMS)).collect()
    assert Counter(r.doc_id for r in got) == Counter(d for d, _ in rows)
    assert {r.doc_id for r in got if r.contaminated} == {2, 3, 4, 6, 9}
    one = next(r for r in got if r.doc_id == 2)
    assert (one.n_items, one.item_id, one.overlap_words) == (2, 1, len(words_of_item(1)))
    assert next(r.item_id for r in got if r.doc_id == 6) == 3


def seeded(length, substituted, masks):
    return any(all(start + i not in substituted for i, m in enumerate(mask) if m == "1")
               for mask in masks for start in range(length - len(mask) + 1))


@pytest.mark.parametrize("length", range(6, 24))
def test_every_overlap_has_a_seed(length):
    """Longer overlaps hold one of 12 to 23 words with no more than its fifth substituted."""
    masks = decontam.masks_of(length)
    most = length // 5
    assert all(seeded(length, set(c), masks)
               for c in itertools.combinations(range(length), most))


def best_overlap(one, two):
    """By brute force over all places and stretches: of at least 12 words, 80 % equal."""
    best = 0
    for shift in range(-len(two), len(one)):
        equal = [0 <= i + shift < len(one) and one[i + shift] == two[i] for i in range(len(two))]
        inside = [0 <= i + shift < len(one) for i in range(len(two))]
        for i, j in itertools.combinations(range(len(two) + 1), 2):
            if (j - i >= 12 and (equal[i] or i == 0) and (equal[j - 1] or j == len(two))
                    and all(inside[i:j]) and 5 * sum(equal[i:j]) >= 4 * (j - i)):
                best = max(best, j - i)
    return best


def test_overlaps_match_brute_force_over_random_substitutions(spark):
    rnd = np.random.default_rng(6)
    items = [(n, [f"i{n}x{j}" for j in range(n)]) for n in range(12, 27)]
    docs = []
    for n, words in items:
        for _ in range(12):
            text = list(words)
            for at in rnd.choice(n, n // 5 + int(rnd.integers(0, 2)), replace=False):
                text[at] = "zq"
            docs.append((len(docs), n, ["one", "two"] + text + ["end"]))
    docs.append((len(docs), 12, [w if i not in (5, 6) else "zq" for i, w in enumerate(items[0][1])]))
    got = decontam.overlaps(docs_frame(spark, [(d, " ".join(t)) for d, _, t in docs]),
                            items_frame(spark, [(n, " ".join(w)) for n, w in items])).collect()
    want = {(d, n, b) for d, n, t in docs if (b := best_overlap(t, dict(items)[n]))}
    assert {(r.doc_id, r.item_id, r.words) for r in got} == want


def test_substituted_edges_of_an_item_count(spark):
    """Every placement of a fifth of substitutions, the first and last word included."""
    items = [(n, [f"i{n}x{j}" for j in range(n)]) for n in (12, 13, 15)]
    docs, want = [], set()
    for n, words in items:
        for places in itertools.combinations(range(n), n // 5):
            want.add((len(docs), n, n, n - n // 5))
            text = [w if i not in places else "zq" for i, w in enumerate(words)]
            docs.append((len(docs), " ".join(["one"] + text + ["end"])))
    got = decontam.overlaps(docs_frame(spark, docs),
                            items_frame(spark, [(n, " ".join(w)) for n, w in items]))
    assert set(map(tuple, got.collect())) == want


def test_short_items_are_found_by_the_share_of_equal_words(spark):
    items = [(n, [f"i{n}x{j}" for j in range(n)]) for n in range(6, 12)]
    docs, want = [], set()
    for n, words in items:
        for k in range(4):
            for places in itertools.combinations(range(n), k):
                if 5 * (n - k) >= 4 * n:
                    want.add((len(docs), n, n, n - k))
                text = [w if i not in places else "zq" for i, w in enumerate(words)]
                docs.append((len(docs), " ".join(["one"] + text + ["end"])))
    got = decontam.overlaps(docs_frame(spark, docs),
                            items_frame(spark, [(n, " ".join(w)) for n, w in items]))
    assert set(map(tuple, got.collect())) == want


def test_overlaps_of_empty_tables(spark):
    docs, items = docs_frame(spark, [(1, prose(1, 20))]), items_frame(spark, ITEMS)
    assert decontam.contamination(docs, items.limit(0)).collect()[0].contaminated is False
    assert decontam.contamination(docs.limit(0), items).count() == 0


def test_longest_overlap_matches_brute_force():
    rnd = np.random.default_rng(4)
    for _ in range(300):
        one, two = rnd.integers(0, 2, rnd.integers(1, 25)), rnd.integers(0, 2, rnd.integers(1, 15))
        shift = int(rnd.integers(-8, 20))
        pairs = [(i + shift, i) for i in range(len(two)) if 0 <= i + shift < len(one)]
        equal = [one[a] == two[b] for a, b in pairs]
        want = max([j - i for i in range(len(equal)) for j in range(i + 1, len(equal) + 1)
                    if (equal[i] or pairs[i][1] == 0)
                    and (equal[j - 1] or pairs[j - 1][1] == len(two) - 1)
                    and sum(equal[i:j]) * 5 >= 4 * (j - i)], default=0)
        assert decontam.longest_overlap(one, two, shift)[0] == want
