import hashlib
import itertools
import re
import zlib
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from riskloom.llm import turns

SCHEMA = ("conv_id long, turn long, role string, text string, kind string, digest string, "
          "gone_by string, audit string")
ROLE = {"u": "user", "a": "assistant"}
WANTED = re.compile(r"(s?(ua)+)?")


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "x", "x", "x") for r in rows], SCHEMA)


def md5(role, text):
    return hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()


def damage(rows):
    """The rows that are left, and all ids."""
    left = defaultdict(list)
    for conv, turn, role, text in rows:
        left[conv]
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        role, text = (" " if x is None else x for x in (role, text))
        fate = zlib.crc32(name.encode()) % 20
        if fate == 0:
            continue
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        role = "user" if fate == 4 else role
        left[conv] += [(turn, role, text)] * (2 if fate == 3 else 1)
    return left


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        solid = re.sub(r"[\x20\x09-\x0D]", "", text)
        out.append("blank" if not solid else "duplicate" if (role, text) in seen
                   else "truncated" if solid[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def cheapest(rows, found, inserts=2):
    """Every course of edits with up to ``inserts`` insertions; the least (cost, audit)."""
    best = None
    for letters in itertools.product("DKR", repeat=len(rows)):
        if any(f in ("blank", "duplicate") and x != "D" for f, x in zip(found, letters)):
            continue
        cost = sum({"D": 2, "K": 0, "R": 1}[x] + (5 if f == "truncated" and x != "D" else 0)
                   for f, x in zip(found, letters))
        slots = range(len(rows) + 1)
        for many in range(inserts + 1):
            if best and cost + 5 * many > best[0]:
                break
            for places in itertools.combinations_with_replacement(slots, many):
                audit, out = "", []
                for i in slots:
                    audit += "I" * places.count(i)
                    out += [("I", None)] * places.count(i)
                    if i < len(rows):
                        audit += letters[i]
                        out += [(letters[i], rows[i])] * (letters[i] != "D")
                if best and (cost + 5 * many, audit) >= best[:2]:
                    continue
                begins = len(out) % 2
                want = "s" * begins + "ua" * (len(out) // 2)
                if begins and len(out) == 1:
                    continue
                if all(x[0] in "IR" and w != "s" or x[0] == "K" and x[1][1][:1] == w
                       for x, w in zip(out, want)):
                    lines = [f"{x[1][1]}:{x[1][2]}" if x[0] == "K" else
                             f"{ROLE[w]}:{x[1][2] if x[1] else ''}" for x, w in zip(out, want)]
                    best = (cost + 5 * many, audit, "\n".join(lines))
    return best


def brute(rows):
    out = []
    for conv, left in damage(rows).items():
        left.sort(key=lambda r: (r[0] is not None, r[0] or 0, md5(r[1], r[2])))
        found = faults(left)
        numbers = [t for t, _, _ in left if t is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        initials = [r[1][:1] for r in left]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, audit, text = cheapest(left, found)
        count = Counter(found)
        out.append((conv, gaps, count["blank"], count["duplicate"], count["truncated"], illegal,
                    cost, audit, hashlib.sha256(text.encode()).hexdigest()))
    return out


def by_id(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: (r[0] is None, r[0] or 0))


TEXTS = ["Yes.", "No!", "cut", " ", "", "Why? ", "Yes.", "a.\n"]


def some_rows(seed, conversations):
    import random
    rnd = random.Random(seed)
    rows = []
    for conv in range(conversations):
        for turn in range(rnd.randint(1, 6)):
            rows.append((conv, rnd.choice([turn, turn, turn, turn + 3, None]),
                         rnd.choice(["system", "user", "assistant", "user", "assistant", "tool",
                                     "", None]),
                         rnd.choice(TEXTS + [None, f"t{turn}."])))
    return rows


def test_repairs_are_those_of_brute_force(spark):
    rows = some_rows(1, 120)
    rows += [(None, 0, "user", "Hi."), (None, 1, "assistant", "Ho."), (None, None, None, None)]
    rows += [(900, 5, "user", "Same."), (900, 5, "user", "Same."), (900, 9, "assistant", "Yes."),
             (901, -4, "system", "Be."), (902, None, "user", "x."), (902, None, "assistant", "y.")]
    # A conversation of which nothing is left.
    lost = next(i for i in range(1000, 9999) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    rows.append((lost, 0, "user", "Hi."))
    df = turns.damaged_and_repaired(frame(spark, rows).repartition(5))
    assert df.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost",
                          "audit", "repaired_sha256"]
    got, want = by_id(df.collect()), by_id(brute(rows))
    assert got == want
    assert (lost, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) in got


def test_no_rows_give_no_rows(spark):
    assert turns.damaged_and_repaired(frame(spark, []).limit(0)).collect() == []


ROWS = st.lists(st.tuples(st.sampled_from(["system", "user", "assistant", "x", ""]),
                          st.sampled_from(["Yes.", "cut", "", "No."])), max_size=7)


@settings(max_examples=150, deadline=None)
@given(rows=ROWS, insert=st.booleans())
def test_the_stream_finds_the_first_of_the_cheapest_audits(rows, insert):
    rows = [(i, role, text) for i, (role, text) in enumerate(rows)]
    found = faults(rows)
    one, last = turns.Conversation("1", turns.Pattern(), ""), {}
    for turn, role, text in rows:
        digest = md5(role, text)
        if digest in last:
            one.mark(str(turn), digest)
        last[digest] = turn
        one.row(str(turn), digest, role, text)
    result = dict(zip(turns._RESULT, one.result()))
    cost, audit, text = cheapest(rows, found, 2 if len(rows) < 6 else 1)
    assert (result["cost"], result["audit"]) == (cost, audit)
    assert result["repaired_sha256"] == hashlib.sha256(text.encode()).hexdigest()


@settings(max_examples=60, deadline=None)
@given(rows=ROWS)
def test_cheap_insertions_are_taken(rows):
    """With other prices insertions pay, and the audits compare as whole strings."""
    before = turns.ADD, turns.SLACK, turns.REMOVE
    turns.ADD, turns.REMOVE, turns.SLACK = 1, 3, 5
    try:
        rows = [(i, role, text + str(i) + ".") for i, (role, text) in enumerate(rows[:4])]
        one = turns.Conversation("1", turns.Pattern(), "")
        for turn, role, text in rows:
            one.row(str(turn), md5(role, text), role, text)
        result = dict(zip(turns._RESULT, one.result()))
        best = None
        for letters in itertools.product("DKR", repeat=len(rows)):
            for counts in itertools.product(range(3), repeat=len(rows) + 1):
                cost = sum({"D": 3, "K": 0, "R": 1}[x] for x in letters) + sum(counts)
                audit = "".join("I" * n + x for n, x in itertools.zip_longest(
                    counts, letters, fillvalue=""))
                if best and (cost, audit) >= best:
                    continue
                state, fits = 0, True
                plan = [y for n, x, r in itertools.zip_longest(counts, letters, rows)
                        for y in [("I", None)] * n + ([(x, r)] if x else [])]
                for x, r in plan:
                    if x == "D":
                        continue
                    sign = r[1][:1] if x == "K" else "a" if state == 2 else "u"
                    state = turns._NEXT.get((state, sign))
                    if state is None:
                        fits = False
                        break
                if fits and state in (0, 3):
                    best = (cost, audit)
        assert (result["cost"], result["audit"]) == best
    finally:
        turns.ADD, turns.SLACK, turns.REMOVE = before


def test_repaired_rows_follow_the_audit(spark):
    rows = [r for r in some_rows(2, 60)]
    df = frame(spark, rows)
    left = turns.damage(df)
    repairs = turns.repair(left)
    texts = defaultdict(list)
    out = turns.repaired_turns(left, repairs).collect()
    for r in sorted(out, key=lambda r: (r.conv_id, r.place)):
        texts[r.conv_id].append(f"{r.role}:{r.text}")
    for r in repairs.collect():
        lines = texts.get(r.conv_id, [])
        assert hashlib.sha256("\n".join(lines).encode()).hexdigest() == r.repaired_sha256
        assert WANTED.fullmatch("".join(x[0] for x in lines))


def test_a_giant_conversation_spills_its_trail(spark, monkeypatch, tmp_path):
    """The state crosses Arrow batches and blocks of backpointers."""
    monkeypatch.setattr(turns, "SPILL_BYTES", 64)
    kinds = [("user", "Q%d?"), ("assistant", "A%d."), ("user", ""), ("user", "again."),
             ("assistant", "cut %d")]
    rows = [(str(i), *(kinds[i * 7 % 5][0], kinds[i * 7 % 5][1].replace("%d", str(i))))
            for i in range(500)]
    held, spilt = (turns.Conversation("1", turns.Pattern(), str(tmp_path / "trail"))
                   for _ in range(2))
    spilt.trail.folder = str(tmp_path / "other")
    seen = set()
    for one, most in ((held, 1 << 30), (spilt, 64)):
        monkeypatch.setattr(turns, "SPILL_BYTES", most)
        seen.clear()
        for turn, role, text in rows:
            digest = md5(role, text)
            if digest in seen:
                one.mark(turn, digest)
            seen.add(digest)
            one.row(turn, digest, role, text)
    assert len(spilt.trail.blocks) > 20 and not held.trail.blocks
    assert held.result() == spilt.result()
    assert not list((tmp_path / "other").iterdir())
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        table = frame(spark, [(1, int(t), r, x) for t, r, x in rows])
        got = turns.repair(table).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(got) == 1 and got[0].audit == held.trail.back(*turns.Pattern().end(held.key)[1:])
    assert got[0].cost == spilt.cost + turns.Pattern().end(spilt.key)[0]
