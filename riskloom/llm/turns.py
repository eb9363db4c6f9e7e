"""Repair of conversations by cheapest edits, streamed turn by turn.

Rows are dealt out by conversation and sorted by turn, and each task reads its conversations
as a stream. The state of the dynamic programme is small: for each state of the pattern
``(s?(ua)+)?`` the least cost, the order of the audits that reach it, and the running hash of
the text repaired so far. It is carried from Arrow batch to Arrow batch, so a conversation may
be longer than any of them. One byte for each row and state leads back to the audit; of giant
conversations these bytes go to the shared folder in blocks and are read back from the end.

Whether a text came up earlier in its conversation is worked out before, by aggregation: rows
that mark a repeated text are sorted in just before the rows they mark, so that a task never
holds the texts of a conversation.
"""

from __future__ import annotations

import hashlib
import posixpath
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import filesystem, ship_code
from riskloom.session import scratch_dir

# Costs of the edits, roles, white space and ends of sentences.
RETITLE, REMOVE, ADD, CUT_SHORT = 1, 2, 5, 5
ROLES = {"u": "user", "a": "assistant"}
WHITE = " \t\n\x0b\x0c\r"
SENTENCE_ENDS = ".!?"
LEGAL = {"su", "ua", "au"}

#: States of the pattern: nothing yet, after s, after u, after a.
NOTHING, AFTER_S, AFTER_U, AFTER_A = range(4)
_NEXT = {(NOTHING, "s"): AFTER_S, (NOTHING, "u"): AFTER_U, (AFTER_S, "u"): AFTER_U,
         (AFTER_U, "a"): AFTER_A, (AFTER_A, "u"): AFTER_U}
#: The roles that may be inserted, none, one or two, and the state they lead to.
_ADDED = {NOTHING: ["", "u", "ua"], AFTER_S: ["", "u", "ua"], AFTER_U: ["", "a", "au"],
          AFTER_A: ["", "u", "ua"]}
_LETTERS = "DKR"
_UNREACHED = 255
#: A state that costs more than this beyond the cheapest cannot win any more: two insertions
#: and one deletion follow any course from another state.
SLACK = 2 * ADD + REMOVE
#: Bytes of backpointers that are held before a block is written.
SPILL_BYTES = 16 << 20


def _after(state: int, roles: str) -> int:
    for role in roles:
        state = _NEXT[state, role]
    return state


class Pattern:
    """Steps of the programme, each worked out once for each kind of row.

    A key is a tuple of ``(state, cost above the least, rank of its audit)``. Audits are
    compared without being held: a row adds as many I as it needs and one other letter, and
    no such token begins another, so the order after a row follows from the order before it.
    """

    def __init__(self):
        self.known: dict[tuple, tuple] = {}

    def step(self, key: tuple, kind: tuple[str, bool, bool]) -> tuple:
        """``(new key, added cost, backpointers, moves)`` for a row of a kind.

        A kind is the role's initial, whether the row must go, and whether it is cut short.
        A move is ``(new state, old state, inserted roles, letter, role)``.
        """
        found = self.known.get((key, kind))
        if found is None:
            found = self.known[key, kind] = self._step(key, kind)
        return found

    def _step(self, key: tuple, kind: tuple[str, bool, bool]) -> tuple:
        initial, must_go, cut_short = kind
        extra = CUT_SHORT if cut_short else 0
        best: dict[int, tuple] = {}
        for old, cost, rank in key:
            for roles in _ADDED[old]:
                state, paid = _after(old, roles), cost + ADD * len(roles)
                edits = [("D", REMOVE, "", state)]
                if not must_go:
                    edits += [("K", extra, initial, _NEXT.get((state, initial)))]
                    edits += [("R", RETITLE + extra, r, _NEXT.get((state, r))) for r in ROLES]
                for letter, more, role, new in edits:
                    if new is None:
                        continue
                    offer = (paid + more, rank, "I" * len(roles) + letter, old, roles, letter, role)
                    if new not in best or offer[:3] < best[new][:3]:
                        best[new] = offer
        least = min(o[0] for o in best.values())
        best = {s: o for s, o in best.items() if o[0] <= least + SLACK}
        order = {s: i for i, s in enumerate(sorted(best, key=lambda s: best[s][1:3]))}
        back = bytes(
            best[s][3] << 4 | len(best[s][4]) << 2 | _LETTERS.index(best[s][5])
            if s in best else _UNREACHED for s in range(4))
        moves = [(s, o[3], o[4], o[5], o[6]) for s, o in sorted(best.items())]
        return (tuple((s, best[s][0] - least, order[s]) for s in sorted(best)), least, back, moves)

    def end(self, key: tuple) -> tuple[int, int, str]:
        """Least further cost, the state it ends from, and the roles still to be inserted."""
        offers = [(cost + ADD * len(roles), rank, "I" * len(roles), state, roles)
                  for state, cost, rank in key for roles in _ADDED[state]
                  if _after(state, roles) in (NOTHING, AFTER_A)]
        cost, _, _, state, roles = min(offers)
        return cost, state, roles


class Trail:
    """Backpointers of one conversation; blocks beyond ``SPILL_BYTES`` lie in the shared folder."""

    def __init__(self, folder: str):
        self.folder = folder
        self.held = bytearray()
        self.blocks: list[str] = []

    def add(self, back: bytes) -> None:
        self.held += back
        if len(self.held) >= SPILL_BYTES:
            store, base = filesystem(self.folder)
            store.create_dir(base, recursive=True)
            path = posixpath.join(base, uuid.uuid4().hex)
            with store.open_output_stream(path) as out:
                out.write(bytes(self.held))
            self.blocks.append(path)
            self.held.clear()

    def back(self, state: int, roles: str) -> str:
        """The audit that ends in ``state`` and then inserts ``roles``."""
        parts = ["I" * len(roles)]
        held = bytes(self.held)
        while True:
            letters = []
            for at in range(len(held) - 4, -1, -4):
                code = held[at + state]
                letters.append(_LETTERS[code & 3] + "I" * (code >> 2 & 3))
                state = code >> 4
            # Each token was written backwards, its insertions behind its letter.
            parts.append("".join(letters))
            if not self.blocks:
                break
            store, _ = filesystem(self.folder)
            path = self.blocks.pop()
            with store.open_input_stream(path) as source:
                held = source.read()
            store.delete_file(path)
        return "".join(parts)[::-1]


class Conversation:
    """The running state of one conversation."""

    def __init__(self, conv_id: str | None, pattern: Pattern, folder: str):
        self.conv_id, self.pattern = conv_id, pattern
        self.key: tuple = ((NOTHING, 0, 0),)
        self.cost = 0
        self.hashes = {NOTHING: hashlib.sha256()}
        self.trail = Trail(folder)
        self.faults = {"blank": 0, "duplicate": 0, "truncated": 0}
        self.illegal = 0
        self.initial: str | None = None
        self.low = self.high = self.turn = None
        self.turns = 0
        self.marked: bytes | None = None
        self.last: tuple | None = None

    def mark(self, turn: str, digest: bytes) -> None:
        self.marked = (turn, digest)

    def row(self, turn: str | None, digest: bytes, role: str, text: str) -> None:
        if turn is not None and turn != self.turn:
            number = int(turn)
            self.low = number if self.low is None else self.low
            self.high, self.turn, self.turns = number, turn, self.turns + 1
        solid = text.rstrip(WHITE)
        here = (turn, digest)
        blank = not solid
        duplicate = not blank and here in (self.marked, self.last)
        short = not blank and not duplicate and solid[-1] not in SENTENCE_ENDS
        self.last = here
        for name, found in (("blank", blank), ("duplicate", duplicate), ("truncated", short)):
            self.faults[name] += found
        initial = role[:1]
        if self.initial is not None and self.initial + initial not in LEGAL:
            self.illegal += 1
        self.initial = initial
        self.key, added, back, moves = self.pattern.step(self.key, (initial, blank or duplicate, short))
        self.cost += added
        self.trail.add(back)
        hashes = {}
        kept: bytes | None = None
        body = None
        for new, old, roles, letter, named in moves:
            if letter == "D" and not roles:
                hashes[new] = self.hashes[old]
                continue
            running = self.hashes[old].copy()
            begun = old != NOTHING
            for r in roles:
                running.update(f"{chr(10) if begun else ''}{ROLES[r]}:".encode())
                begun = True
            if letter != "D":
                if begun:
                    running.update(b"\n")
                if letter == "K":
                    kept = kept or f"{role}:{text}".encode()
                    running.update(kept)
                else:
                    body = body or f":{text}".encode()
                    running.update(ROLES[named].encode())
                    running.update(body)
            hashes[new] = running
        self.hashes = hashes

    def result(self) -> tuple:
        more, state, roles = self.pattern.end(self.key)
        running = self.hashes[state].copy()
        for i, r in enumerate(roles):
            running.update(f"{chr(10) if i or state != NOTHING else ''}{ROLES[r]}:".encode())
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return (self.conv_id, gaps, *self.faults.values(), self.illegal, self.cost + more,
                self.trail.back(state, roles), running.hexdigest())


_RESULT = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit",
           "repaired_sha256"]


def _spaced(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(" "))


def prepared(turns: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, gone``: null roles and texts are one space."""
    gone = (F.coalesce(F.col("gone").cast("boolean"), F.lit(False)) if "gone" in turns.columns
            else F.lit(False))
    return turns.select("conv_id", "turn", _spaced("role").alias("role"),
                        _spaced("text").alias("text"), gone.alias("gone"))


def _digest() -> Column:
    """Of role and text together; the length tells where the role ends."""
    return F.unhex(F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")))


def repeat_marks(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, digest`` of each text that an earlier turn of the conversation has.

    Equal rows collapse in the map tasks, and only texts of several turns are joined.
    """
    places = rows.groupBy("conv_id", "digest", "turn").agg(F.count(F.lit(1)).alias("n"))
    firsts = (places.groupBy("conv_id", "digest")
              .agg(F.min(F.struct("turn")).alias("first"), F.count(F.lit(1)).alias("turns"))
              .filter("turns > 1")
              .select(F.col("conv_id").alias("of"), F.col("digest").alias("same"), "first"))
    met = places.join(firsts, F.col("conv_id").eqNullSafe(F.col("of"))
                      & (F.col("digest") == F.col("same")))
    return met.filter(F.struct("turn") > F.col("first")).select("conv_id", "turn", "digest")


def _streamed(rows: DataFrame, order: list[Column | str]) -> DataFrame:
    """Conversations dealt to tasks, each sorted; ids and turns as text, which keeps nulls."""
    dealt = rows.repartition("conv_id").sortWithinPartitions("conv_id", *order)
    return dealt.withColumns({"conv_id": F.col("conv_id").cast("string"),
                              "turn": F.col("turn").cast("string")})


def repair(turns: DataFrame) -> DataFrame:
    """Faults, least cost, audit and hash of the repaired text of each conversation.

    ``turns`` has ``conv_id, turn, role, text``, null roles and texts being one space; rows
    with a true ``gone``, if there is that column, only name their conversation. Rows are taken
    by turn, null turns first; rows of one turn by the MD5 digest of role and text. A row's
    first fault counts: blank, duplicate (role and text came up earlier), truncated. Rows may be kept,
    given the role user or assistant (1), deleted (2, which blank and duplicate rows must be),
    and empty rows of either role inserted (5); a truncated row that stays costs 5. The role
    initials that come out match ``(s?(ua)+)?``; of equally cheap audits the first one is
    taken. A null ``conv_id`` is a conversation of its own. No rows give no rows.
    """
    spark = turns.sparkSession
    ship_code(spark)
    folder = scratch_dir(spark, "backpointers")
    rows = prepared(turns).withColumn("digest", F.when(~F.col("gone"), _digest()))
    marks = repeat_marks(rows.filter(~F.col("gone")))
    marked = rows.withColumn("kind", F.lit(1)).unionByName(
        marks.withColumn("kind", F.lit(0)), allowMissingColumns=True)

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pattern, current, done = Pattern(), None, []
        for frame in frames:
            for conv_id, turn, digest, kind, gone, role, text in zip(*(
                    frame[c].tolist() for c in ("conv_id", "turn", "digest", "kind", "gone",
                                                "role", "text"))):
                if current is None or current.conv_id != conv_id:
                    if current is not None:
                        done.append(current.result())
                    current = Conversation(conv_id, pattern, folder)
                if kind == 0:
                    current.mark(turn, bytes(digest))
                elif not gone:
                    current.row(turn, bytes(digest), role, text)
            if done:
                yield pd.DataFrame(done, columns=_RESULT)
                done = []
        if current is not None:
            yield pd.DataFrame([current.result()], columns=_RESULT)

    found = _streamed(marked, ["turn", "digest", "kind"]).mapInPandas(
        work, "conv_id string, gaps bigint, blank bigint, duplicate bigint, truncated bigint, "
              "illegal bigint, cost bigint, audit string, repaired_sha256 string")
    return found.withColumn("conv_id", F.col("conv_id").cast(turns.schema["conv_id"].dataType))


def repaired_turns(turns: DataFrame, repairs: DataFrame) -> DataFrame:
    """The rows that stay and those inserted: ``conv_id, place, turn, role, text, edit``.

    ``repairs`` is the result of :func:`repair` for these turns. ``place`` counts from 0; an
    inserted row has no turn.
    """
    ship_code(turns.sparkSession)
    kept = prepared(turns).filter(~F.col("gone")).drop("gone").withColumn("digest", _digest())
    audits = repairs.select("conv_id", "audit").withColumn("kind", F.lit(0))
    rows = kept.withColumn("kind", F.lit(1)).unionByName(audits, allowMissingColumns=True)
    columns = ["conv_id", "place", "turn", "role", "text", "edit"]

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        audit, at, state, place, conv = "", 0, NOTHING, 0, None
        for frame in frames:
            out = []

            def put(turn, role, text, edit):
                nonlocal state, place
                out.append((conv, place, turn, role, text, edit))
                state, place = _NEXT[state, role[:1]], place + 1

            def insert():
                nonlocal at
                while audit[at:at + 1] == "I":
                    put(None, ROLES["a" if state == AFTER_U else "u"], "", "I")
                    at += 1

            for conv_id, turn, kind, role, text, letters in zip(*(
                    frame[c].tolist() for c in ("conv_id", "turn", "kind", "role", "text",
                                                "audit"))):
                if kind == 0:
                    insert()
                    audit, at, state, place, conv = letters, 0, NOTHING, 0, conv_id
                    continue
                insert()
                letter, at = audit[at], at + 1
                if letter == "K":
                    put(turn, role, text, "K")
                elif letter == "R":
                    put(turn, ROLES["a" if state == AFTER_U else "u"], text, "R")
                if at == len(audit.rstrip("I")):
                    insert()
            if out:
                yield pd.DataFrame(out, columns=columns)

    found = _streamed(rows, ["kind", "turn", "digest"]).mapInPandas(
        work, "conv_id string, place bigint, turn string, role string, text string, edit string")
    return found.withColumns({c: F.col(c).cast(turns.schema[c].dataType)
                              for c in ("conv_id", "turn")})


def damage(conversations: DataFrame) -> DataFrame:
    """``conversations`` with faults of known kinds, and ``gone`` for the rows dropped.

    By the remainder of crc32 of ``conv_id:turn`` (nulls: one space) by 20: 0 drops a row, 1
    empties its text, 2 takes the ends of sentences out of it, 3 repeats it, 4 makes it the
    user's.
    """
    name = F.concat(_spaced("conv_id"), F.lit(":"), _spaced("turn"))
    fate = F.crc32(name.cast("binary")) % 20
    text = F.when(F.col("fate") == 1, "").when(
        F.col("fate") == 2, F.translate("text", SENTENCE_ENDS, "")).otherwise(F.col("text"))
    copies = F.sequence(F.lit(1), F.when(F.col("fate") == 3, 2).otherwise(1))
    gone = F.col("fate") == 0
    return (conversations.select("conv_id", "turn", _spaced("role").alias("role"),
                                 _spaced("text").alias("text"), fate.alias("fate"))
            .select("conv_id", "turn",
                    F.when(gone, None).when(F.col("fate") == 4, "user")
                    .otherwise(F.col("role")).alias("role"),
                    F.when(gone, None).otherwise(text).alias("text"),
                    gone.alias("gone"), F.explode(copies).alias("copy"))
            .drop("copy"))


def damaged_and_repaired(conversations: DataFrame) -> DataFrame:
    """:func:`repair` of :func:`damage`: a row for each ``conv_id`` there was before.

    Null ids, turns, roles and texts, repeated rows and other columns are taken as these two
    functions say; a conversation that lost all rows has zeros, an empty audit and the hash of
    the empty text.
    """
    return repair(damage(conversations)).select(*_RESULT)
