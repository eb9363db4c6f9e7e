"""Personal data in whole texts, found by weak supervision.

Strict patterns give the base spans, which always stay. Looser patterns give further
candidates. On each candidate labelers vote for, against or not at all: a strict pattern, a
loose pattern, a check of the digits, gazetteers, and cue words nearby. The votes of the whole
corpus are counted by pattern, expectation-maximisation estimates from these counts how
reliable each labeler is, and its posteriors train the classifier that settles candidates.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import ship_code, slices, text_of, written

KINDS = ["email", "ip", "card", "phone"]
LABELERS = ["strict", "loose", "digits", "gazetteer", "cue", "counter_cue"]
#: Characters before and after a candidate in which cue words are looked for.
NEARBY = 40

# The gazetteers and cue words of the labelers.
TOP_DOMAINS = {"com", "org", "net", "edu", "gov", "info", "io", "de", "fr", "es", "uk", "eu"}
CARD_PREFIXES = ("34", "37", "4", "51", "52", "53", "54", "55", "60", "62", "65")
RESERVED_NETS = {0, 127, 255}
CUES = {
    "email": {"mail", "email", "contact", "write", "correo", "courriel", "kontakt", "address"},
    "ip": {"ip", "host", "server", "address", "login", "client", "router", "port"},
    "card": {"card", "visa", "credit", "payment", "tarjeta", "carte", "karte", "amex"},
    "phone": {"call", "phone", "tel", "mobile", "fax", "telefon", "telefono", "cell", "sms"},
}
COUNTER_CUES = {"version", "order", "invoice", "isbn", "serial", "page", "chapter", "section",
                "id", "release", "figure", "table"}

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A run of digits is taken from its first one on, so that long runs are read once.
_QUAD = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_RUN = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PLUS = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_LOCAL_PHONE = re.compile(
    r"(?<![0-9+.-])(?<![0-9] )\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])")
_SPELLED = re.compile(
    r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64} ?(?:\(at\)|\[at\]| at ) ?[A-Za-z0-9-]{1,63}"
    r"(?: ?(?:\(dot\)|\[dot\]| dot ) ?[A-Za-z0-9-]{1,63})+")
_WORD = re.compile(r"[a-z]+")

Span = tuple[str, int, int]


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def luhn(digits: str) -> bool:
    doubled = sum(sum(divmod(2 * int(c), 10)) for c in digits[-2::-2])
    return (sum(map(int, digits[::-2])) + doubled) % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches, found from the ``@`` signs: each has a run of its own before it."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            end = domain.end()
            yield start, end
        at = text.find("@", max(end, at + 1))


def _sound_quad(text: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in text.split("."))


def _sound_card(text: str) -> bool:
    digits = _digits(text)
    return 16 <= len(digits) <= 19 and luhn(digits)


def base_spans(text: str) -> list[Span]:
    """Email, ip, card and phone by strict patterns: by kind, then by start."""
    found = [("email", *x) for x in _emails(text)]
    found += [("ip", *m.span()) for m in _QUAD.finditer(text) if _sound_quad(m[0])]
    found += [("card", *m.span()) for m in _RUN.finditer(text) if _sound_card(m[0])]
    if "+" in text:
        found += [("phone", *m.span()) for m in _PLUS.finditer(text)
                  if 8 <= len(_digits(m[0])) <= 15]
    return found


def loose_spans(text: str) -> list[Span]:
    """What might be personal data besides the base spans."""
    found = [("phone", *m.span()) for m in _LOCAL_PHONE.finditer(text)]
    found += [("card", *m.span()) for m in _RUN.finditer(text)
              if 13 <= len(_digits(m[0])) <= 19 and not _sound_card(m[0])]
    if "dot" in text:
        found += [("email", *m.span()) for m in _SPELLED.finditer(text)]
    return found


def _gazetteer(kind: str, value: str) -> int:
    if kind == "email":
        return int(re.split(r"[^A-Za-z0-9]+", value.lower().rstrip(")]"))[-1] in TOP_DOMAINS)
    if kind == "card":
        return int(_digits(value).startswith(CARD_PREFIXES))
    if kind == "ip":
        return int(int(value.split(".")[0]) not in RESERVED_NETS)
    return -1


def _sound_digits(kind: str, value: str) -> int:
    digits = _digits(value)
    if kind == "card":
        return int(luhn(digits))
    if kind == "ip":
        return int(_sound_quad(value))
    if kind == "phone":
        return int(8 <= len(digits) <= 15 and len(set(digits[-7:])) > 2)
    return -1


def votes(text: str, span: Span, strict: bool) -> list[int]:
    """1, 0 or -1 (no vote) of each labeler."""
    kind, start, end = span
    value = text[start:end]
    words = set(_WORD.findall(text[max(0, start - NEARBY):start].lower()))
    words |= set(_WORD.findall(text[end:end + NEARBY].lower()))
    cue = 1 if words & CUES[kind] else -1
    counter = 0 if words & COUNTER_CUES else -1
    return [int(strict), 1, _sound_digits(kind, value), _gazetteer(kind, value), cue, counter]


def _side(text: str, at: int) -> int:
    if not 0 <= at < len(text):
        return 0
    c = text[at]
    return 1 if c.isspace() else 2 if c.isalnum() else 3


def features(text: str, span: Span, strict: bool) -> str:
    """What the classifier sees of a candidate, as a short code with few values."""
    kind, start, end = span
    code = "".join({-1: "-", 0: "0", 1: "1"}[v] for v in votes(text, span, strict))
    return (f"{KINDS.index(kind)}{code}{_side(text, start - 1)}{_side(text, end)}"
            f"{min(3, (end - start) // 8)}")


def _vector(code: str) -> np.ndarray:
    n = len(LABELERS)
    kind = np.eye(len(KINDS))[int(code[0])]
    marks = np.array([[c == "1", c == "0"] for c in code[1:n + 1]], float).ravel()
    sides = np.concatenate([np.eye(4)[int(c)] for c in code[n + 1:]])
    return np.concatenate([[1.0], kind, marks, sides])


def estimate(codes: list[str], counts: np.ndarray, rounds: int = 60) -> np.ndarray:
    """Posterior of each vote pattern, its labelers being independent given the truth.

    Kinds have rates of their own; the labelers' reliabilities are shared. A little
    pseudo-evidence holds each labeler on the better side of chance.
    """
    n = len(LABELERS)
    marks = np.array([[{"-": 2, "0": 0, "1": 1}[c] for c in code[1:n + 1]] for code in codes])
    kinds = np.array([int(code[0]) for code in codes])
    strict = marks[:, 0] == 1
    posterior = np.where(strict, .95, np.clip(
        ((marks == 1).sum(axis=1) - 2 * (marks == 0).sum(axis=1)) / 8, .05, .9))
    prior_weight = 10.0
    for _ in range(rounds):
        odds = np.zeros(len(codes))
        for k in range(len(KINDS)):
            own = kinds == k
            rate = ((counts * posterior)[own].sum() + 1) / (counts[own].sum() + 2)
            odds[own] = np.log(rate / (1 - rate))
        for j in range(n):
            true, false = np.array([1., 4., 5.]), np.array([4., 1., 5.])
            true, false = true * prior_weight / 10, false * prior_weight / 10
            for v in range(3):
                hit = marks[:, j] == v
                true[v] += (counts * posterior)[hit].sum()
                false[v] += (counts * (1 - posterior))[hit].sum()
            ratio = np.log(true / true.sum()) - np.log(false / false.sum())
            odds += ratio[marks[:, j]]
        posterior = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
    return posterior


class SpanClassifier:
    """Logistic regression on the candidates' codes, fitted to posteriors by Newton steps."""

    def __init__(self, codes: list[str], counts: np.ndarray, posteriors: np.ndarray,
                 ridge: float = 1.0, steps: int = 25):
        width = len(_vector("0" + "-" * len(LABELERS) + "000"))
        self.weights = np.zeros(width)
        if not codes:
            return
        x = np.array([_vector(c) for c in codes])
        # Ten times as many copies of a pattern say little more about it.
        weight = np.sqrt(counts)
        for _ in range(steps):
            p = 1 / (1 + np.exp(-np.clip(x @ self.weights, -30, 30)))
            slope = x.T @ (weight * (p - posteriors)) + ridge * self.weights
            curve = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge * np.eye(width)
            self.weights -= np.linalg.solve(curve, slope)

    def accepts(self, code: str) -> bool:
        """At least even odds, and a sound check of the digits where there is one."""
        return code[3] != "0" and float(_vector(code) @ self.weights) >= 0


_FOUND = ("doc_id bigint, base array<struct<kind:int,start:int,end:int,code:string>>, "
          "loose array<struct<kind:int,start:int,end:int,code:string>>")
_SPANS = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32()),
                             ("code", pa.string())]))


def candidates(text: str | None) -> tuple[list[dict], list[dict]]:
    """Base spans and looser ones with their codes; those that touch a base span are left out."""
    text = text or ""
    describe = lambda s, strict: {"kind": KINDS.index(s[0]), "start": s[1], "end": s[2],
                                  "code": features(text, s, strict)}
    base = base_spans(text)
    taken = [(s, e) for _, s, e in base]
    free = [x for x in loose_spans(text) if not any(x[1] < e and s < x[2] for s, e in taken)]
    return [describe(s, True) for s in base], [describe(s, False) for s in free]


def _extract(docs: DataFrame) -> DataFrame:
    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [candidates(t) for t in batch.column(1).to_pylist()]
            yield pa.record_batch({"doc_id": batch.column(0),
                                   "base": pa.array([b for b, _ in found], _SPANS),
                                   "loose": pa.array([x for _, x in found], _SPANS)})

    return docs.select("doc_id", text_of().alias("text")).mapInArrow(extract, _FOUND)


def train(extracted: DataFrame) -> SpanClassifier:
    """From the numbers of all candidates by code: at most a few ten thousand codes exist."""
    codes = (extracted.select(F.explode(F.concat("base", "loose")).alias("span"))
             .groupBy("span.code").agg(F.count(F.lit(1)).alias("n")).orderBy("code").toPandas())
    names, counts = codes["code"].tolist(), codes["n"].to_numpy(float)
    return SpanClassifier(names, counts, estimate(names, counts) if names else np.zeros(0))


def _joined(spans: list[dict]) -> str:
    order = sorted(spans, key=lambda s: (s["kind"], s["start"], s["end"]))
    return ",".join(f"{KINDS[s['kind']]}:{s['start']}:{s['end']}" for s in order)


_DIGEST = ("doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, "
           "base_sha256 string, spans string")


def find_spans(docs: DataFrame) -> DataFrame:
    """Personal data of every row of ``docs(doc_id, text)``.

    ``n_<kind>`` and ``base_sha256`` describe the base spans, ``spans`` lists all as
    ``kind:start:end`` in code points. Null and empty texts have none. Repeated rows give
    repeated results; further columns are ignored.
    """
    ship_code(docs.sparkSession)
    extracted = written(_extract(docs), "personal-data")
    shared = docs.sparkSession.sparkContext.broadcast(train(extracted))

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base, loose = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            counts = [[sum(s["kind"] == k for s in b) for b in base] for k in range(len(KINDS))]
            every = [b + [s for s in x if shared.value.accepts(s["code"])]
                     for b, x in zip(base, loose)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.int64()) for c in counts),
                 pa.array([hashlib.sha256(_joined(b).encode()).hexdigest() for b in base]),
                 pa.array([_joined(s) for s in every], pa.string())],
                names=["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"])

    return extracted.mapInArrow(settle, _DIGEST)


def masked(text: str, spans: list[dict]) -> str:
    """The text with each span, or run of overlapping ones, replaced by its kind."""
    out, at, until = [], 0, -1
    for span in sorted(spans, key=lambda s: (s["start"], -s["end"])):
        if span["start"] >= until:
            out += [text[at:span["start"]], f"[{KINDS[span['kind']].upper()}]"]
        until = max(until, span["end"])
        at = until
    return "".join(out) + text[at:]


def mask(docs: DataFrame) -> DataFrame:
    """``docs`` with personal data in ``text`` replaced; null texts stay null."""
    ship_code(docs.sparkSession)
    extracted = _extract(docs)
    shared = docs.sparkSession.sparkContext.broadcast(train(extracted))
    at = docs.columns.index("text")

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, at):
            texts = []
            for text in batch.column(at).to_pylist():
                base, loose = candidates(text)
                spans = base + [s for s in loose if shared.value.accepts(s["code"])]
                texts.append(masked(text, spans) if spans else text)
            columns = [*batch.columns]
            columns[at] = pa.array(texts, batch.schema.field(at).type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return docs.mapInArrow(clean, docs.schema)
