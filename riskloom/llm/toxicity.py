"""Toxicity scores from a factorization machine over hashed terms.

A document is the set of its words, hashed into ``BUCKETS``. Its logit is a bias, a weight
for each term and, for each pair of terms, the inner product of their factors, so that two
terms that are harmless alone can count together. The model is fitted on a bounded sample of
labelled documents, with weights and factors for every term of the sample. Noise is shrunk by
decay: a weight by as much as the term's counts in the two classes look like chance, factors
all alike, so that a pair counts whose single terms do not tell. Scoring then runs over every
whole text with a model of bounded size.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.common import ship_code, slices, text_of, written

BUCKETS = 1 << 20
#: Labelled documents that the model is fitted on, taken in the order of their hashed ids.
SAMPLE_ROWS = 10_000
#: Bytes of their hashed terms, of 4 bytes each; the first document is taken whatever its size.
SAMPLE_BYTES = 64 << 20
FACTORS = 8
#: Prior variance of the weight of a term that surely tells.
WEIGHT_VARIANCE = 100.0
#: Gathered entries at a time, and the steps that the minimiser remembers.
CHUNK = 1 << 18
REMEMBERED = 4

_WORD = re.compile(r"\w+")
_FEATURES = "doc_id bigint, toxic int, terms binary"


def terms_of(text: str | None) -> np.ndarray:
    """The hashed distinct words of a text; none for an empty or null one."""
    words = set(_WORD.findall((text or "").lower()))
    return np.unique(np.fromiter((zlib.crc32(w.encode()) % BUCKETS for w in words),
                                 np.uint32, len(words)))


def _sums(values: np.ndarray, at: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """For each pair of neighbouring bounds, the sum of the rows ``values[at[i]]`` between."""
    out = np.zeros((len(bounds) - 1, *values.shape[1:]), np.float32)
    some = np.flatnonzero(np.diff(bounds))
    first = 0
    while first < len(some):
        last = max(first + 1, int(np.searchsorted(bounds[some + 1],
                                                  bounds[some[first]] + CHUNK, "right")))
        begin, end = bounds[some[first]], bounds[some[last - 1] + 1]
        out[some[first:last]] = np.add.reduceat(values[at[begin:end]],
                                                bounds[some[first:last]] - begin, axis=0)
        first = last
    return out


@dataclass
class FactorizationMachine:
    terms: np.ndarray    # bucket of each row below, ascending
    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def __post_init__(self):
        self.row_of = np.full(BUCKETS, -1, np.int32)
        self.row_of[self.terms] = np.arange(len(self.terms), dtype=np.int32)

    def __reduce__(self):
        return type(self), (self.terms, self.bias, self.weights, self.factors)

    def logits(self, at: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Of documents given as sparse rows: the model's rows ``at`` between the bounds."""
        own = self.weights - (self.factors ** 2).sum(axis=1) / 2
        sums = _sums(self.factors, at, bounds)
        return self.bias + _sums(own, at, bounds) + (sums ** 2).sum(axis=1) / 2

    def rows(self, documents: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Sparse rows of documents; terms that the model does not know are none."""
        at = [self.row_of[d] for d in documents]
        at = [a[a >= 0] for a in at]
        bounds = np.concatenate([[0], np.cumsum([len(a) for a in at], dtype=np.int64)])
        return np.concatenate([np.zeros(0, np.int32), *at]), bounds.astype(np.int64)

    def score(self, texts: list[str | None]) -> np.ndarray:
        z = np.clip(self.logits(*self.rows([terms_of(t) for t in texts])), -30, 30)
        return (1 / (1 + np.exp(-z.astype(float))))


def _telling(hits: np.ndarray, misses: np.ndarray, n1: int, n0: int) -> np.ndarray:
    """The probability that a term's share of documents differs between the classes.

    Two unknown shares are weighed against one (uniform priors); how many terms differ is
    estimated from all of them. No term has 0.
    """
    logs = np.concatenate([[0], np.cumsum(np.log(np.arange(1, n1 + n0 + 2)))])  # of factorials

    def evidence(k: np.ndarray, n: int) -> np.ndarray:
        return logs[k] + logs[n - k] - logs[n + 1]

    odds = np.exp(np.clip(evidence(hits, n1) + evidence(misses, n0)
                          - evidence(hits + misses, n1 + n0), -50, 50))
    share = .01
    for _ in range(50):
        found = share * odds / (1 - share + share * odds)
        share = min(max(found.mean(), 1 / (len(odds) + 1)), .5)
    return found


def _minimise(value_and_slope, x: np.ndarray, steps: int) -> np.ndarray:
    """L-BFGS with halved steps."""
    value, slope = value_and_slope(x)
    past: list[tuple[np.ndarray, np.ndarray, float]] = []
    for _ in range(steps):
        way, shares = -slope, []
        for s, y, r in reversed(past):
            shares.append(r * float(s @ way))
            way -= np.float32(shares[-1]) * y
        if past:
            s, y, r = past[-1]
            way *= np.float32(1 / (r * float(y @ y)))
        for (s, y, r), share in zip(past, reversed(shares)):
            way += np.float32(share - r * float(y @ way)) * s
        fall = float(slope @ way)
        if not fall < -1e-9:
            break
        rate = 1.0 if past else min(1.0, 1 / float(np.sqrt(way @ way)))
        for _ in range(20):
            step = np.float32(rate) * way
            next_value, next_slope = value_and_slope(x + step)
            if next_value <= value + 1e-4 * rate * fall:
                break
            rate /= 2
        else:
            break
        change = next_slope - slope
        bend = float(step @ change)
        if bend > 1e-10:
            past = [*past[1 - REMEMBERED:], (step, change, 1 / bend)]
        gain = value - next_value
        x, value, slope = x + step, next_value, next_slope
        if gain < 1e-6 * (1 + abs(value)):
            break
    return x


def fit(documents: list[np.ndarray], toxic: np.ndarray, seed: int = 7, steps: int = 150
        ) -> FactorizationMachine:
    """Minimise the logistic loss and the decay. Without labels every score is 0.5; with labels
    of one class only, the bias alone tells."""
    toxic = np.asarray(toxic, np.float32)
    mean = (toxic.sum() + .5) / (len(toxic) + 1)
    bias = float(np.log(mean / (1 - mean)))
    n1 = int(toxic.sum())
    n0 = len(toxic) - n1
    seen = np.zeros(BUCKETS, bool)
    for d in documents:
        seen[d] = True
    terms = np.flatnonzero(seen).astype(np.uint32) if n1 and n0 else np.zeros(0, np.uint32)
    n = len(terms)
    model = FactorizationMachine(terms, bias, np.zeros(n, np.float32),
                                 np.zeros((n, FACTORS), np.float32))
    if not n:
        return model
    at, bounds = model.rows(documents)
    # The same entries by term.
    by_term = np.argsort(at, kind="stable")
    of = np.repeat(np.arange(len(documents), dtype=np.int32), np.diff(bounds))[by_term]
    term_bounds = np.searchsorted(at[by_term], np.arange(n + 1))
    del by_term
    hits = _sums(toxic, of, term_bounds).round().astype(np.int64)
    misses = np.diff(term_bounds) - hits
    spread = np.sqrt(WEIGHT_VARIANCE * _telling(hits, misses, n1, n0)).astype(np.float32)
    # A text of so many terms is a pattern of pairs of this size by itself; larger ones stay.
    per_text = len(at) / len(documents)
    decay = np.float32(max(1.0, per_text / 2))
    random = np.random.default_rng(seed)
    x = np.zeros(1 + n + n * FACTORS, np.float32)
    x[0] = bias
    x[1 + n:] = random.normal(0, (.05 / max(1.0, per_text)) ** .5, n * FACTORS)

    def put(x: np.ndarray) -> None:
        model.bias = float(x[0])
        model.weights = spread * x[1:n + 1]
        model.factors = x[n + 1:].reshape(n, FACTORS)

    def value_and_slope(x: np.ndarray) -> tuple[float, np.ndarray]:
        put(x)
        sums = _sums(model.factors, at, bounds)
        own = model.weights - (model.factors ** 2).sum(axis=1) / 2
        z = model.bias + _sums(own, at, bounds) + (sums ** 2).sum(axis=1) / 2
        z = z.astype(float)
        value = float((np.logaddexp(0, z) - toxic * z).sum()
                      + (x[1:n + 1] @ x[1:n + 1]) / 2 + decay * (x[n + 1:] @ x[n + 1:]) / 2)
        error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - toxic).astype(np.float32)
        slope = _sums(np.hstack([error[:, None], error[:, None] * sums]), of, term_bounds)
        return value, np.concatenate([
            [error.sum()], spread * slope[:, 0] + x[1:n + 1],
            (slope[:, 1:] - model.factors * slope[:, :1] + decay * model.factors).ravel()]
        ).astype(np.float32)

    put(_minimise(value_and_slope, x, steps).copy())
    return model


def held_out(doc_id: str = "doc_id", folds: int = 5, fold: int = 0) -> Column:
    """Whether a document is kept from learning; one without an id always is."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % folds == fold, F.lit(True))


def learn(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS,
          sample_bytes: int = SAMPLE_BYTES) -> FactorizationMachine:
    """Fit on at most ``sample_rows`` labelled documents outside the held-out fold, and on no
    more of them than have ``sample_bytes`` of hashed terms.

    A document with several labels is toxic if one says so; null labels are none. Of rows that
    repeat an id the one with the least text is taken. The sample's ids are few by its bound, so
    they are broadcast; its hashed terms are all that is fetched.
    """
    ship_code(docs.sparkSession)
    usable = (labels.filter(F.col("toxic").isNotNull() & ~held_out())
              .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    chosen = (F.xxhash64("doc_id"), "doc_id")
    sample = usable.orderBy(*chosen).limit(sample_rows)
    rows = (docs.select("doc_id", text_of().alias("text")).join(F.broadcast(sample), "doc_id")
            .groupBy("doc_id").agg(F.min("text").alias("text"), F.first("toxic").alias("toxic")))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            found = [terms_of(t).tobytes() for t in batch.column(1).to_pylist()]
            yield pa.record_batch({"doc_id": batch.column(0), "toxic": batch.column(2),
                                   "terms": pa.array(found, pa.binary())})

    terms = written(rows.select("doc_id", "text", F.col("toxic").cast("int").alias("toxic"))
                    .mapInArrow(hashed, _FEATURES), "sample-terms")
    # Of a sample of bounded length, so one task may add up its sizes.
    size = F.octet_length("terms").cast("long")
    before = F.sum(size).over(Window.orderBy(*chosen).rowsBetween(
        Window.unboundedPreceding, -1))
    fitting = (terms.select("doc_id", (F.coalesce(before, F.lit(0)) + size).alias("sum"),
                            before.isNull().alias("first"))
               .filter((F.col("sum") <= sample_bytes) | F.col("first")).select("doc_id"))
    found = terms.join(F.broadcast(fitting), "doc_id").select("toxic", "terms").toArrow()
    documents = [np.frombuffer(b, np.uint32) for b in found.column("terms").to_pylist()]
    toxic = np.array(found.column("toxic").to_pylist(), np.float32)
    order = sorted(range(len(documents)), key=lambda i: (toxic[i], documents[i].tobytes()))
    return fit([documents[i] for i in order], toxic[order])


def score(docs: DataFrame, model: FactorizationMachine) -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 from 0.5 on) behind its columns,
    which replace columns of these names. Every row is scored by its text alone."""
    ship_code(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = [c for c in docs.columns if c not in ("score", "predicted")]
    rows = docs.select(*[F.col(f"`{c}`") for c in kept])
    schema = rows.withColumns({"score": F.lit(0.0), "predicted": F.lit(0)}).schema
    at = kept.index("text")

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, at):
            found = shared.value.score(batch.column(at).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(found, pa.float64()),
                 pa.array((found >= .5).astype(np.int32))],
                names=[*kept, "score", "predicted"])

    return rows.mapInArrow(scored, schema)


def toxicity_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Score of every row of ``docs``; empty and null texts are scored too."""
    model = learn(docs, labels)
    marked = docs.select("doc_id", held_out().alias("held_out"), "text")
    return score(marked, model).select("doc_id", "held_out", "score", "predicted")
