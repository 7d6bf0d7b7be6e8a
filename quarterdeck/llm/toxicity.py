"""Toxicity: a linear classifier of character n-grams whose features are scaled by naive Bayes log-count ratios.

A text is the set of its hashed character n-grams (3 to 5 code points, lower case, white space as one blank). Each
feature is weighted by the log ratio of its smoothed shares in toxic and other training texts, and a logistic
regression is fitted on the scaled features. The fit takes a bounded sample of labelled rows, `per_class` of each
class with the smallest hashes of their ids; class weights restore the shares of all labelled rows. Scoring is
one pass over all texts with a weight table of fixed size.
"""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterdeck.llm.arrow_text import column, pieces

BITS = 18
ORDERS = (3, 4, 5)
#: Labelled rows of each class that the fit reads at most.
PER_CLASS = 1500
#: A feature counts if so many rows of the sample have it and its log ratio is at least so far from 0.
LEAST_ROWS, LEAST_RATIO = 5, 0.5
_MULT = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F, 0x165667B1], np.uint32)
_FINAL = np.array([0x2C1B3C6D, 0x297A2D39, 0x7FEB352D, 0x846CA68B, 0x9E485565], np.uint32)
_BLANK = np.zeros(33, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True


def held_out(doc_id: str = "doc_id"):
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0


def features(text: bytes | None) -> np.ndarray:
    """Hashed n-grams of one text, with repeats."""
    points = np.frombuffer(f" {(text or b'').decode().lower()} ".encode("utf-32-le"), np.uint32).copy()
    points[(points < 33) & _BLANK[np.minimum(points, 32)]] = 32
    out, h = [], np.zeros(len(points), np.uint32)
    for n in range(1, max(ORDERS) + 1):
        if len(points) < n:
            break
        h = h[: len(points) - n + 1] + points[n - 1 :] * _MULT[n - 1]
        if n in ORDERS:
            g = h ^ (h >> np.uint32(15))
            out.append((g * _FINAL[n - 1]) >> np.uint32(32 - BITS))
    return np.concatenate(out) if out else np.zeros(0, np.uint32)


class Model:
    """Weights of the hashed features and the intercept."""

    def __init__(self, weights: np.ndarray, bias: float):
        self.weights, self.bias = weights.astype(np.float32), float(bias)

    def scores(self, texts: list[bytes | None]) -> np.ndarray:
        seen = np.zeros(1 << BITS, bool)
        z = np.empty(len(texts))
        for i, t in enumerate(texts):
            seen[features(t)] = True
            at = np.flatnonzero(seen)
            z[i] = self.bias + float(self.weights[at].sum(dtype=np.float64))
            seen[at] = False
        return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def _minimise(f, x: np.ndarray, steps: int = 60, memory: int = 8) -> np.ndarray:
    """Limited-memory quasi-Newton descent with backtracking."""
    value, grad = f(x)
    pairs: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(steps):
        q, alphas = grad.copy(), []
        for s, y in reversed(pairs):
            a = (s @ q) / (s @ y)
            alphas.append(a)
            q -= a * y
        if pairs:
            s, y = pairs[-1]
            q *= (s @ y) / (y @ y)
        for (s, y), a in zip(pairs, reversed(alphas), strict=True):
            q += s * (a - (y @ q) / (s @ y))
        step, slope = 1.0 if pairs else 1.0 / max(1.0, float(np.abs(grad).sum())), grad @ q
        while True:
            new = x - step * q
            new_value, new_grad = f(new)
            if new_value <= value - 1e-4 * step * slope or step < 1e-8:
                break
            step /= 2
        s, y = new - x, new_grad - grad
        done = value - new_value < 1e-6 * max(1.0, abs(value))
        x, value, grad = new, new_value, new_grad
        if done:
            break
        if s @ y > 1e-12:
            pairs = [*pairs[-memory + 1 :], (s, y)]
    return x


#: Rows that one step of the loss takes; the arrays of a step have an entry per feature of these rows.
_BLOCK = 128


def fit_rows(rows: list[np.ndarray], labels: np.ndarray, weights: np.ndarray, ridge: float = 1.0) -> Model:
    """Model of rows of distinct features.

    Features are counted row by row and those that don't count are dropped at once, so besides `rows` the driver holds
    four bytes per feature that counts.
    """
    count = np.zeros((2, 1 << BITS), np.int32)
    for r, y in zip(rows, labels, strict=True):
        count[int(y == 1), r] += 1
    share = [(count[c] + 1.0) / ((labels == c).sum() + 2.0) for c in (1, 0)]
    ratio = np.log(share[0] / share[1])
    ratio[(count.sum(axis=0) < LEAST_ROWS) | (np.abs(ratio) < LEAST_RATIO)] = 0
    used = np.flatnonzero(ratio)
    scale = ratio[used]
    place = np.full(1 << BITS, -1, np.int32)
    place[used] = np.arange(len(used))
    kept = [d[d >= 0] for d in (place[r] for r in rows)]
    ends = np.cumsum([0] + [len(d) for d in kept])
    dense = np.concatenate([*kept, np.zeros(0, np.int32)])
    del kept
    sign = np.where(labels == 1, 1.0, -1.0)
    weights = weights * (len(weights) / weights.sum())

    def loss(x: np.ndarray) -> tuple[float, np.ndarray]:
        w, b = x[:-1], x[-1]
        scaled, grad, pulls, total = w * scale, np.zeros(len(used)), 0.0, 0.5 * ridge * (w @ w)
        for i in range(0, len(rows), _BLOCK):
            at = ends[i : i + _BLOCK + 1]
            own = dense[at[0] : at[-1]]
            sums = np.concatenate([[0.0], np.cumsum(scaled[own])])[at - at[0]]
            z = (np.diff(sums) + b) * sign[i : i + _BLOCK]
            total += (weights[i : i + _BLOCK] * np.logaddexp(0, -z)).sum()
            pull = -weights[i : i + _BLOCK] * sign[i : i + _BLOCK] / (1 + np.exp(np.clip(z, -500, 500)))
            grad += np.bincount(own, weights=np.repeat(pull, np.diff(at)), minlength=len(used))
            pulls += pull.sum()
        return float(total), np.append(grad * scale + ridge * w, pulls)

    x = _minimise(loss, np.zeros(len(used) + 1))
    full = np.zeros(1 << BITS)
    full[used] = x[:-1] * ratio[used]
    return Model(full, x[-1])


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Model:
    """Model of the labelled rows whose crc32(doc_id) mod 5 is not 0.

    Without rows of both classes the model is the smoothed share of toxic rows (a quarter without any row). Null ids
    and null labels are left out; an id that is labelled twice takes the larger label.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out())
    known = known.groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    known = known.join(docs.select("doc_id"), "doc_id", "left_semi")
    counts = {r["toxic"]: r["n"] for r in known.where("toxic in (0, 1)").groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n0, n1 = counts.get(0, 0), counts.get(1, 0)
    if not n0 or not n1:
        p = (n1 + 0.5) / (n0 + n1 + 2)
        return Model(np.zeros(1 << BITS), np.log(p / (1 - p)))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    parts = [known.where(F.col("toxic") == c).orderBy(*order).limit(per_class) for c in (0, 1)]
    sample = parts[0].unionAll(parts[1])  # 2 * per_class rows at most, so it may be broadcast

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in pieces(batches):
            rows = [np.unique(features(t)).astype(np.int32).tobytes() for t in texts]
            yield pa.RecordBatch.from_arrays([column(batch, "doc_id"), column(batch, "toxic"), pa.array(rows, pa.binary())], ["doc_id", "toxic", "features"])

    got = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").mapInArrow(run, "doc_id bigint, toxic int, features binary").toArrow()
    order = pc.sort_indices(got, [("doc_id", "ascending"), ("features", "ascending")]).to_pylist()
    y = got.column("toxic").to_numpy()[order]
    found = got.column("features")
    rows = [np.frombuffer(found[i].as_buffer(), np.int32) for i in order]  # views, no copies
    share = {c: counts[c] / max(1, int((y == c).sum())) for c in (0, 1)}
    model = fit_rows(rows, y, np.where(y == 1, share[1], share[0]))
    del got, found, rows
    _give_back()
    return model


def _give_back() -> None:
    """Freed memory to the system, where the C library can: glibc keeps what lies between small blocks, of a fit over 100 MB."""
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def score(docs: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns of `keep`, `score` (0 to 1) and `predicted` (1 from 0.5 on) for every row of `docs`.

    The score depends on the whole text alone. Null and empty texts get the score of the intercept; repeated rows
    give repeated rows.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((model.weights, model.bias))  # 1 MB, whatever the input
    narrow = docs.select(*keep, F.col("text").alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Model(*shared.value)
        for batch, texts in pieces(batches, "_text"):
            s = m.scores(texts)
            yield pa.RecordBatch.from_arrays([*(column(batch, k) for k in keep), pa.array(s), pa.array((s >= 0.5).astype(np.int32))], [*keep, "score", "predicted"])

    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in narrow.select(*keep).schema.fields)
    return narrow.mapInArrow(run, f"{types}, score double, predicted int")


def reject(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of `docs` that the model does not predict as toxic; columns as they were."""
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.bias))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Model(*shared.value)
        for batch, texts in pieces(batches):
            yield batch.filter(pa.array(m.scores(texts) < 0.5))

    return docs.mapInArrow(run, docs.schema)


def classify(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> DataFrame:
    """Per row of `docs`: doc_id, held_out, score, predicted. A null doc_id has held_out false."""
    out = score(docs.select("doc_id", "text"), fit(docs, labels, per_class))
    return out.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score", "predicted")
