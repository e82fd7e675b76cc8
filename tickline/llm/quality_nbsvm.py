"""Quality classifier: naive Bayes support vectors.

N-gram indicators are scaled by the log-ratio of their smoothed document
counts in the two classes; a linear model with hinge loss is fitted on the
scaled indicators by dual coordinate descent; a logistic curve on held-back
rows turns margins into scores from 0 to 1.

* Indicators, hashed into ``2**BITS`` buckets: character 3-grams (digits as
  one), 1- to 4-grams of the stream of character classes with runs collapsed,
  and 1- to 3-grams of "this word equals the one before".
* Class counts cover every labelled training row (summed by Spark).
* Only the hinge-loss fit takes a sample, of about ``QualityParams.sample``
  labelled rows chosen by a hash of the id, with the same quota for either
  label (all rows of a rarer one), so that both are seen whatever their shares;
  the logistic curve weighs its rows by the labels' true shares.
* Scoring is one pass over whole texts with the broadcast model.

Defined results: null and empty texts have no indicators and get the score of
the bias; a doc_id with contradicting labels is not learned from, repeated
equal labels count once; without both classes every score is the share of
class 1 (0.5 without labels); repeated rows are scored each.
"""

from __future__ import annotations

import operator
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickline.llm.langid import sample_rows
from tickline.operators.joins import Measured

BITS = 16
BUCKETS = 1 << BITS


@dataclass(frozen=True)
class QualityParams:
    sample: int = 6000        # labelled rows for the hinge-loss fit, about
    smoothing: float = 1.0    # added to the class counts
    cost: float = 1.0         # upper bound of the dual variables
    epochs: int = 12


@dataclass
class QualityModel:
    weights: np.ndarray       # BUCKETS, already times the log-count ratios
    ratios: np.ndarray
    bias: float
    slope: float = 1.0
    offset: float = 0.0

    def margin(self, idx: np.ndarray) -> float:
        norm = np.sqrt(np.sum(self.ratios[idx] ** 2))
        return float(self.weights[idx].sum() / norm + self.bias) if norm else self.bias

    def score(self, text: str | None) -> float:
        return sigmoid(self.slope * self.margin(indicators(text)) + self.offset)


def sigmoid(x: float) -> float:
    return float(1.0 / (1.0 + np.exp(-np.clip(x, -40, 40))))


_CLASS: list[np.ndarray] = []


def _classes() -> np.ndarray:
    """Character classes: ASCII punctuation for itself, then upper-case,
    other letter, digit, blank, rest."""
    if not _CLASS:
        t = np.empty(0x110000, np.uint8)
        for c in range(0x110000):
            s = chr(c)
            t[c] = (1 if s.isupper() else 2) if s.isalpha() else 3 if s.isdigit() else 4 if s.isspace() else c if c < 128 else 5
        _CLASS.append(t)
    return _CLASS[0]


def _hash(kind: int, *parts: np.ndarray) -> np.ndarray:
    h = np.full(len(parts[-1]), kind + 1, np.uint64)
    for p in parts:
        h = (h ^ p[:len(h)].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(32)
    return (h >> np.uint64(3)) & np.uint64(BUCKETS - 1)


def _grams(kind: int, seq: np.ndarray, lengths) -> list[np.ndarray]:
    return [_hash(kind + n, *(seq[k:len(seq) - n + 1 + k] for k in range(n))) for n in lengths if len(seq) >= n]


def indicators(text: str | None) -> np.ndarray:
    """Sorted buckets of the n-grams that occur in ``text``."""
    if not text:
        return np.empty(0, np.int64)
    c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    kind = _classes()[c]
    found = _grams(0, np.where(kind == 3, 48, c), (3,))
    turn = np.ones(len(kind), bool)
    turn[1:] = kind[1:] != kind[:-1]
    found += _grams(10, kind[turn], (1, 2, 3, 4))
    w = text.split()
    same = np.fromiter(map(operator.eq, w[1:], w), dtype=np.uint8, count=max(0, len(w) - 1))
    found += _grams(20, same, (1, 2, 3))
    flags = np.zeros(BUCKETS, bool)
    for f in found:
        flags[f] = True
    return np.flatnonzero(flags)


def clean_labels(labels: DataFrame, doc_id: str, label: str) -> DataFrame:
    """One row per doc_id with one label; contradictions go."""
    return (labels.where(F.col(doc_id).isNotNull() & F.col(label).isNotNull())
                  .groupBy(F.col(doc_id).alias("doc_id")).agg(F.min(label).alias("label"), F.max(label).alias("_max"))
                  .where(F.col("label") == F.col("_max")).select("doc_id", F.col("label").cast("int").alias("label")))


def class_counts(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Rows of each class that hold each bucket (2 x BUCKETS), rows by class."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = np.zeros((2, BUCKETS), np.int64), np.zeros(2, np.int64)
        for b in batches:
            for t, y in zip(b.column(0), b.column(1).to_pylist()):
                n[y, indicators(t.as_py())] += 1
                total[y] += 1
        at = np.flatnonzero(n.sum(axis=0))
        yield pa.RecordBatch.from_pydict({"bucket": np.append(at, -1), "n0": np.append(n[0, at], total[0]), "n1": np.append(n[1, at], total[1])})

    got = (rows.select("text", "label").mapInArrow(run, "bucket long, n0 long, n1 long")
               .groupBy("bucket").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).collect())   # at most BUCKETS + 1 rows
    n, total = np.zeros((2, BUCKETS)), np.zeros(2)
    for r in got:
        if r.bucket < 0:
            total[:] = r.n0, r.n1
        else:
            n[:, r.bucket] = r.n0, r.n1
    return n, total


def fit_hinge(x: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, cost: np.ndarray, epochs: int, width: int) -> tuple[np.ndarray, float]:
    """min |w|^2/2 + sum cost_i * max(0, 1 - y_i (w x_i + b)) by dual
    coordinate descent (the bias is one more constant feature)."""
    w, bias, a = np.zeros(width), 0.0, np.zeros(len(x))
    q = np.array([v @ v + 1.0 for _, v in x])
    order = np.arange(len(x))
    rng = np.random.default_rng(11)
    for _ in range(epochs):
        rng.shuffle(order)
        most = 0.0
        for i in order:
            idx, val = x[i]
            g = y[i] * (val @ w[idx] + bias) - 1.0
            new = min(max(a[i] - g / q[i], 0.0), cost[i])
            step = (new - a[i]) * y[i]
            if step:
                a[i] = new
                w[idx] += step * val
                bias += step
                most = max(most, abs(step))
        if most < 1e-4:
            break
    return w, bias


def fit_logistic(margins: np.ndarray, positive: np.ndarray, weight: np.ndarray | float = 1.0) -> tuple[float, float]:
    """Slope and offset of a logistic curve with smoothed targets (Newton)."""
    n1, n0 = positive.sum(), (~positive).sum()
    t = np.where(positive, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margins + b, -40, 40)))
        g, h = weight * (p - t), weight * np.maximum(p * (1 - p), 1e-9)
        m = np.array([[h @ (margins ** 2) + 1e-6, h @ margins], [h @ margins, h.sum() + 1e-6]])
        step = np.linalg.solve(m, [g @ margins, g.sum()])
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-8:
            break
    return float(a), float(b)


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality", params: QualityParams = QualityParams()) -> QualityModel:
    """Learn from ``docs`` that have a label.  ``labels`` is a narrow table; it
    is broadcast only when its counted size is small, else joined by shuffle."""
    known = clean_labels(labels, doc_id, label)
    side = Measured(known, known.count()).side()
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).join(side, "doc_id").where(F.col("label").isin(0, 1))
    n, total = class_counts(rows)
    if not total.all():
        share = total[1] / total.sum() if total.sum() else 0.5
        prior = float(np.log(max(share, 1e-6) / max(1 - share, 1e-6)))
        return QualityModel(np.zeros(BUCKETS), np.zeros(BUCKETS), prior)
    p, q = n[1] + params.smoothing, n[0] + params.smoothing
    ratios = np.log((p / p.sum()) / (q / q.sum()))
    ratios[n.sum(axis=0) == 0] = 0.0

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array([indicators(t.as_py()).tolist() for t in b.column(1)], pa.list_(pa.int32()))], names=["doc_id", "label", "idx"])

    few = sample_rows(known.where(F.col("label").isin(0, 1)), ["doc_id"], "label", {0: int(total[0]), 1: int(total[1])}, params.sample)
    few = Measured(few, few.count()).side()               # labels may be many more than the rows that have one
    got = (docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).join(few, "doc_id")
               .where(F.col("label").isin(0, 1)).select("doc_id", "text", "label").mapInArrow(features, "doc_id long, label int, idx array<int>").toPandas())
    got["size"] = got.idx.map(len)
    got = got.sort_values(["doc_id", "label", "size"], kind="stable").reset_index(drop=True)
    x = []
    for idx in got.idx:
        idx = np.asarray(idx, dtype=np.int64)
        v = ratios[idx]
        norm = np.sqrt(v @ v)
        x.append((idx, v / norm if norm else v))
    positive = got.label.to_numpy() == 1
    hold = np.arange(len(x)) % 5 == 4                      # a fifth calibrates the curve
    if not (positive[hold].any() and (~positive[hold]).any() and positive[~hold].any() and (~positive[~hold]).any()):
        hold[:] = False
    y = np.where(positive, 1.0, -1.0)
    rest = np.flatnonzero(~hold)
    w, bias = fit_hinge([x[i] for i in rest], y[rest], np.full(len(rest), params.cost), params.epochs, BUCKETS)
    model = QualityModel(w * ratios, ratios, bias)
    which = np.flatnonzero(hold) if hold.any() else rest
    if len(which):
        margins = np.array([x[i][1] @ w[x[i][0]] + bias for i in which])
        of = positive[which].astype(int)
        true = (total / np.maximum(np.bincount(of, minlength=2), 1))[of]
        model.slope, model.offset = fit_logistic(margins, positive[which], true / true.mean())
    return model


def score(df: DataFrame, model: QualityModel, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and score for every row."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([m.score(t.as_py()) for t in b.column(1)], pa.float64())], names=["doc_id", "score"])

    return df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(run, "doc_id long, score double")
