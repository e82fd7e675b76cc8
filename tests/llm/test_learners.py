"""The learners' inner loops against plain versions, one number at a time."""

import math

import numpy as np
import pytest

from tickline.llm import langid, quality_nbsvm, weak_rules


def random_rows(rng, n, width, most):
    rows = []
    for _ in range(n):
        idx = np.sort(rng.permutation(width)[:int(rng.integers(1, most))])
        val = rng.random(len(idx))
        rows.append((idx, val / math.sqrt(val @ val)))
    return rows


def test_ftrl_equals_a_plain_one(monkeypatch):
    rng = np.random.default_rng(2)
    width, k, p = 40, 3, langid.LangParams(epochs=3, l1=0.3)
    monkeypatch.setattr(langid, "BUCKETS", width)
    x, y = random_rows(rng, 60, width, 9), rng.integers(0, k, 60)
    got_w, got_b = langid.fit_ftrl(x, y, k, p)
    z, n = [[0.0] * k for _ in range(width + 1)], [[0.0] * k for _ in range(width + 1)]

    def weight(i, c):
        if abs(z[i][c]) <= p.l1:
            return 0.0
        return -(z[i][c] - math.copysign(p.l1, z[i][c])) / ((p.beta + math.sqrt(n[i][c])) / p.alpha + p.l2)

    order, shuffle = np.arange(len(x)), np.random.default_rng(7)
    for _ in range(p.epochs):
        shuffle.shuffle(order)
        for d in order:
            row = [*zip(x[d][0].tolist(), x[d][1].tolist()), (width, 1.0)]
            w = {i: [weight(i, c) for c in range(k)] for i, _ in row}
            s = [math.exp(sum(v * w[i][c] for i, v in row)) for c in range(k)]
            for c in range(k):
                error = s[c] / sum(s) - (y[d] == c)
                for i, v in row:
                    g = v * error
                    z[i][c] += g - (math.sqrt(n[i][c] + g * g) - math.sqrt(n[i][c])) / p.alpha * w[i][c]
                    n[i][c] += g * g
    want = np.array([[weight(i, c) for c in range(k)] for i in range(width + 1)])
    assert np.allclose(got_w, want[:width], atol=1e-6) and np.allclose(got_b, want[width], atol=1e-6)
    assert (want == 0).any() and np.abs(want).max() > 0.1


def test_hinge_fit_reaches_the_optimum():
    """Against projected gradient on the dual, and by the duality gap."""
    rng = np.random.default_rng(4)
    width, n = 30, 80
    x = random_rows(rng, n, width, 8)
    y, cost = np.where(rng.random(n) < 0.4, 1.0, -1.0), rng.choice([0.5, 2.0], n)
    w, b = quality_nbsvm.fit_hinge(x, y, cost, 20_000, width)
    dense = np.zeros((n, width + 1))
    for i, (idx, val) in enumerate(x):
        dense[i, idx] = val
    dense[:, width] = 1.0
    kernel = (dense * y[:, None]) @ (dense * y[:, None]).T
    a, step = np.zeros(n), 1.0 / np.linalg.eigvalsh(kernel)[-1]
    for _ in range(60_000):
        a = np.clip(a - step * (kernel @ a - 1.0), 0.0, cost)
    slow = (a * y) @ dense
    primal = lambda v: v @ v / 2 + cost @ np.maximum(0, 1 - y * (dense @ v))      # noqa: E731
    dual = a.sum() - a @ kernel @ a / 2
    own = np.append(w, b)
    assert primal(own) - dual < 1e-3 * dual and abs(primal(own) - primal(slow)) < 1e-3 * dual
    assert np.abs(own - slow).max() < 2e-2


def test_class_ratios_are_those_of_dense_counts(spark):
    """Scaled indicators: log of the smoothed shares of each n-gram in good and bad texts."""
    from pyspark.sql import functions as F
    rng = np.random.default_rng(6)
    texts = [(k, " ".join(rng.choice(["der", "Die,", "das!", "x1", "?", "und\n"], int(rng.integers(1, 30)))), int(k % 3 > 0)) for k in range(60)]
    rows = spark.createDataFrame(texts, "doc_id long, text string, label int")
    n, total = quality_nbsvm.class_counts(rows.select("text", "label"))
    want = np.zeros((2, quality_nbsvm.BUCKETS))
    for _, t, y in texts:
        for g in quality_nbsvm.indicators(t):
            want[y, g] += 1
    assert (n == want).all() and total.tolist() == [20, 40]
    model = quality_nbsvm.fit(rows.select("doc_id", "text"), rows.select("doc_id", F.col("label").alias("quality")))
    p, q = want[1] + quality_nbsvm.QualityParams().smoothing, want[0] + quality_nbsvm.QualityParams().smoothing
    ratio = np.log((p / p.sum()) / (q / q.sum()))
    seen = want.sum(axis=0) > 0
    assert np.allclose(model.ratios[seen], ratio[seen], atol=1e-9) and (model.ratios[~seen] == 0).all()


def test_votes_equal_em_over_rows():
    rng = np.random.default_rng(9)
    p = weak_rules.RuleParams()
    good = rng.random(300) < 0.7
    votes = np.array([[rng.choice([0, 1, 2], p=[.1, .3, .6] if g else [.5, .3, .2]) for _ in range(5)] for g in good])
    pattern, inverse, weight = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    post, rates, share = weak_rules.fit_votes(pattern, weight.astype(float), p)
    # One row after the other.
    prior = {(0, 0): 3.0, (0, 2): 1.0, (1, 0): 0.2, (1, 2): 3.0}
    belief = [1 / (1 + math.exp(4 * (sum(v == 0 for v in row) - 0.5))) for row in votes]
    for _ in range(p.rounds):
        table = {}
        for r in range(5):
            for k in (0, 1):
                mass = {v: p.prior * prior[k, v] + sum((b if k else 1 - b) for row, b in zip(votes, belief) if row[r] == v) for v in (0, 2)}
                for v in (0, 2):
                    table[r, k, v] = mass[v] / (mass[0] + mass[2])
        s = (sum(belief) + 1) / (len(votes) + 2)
        new = []
        for row in votes:
            log = [math.log(1 - s), math.log(s)]
            for r, v in enumerate(row):
                if v != 1:
                    log = [log[k] + math.log(table[r, k, v]) for k in (0, 1)]
            new.append(1 / (1 + math.exp(log[0] - log[1])))
        moved, belief = max(abs(a - b) for a, b in zip(new, belief)), new
        if moved < 1e-9:
            break
    assert post[inverse.ravel()] == pytest.approx(belief, abs=1e-6) and share == pytest.approx(s, abs=1e-6)
    assert ((post[inverse.ravel()] >= p.keep_from) == (np.array(belief) >= p.keep_from)).all()


def test_empty_tables_are_learned_from_and_scored(spark):
    from tickline.llm.common import setup
    setup(spark)
    none = spark.createDataFrame([], "doc_id long, text string, lang string, score double, quality int")
    assert langid.predict(none, langid.fit(none)).collect() == []
    assert quality_nbsvm.score(none, quality_nbsvm.fit(none.drop("quality"), none.select("doc_id", "quality"))).collect() == []
