"""Language identification: sparse multinomial logistic regression on TF-IDF
character n-grams, trained by follow-the-regularised-leader (FTRL-proximal,
per-coordinate rates) with L1 and L2 penalties, then temperature-calibrated.

* Features: 1- to 3-grams over lower-cased letters (any other run of
  characters is one blank), hashed into ``2**BITS`` buckets; weight
  log(1 + count) * idf, scaled to length 1.
* Document frequencies come from every training row, summed by Spark.
* The fit takes a sample of about ``LangParams.sample`` labelled rows, chosen
  by a hash: the only place where not every row is used.  Rows with letters are
  counted by language over the whole input; the ``LangParams.languages`` most
  frequent ones (equal counts by name) are learned, each with the same quota (at
  least ``LEAST`` rows, all rows of a rarer one), whatever its share.  So the
  sample has ``max(sample, LEAST * languages)`` rows at most, and the model as
  many classes, also if the column holds anything.  Scores go by the shares of the
  sample.  Each row gives its whole text and one short window, so that short
  texts are seen too.
* The model (weights, idf, temperature) is bounded by buckets x languages and
  is broadcast; prediction is one pass over whole texts without a shuffle.

Defined results: a null text or one without letters is ``und`` with score 0;
rows without a language are not learned from; with no labelled row at all
everything is ``und``; repeated rows are predicted each.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UND = "und"
BITS = 15
BUCKETS = 1 << BITS
LEAST = 100                   # rows of a group that a sample takes at least, about


@dataclass(frozen=True)
class LangParams:
    sample: int = 5000        # labelled rows to fit on, about
    languages: int = 100      # that are learned, at most
    epochs: int = 4
    alpha: float = 0.5        # FTRL learning rate
    beta: float = 1.0
    l1: float = 0.001
    l2: float = 0.01
    window: int = 60          # characters of the short training window


@dataclass
class LangModel:
    langs: list[str]
    idf: np.ndarray           # BUCKETS
    weights: np.ndarray       # BUCKETS x languages
    bias: np.ndarray          # languages
    temperature: float = 1.0
    accept_from: float = 0.0  # score under which no language is known

    def logits(self, idx: np.ndarray, val: np.ndarray) -> np.ndarray:
        return val @ self.weights[idx] + self.bias

    def predict(self, text: str | None) -> tuple[str, float]:
        grams = ngrams(text)
        if grams is None or not self.langs:
            return UND, 0.0
        z = self.logits(*weigh(grams, self.idf)) / self.temperature
        p = np.exp(z - z.max())
        p /= p.sum()
        k = int(p.argmax())
        return self.langs[k], float(p[k])


_LETTER: list[np.ndarray] = []


def _letters() -> np.ndarray:
    if not _LETTER:
        _LETTER.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000))
    return _LETTER[0]


def ngrams(text: str | None) -> tuple[np.ndarray, np.ndarray] | None:
    """(buckets, counts) of the hashed n-grams; None without letters."""
    if not text:
        return None
    c = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
    letter = _letters()[c]
    if not letter.any():
        return None
    blank = ~letter
    keep = letter.copy()
    keep[1:] |= blank[1:] & letter[:-1]        # the first of a run of blanks
    c = np.where(letter, c, 32)[keep].astype(np.uint64)
    c = np.concatenate(([np.uint64(32)], c, [np.uint64(32)]))
    two = c[:-1] * np.uint64(0x1F0000) + c[1:]
    three = two[:-1] * np.uint64(0x1F0000) + c[2:]
    h = np.concatenate((c, two + np.uint64(1 << 62), three + np.uint64(1 << 63)))
    h ^= h >> np.uint64(29)
    h *= np.uint64(0x9E3779B97F4A7C15)
    counts = np.bincount((h >> np.uint64(64 - BITS)).astype(np.int64), minlength=BUCKETS)
    idx = np.flatnonzero(counts)
    return idx, counts[idx]


def weigh(grams: tuple[np.ndarray, np.ndarray], idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    idx, counts = grams
    val = np.log1p(counts) * idf[idx]
    norm = np.sqrt(val @ val)
    return idx, val / norm if norm else val


def document_frequencies(texts: DataFrame) -> tuple[np.ndarray, int]:
    """Rows that hold each bucket, and rows with letters, over all ``text``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, rows = np.zeros(BUCKETS, np.int64), 0
        for b in batches:
            for t in b.column(0):
                g = ngrams(t.as_py())
                if g is not None:
                    df[g[0]] += 1
                    rows += 1
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_pydict({"bucket": np.append(at, -1), "n": np.append(df[at], rows)})

    got = (texts.select("text").mapInArrow(run, "bucket long, n long")
                .groupBy("bucket").agg(F.sum("n").alias("n")).collect())     # at most BUCKETS + 1 rows
    df, rows = np.zeros(BUCKETS), 0
    for r in got:
        if r.bucket < 0:
            rows = r.n
        else:
            df[r.bucket] = r.n
    return df, rows


def fit_ftrl(x: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, k: int, p: LangParams) -> tuple[np.ndarray, np.ndarray]:
    """Weights (BUCKETS x k) and bias by FTRL-proximal with elastic net."""
    z, n = np.zeros((BUCKETS + 1, k)), np.zeros((BUCKETS + 1, k))
    order = np.arange(len(x))

    def weights(i):
        w = -(z[i] - np.sign(z[i]) * p.l1) / ((p.beta + np.sqrt(n[i])) / p.alpha + p.l2)
        w[np.abs(z[i]) <= p.l1] = 0.0
        return w

    rng = np.random.default_rng(7)
    for _ in range(p.epochs):
        rng.shuffle(order)
        for d in order:
            idx, val = x[d]
            idx, val = np.append(idx, BUCKETS), np.append(val, 1.0)
            w = weights(idx)
            s = val @ w
            s = np.exp(s - s.max())
            s /= s.sum()
            s[y[d]] -= 1.0
            g = val[:, None] * s
            g2 = g * g
            z[idx] += g - (np.sqrt(n[idx] + g2) - np.sqrt(n[idx])) / p.alpha * w
            n[idx] += g2
    w = weights(np.arange(BUCKETS + 1))
    return w[:BUCKETS], w[BUCKETS]


def fit_temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature of least log loss (golden-section search on its log).
    Targets are smoothed by one row in all, so that rows which are all right
    don't make it certain."""
    n, k = logits.shape if len(y) else (0, 0)
    if not n or k < 2:
        return 1.0
    wrong = 1.0 / (n + 2)

    def loss(t):
        z = logits / np.exp(t)
        z = z - z.max(axis=1, keepdims=True)
        norm = np.log(np.exp(z).sum(axis=1))
        true = z[np.arange(n), y]
        return float(np.mean(norm - (1 - wrong) * true - wrong / (k - 1) * (z.sum(axis=1) - true)))

    lo, hi, g = np.log(0.05), np.log(20.0), (np.sqrt(5) - 1) / 2
    for _ in range(60):
        a, b = hi - g * (hi - lo), lo + g * (hi - lo)
        lo, hi = (lo, b) if loss(a) <= loss(b) else (a, hi)
    return float(np.exp((lo + hi) / 2))


def quota(counts: dict, about: int) -> float:
    """Rows that a sample of ``about`` takes of every group: all of the small
    groups, the rest in equal parts, but not under ``LEAST``."""
    left, sizes = about, sorted(counts.values())
    for k, n in enumerate(sizes):
        if n * (len(sizes) - k) >= left:
            return max(left / (len(sizes) - k), LEAST)
        left -= n
    return max([*sizes, LEAST])


def sample_rows(df: DataFrame, key: list[str], by: str, counts: dict, about: int) -> DataFrame:
    """About ``about`` rows, the same on each run: those whose hashed ``key``
    falls under a threshold set from the row count of their group, so that each
    of the groups ``counts`` (group -> rows) has its quota or all of its rows."""
    most = quota(counts, about)
    share = {g: most / n for g, n in counts.items() if n > most}
    if not share:
        return df
    limits = F.create_map(*(F.lit(x) for g, r in share.items() for x in (g, int(r * (1 << 30)))))
    return df.where(F.pmod(F.xxhash64(*key, F.lit("sample")), F.lit(1 << 30)) < F.coalesce(F.element_at(limits, F.col(by)), F.lit(1 << 30)))


def fit(train: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", params: LangParams = LangParams()) -> LangModel:
    """Learn from the rows of ``train`` that have a language."""
    rows = train.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(lang).alias("lang")).where(F.col("lang").isNotNull())
    df, total = document_frequencies(rows)
    idf = np.log((1.0 + total) / (1.0 + df)) + 1.0

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for i, t, lg in zip(*(c.to_pylist() for c in b.columns)):
                at = zlib.crc32((t or "").encode("utf-8", "replace")) % max(1, len(t or "") - params.window)
                for part, piece in enumerate((t, (t or "")[at:at + params.window])):
                    g = ngrams(piece)
                    if g is not None:
                        idx, val = weigh(g, idf)
                        out.append((i, part, lg, idx.tolist(), val.tolist()))
            yield pa.RecordBatch.from_arrays([
                pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.int32()), pa.array([o[2] for o in out], pa.string()),
                pa.array([o[3] for o in out], pa.list_(pa.int32())), pa.array([o[4] for o in out], pa.list_(pa.float32()))],
                names=["doc_id", "part", "lang", "idx", "val"])

    lettered = rows.where(F.col("text").rlike(r"\p{L}"))
    most = lettered.groupBy("lang").count().orderBy(F.col("count").desc(), "lang").limit(params.languages)
    counts = {r["lang"]: r["count"] for r in most.collect()}
    got = sample_rows(lettered.where(F.col("lang").isin(list(counts))), ["doc_id", "text"], "lang", counts, params.sample).mapInArrow(features, "doc_id long, part int, lang string, idx array<int>, val array<float>").toPandas()
    if got.empty:
        return LangModel([], idf, np.zeros((BUCKETS, 0)), np.zeros(0))
    got = got.assign(key=got.doc_id.fillna(-1)).sort_values(["key", "part", "lang"], kind="stable").reset_index(drop=True)
    langs = sorted(got.lang.unique())
    y = got.lang.map({lg: k for k, lg in enumerate(langs)}).to_numpy()
    x = [(np.asarray(i), np.asarray(v, dtype=float)) for i, v in zip(got.idx, got.val)]
    hold = (got.groupby("lang").cumcount().to_numpy() // 2) % 5 == 4     # a fifth of each language calibrates the temperature
    if hold.all() or not hold.any():
        hold = np.zeros(len(y), bool)
    w, b = fit_ftrl([x[i] for i in np.flatnonzero(~hold)], y[~hold], len(langs), params)
    model = LangModel(langs, idf, w, b)
    z = np.array([model.logits(*x[i]) for i in np.flatnonzero(hold)]).reshape(-1, len(langs))
    model.temperature = fit_temperature(z, y[hold])
    model.accept_from = least_score(z / model.temperature)
    return model


def least_score(logits: np.ndarray) -> float:
    """The score from which on a language is taken as known: a fifth of the way
    from chance to certainty, or less if one in 200 of the calibration rows
    (whole texts and short windows of known languages) scores lower."""
    n, k = logits.shape
    if not n or k < 2:
        return 0.0
    p = np.exp(logits - logits.max(axis=1, keepdims=True))
    above = (p.max(axis=1) / p.sum(axis=1) - 1 / k) / (1 - 1 / k)
    return float(1 / k + (1 - 1 / k) * min(0.2, np.quantile(above, 0.005)))


def predict(df: DataFrame, model: LangModel, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, lang_pred, score for every row."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            out = [m.predict(t.as_py()) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([o[0] for o in out], pa.string()), pa.array([o[1] for o in out], pa.float64())], names=["doc_id", "lang_pred", "score"])

    return df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(run, "doc_id long, lang_pred string, score double")


def accept(text: Column, model: LangModel, min_score: float | None = None) -> Column:
    """True for texts with letters whose language is known with at least
    ``min_score`` (the model's own by default).  A model without languages knows
    nothing against any of them."""
    least = model.accept_from if min_score is None else min_score

    @F.pandas_udf("boolean")
    def run(texts):
        def ok(t):
            lang, score = model.predict(t)
            return lang != UND and score >= least
        return texts.map(ok)

    whole = F.coalesce(text, F.lit(""))
    return run(whole) if model.langs else whole.rlike(r"\p{L}")
