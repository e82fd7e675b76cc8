"""Quality rules as weak supervision.

Each rule looks at a few counts of a text and votes good, bad, or abstains.
Expectation-maximisation over the vote patterns of all documents estimates,
for either hidden class, how often each rule votes which way (its accuracy on
good and on bad texts) and the share of good texts; the posterior probability
of a document's pattern is its quality.  It replaces "all rules must pass".

The counts are made in one pass over whole texts and staged; the patterns (at
most 3 ** number of rules, whatever the corpus) are counted by Spark, and the
fitted posterior of each pattern is joined back by broadcast, which that bound
keeps small.

Defined results: a null text has no words; a text under the base limits (too
few words, too many repeated ones) is not kept whatever the rules say; without
documents there is nothing to fit; repeated rows each count and each return.
"""

from __future__ import annotations

import operator
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickline.llm.common import stage

BLANKS = " \t\n\v\f\r"
SYMBOLS = "#*$%&|<>"
GOOD, ABSTAIN, BAD = 2, 1, 0


@dataclass(frozen=True)
class RuleParams:
    min_words: int = 50
    max_repeat_percent: int = 50
    keep_from: float = 0.5       # posterior quality from which a text stays
    rounds: int = 100
    prior: float = 2.0           # pseudo-counts towards rules that are right


def text_counts(text: str | None) -> tuple[int, ...]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, then
    n_lines, n_letters, n_upper, n_bangs, n_same, n_stops, n_marks."""
    if not text:
        return (0,) * 12
    words = text.encode("utf-8", "surrogatepass").split()
    n = len(words)
    chars = len(text) - sum(map(text.count, BLANKS))
    lines = [x for x in text.split("\n") if x.strip(BLANKS)]
    repeat = 0
    if n >= 4:
        names: dict[bytes, int] = {}
        ids = np.fromiter((names.setdefault(w, len(names)) for w in words), np.int64, n)
        two = np.unique(ids[:-1] * len(names) + ids[1:], return_inverse=True)[1]
        code = two[:-1] * np.int64(len(names)) + ids[2:]
        _, where, count = np.unique(code, return_inverse=True, return_counts=True)
        again = count[where] >= 2
        inside = np.zeros(n, bool)
        for k in range(3):
            inside[k:n - 2 + k] |= again
        repeat = int(inside.sum())
    upper = len(text) - len(text.translate(_NO_UPPER)) if text.isascii() else sum(map(str.isupper, text))
    letters = sum(map(str.isalpha, text))
    return (n, chars, sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)), repeat,
            len(lines), letters, upper, text.count("!") + text.count("?"), sum(map(operator.eq, words[1:], words)),
            text.count(". ") + text.count(".\n") + text.endswith("."),
            sum(map(_MARKS.__contains__, words)))


#: Words of one to three equal ASCII marks.
_MARKS = frozenset(bytes([c]) * k for c in range(33, 127) if not chr(c).isalnum() for k in (1, 2, 3))
_NO_UPPER = {c: None for c in range(65, 91)}
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_letters", "n_upper", "n_bangs", "n_same", "n_stops", "n_marks")


def _vote(good: Column, bad: Column) -> Column:
    return F.when(bad, BAD).when(good, GOOD).otherwise(ABSTAIN)


def rules() -> dict[str, Column]:
    """Votes from the counts of a text."""
    c = {k: F.col(k) for k in COUNTS}
    words = F.greatest(c["n_words"], F.lit(1))
    letters = F.greatest(c["n_letters"], F.lit(1))
    lines = F.greatest(c["n_lines"], F.lit(1))
    return {
        "length": _vote(c["n_words"] >= 100, c["n_words"] < 20),
        "word_length": _vote(c["word_chars"].between(words * 3, words * 10), (c["word_chars"] < words * 2) | (c["word_chars"] > words * 16)),
        "symbols": _vote(c["n_symbols"] * 50 <= words, c["n_symbols"] * 5 > words),
        "repeated_words": _vote(c["n_repeat_words"] * 20 <= words, c["n_repeat_words"] * 10 > words * 4),
        "repeated_lines": _vote(c["n_dup_lines"] * 20 <= lines, c["n_dup_lines"] * 10 > lines * 5),
        "capitals": _vote(c["n_upper"] * 8 <= letters, c["n_upper"] * 10 > letters * 4),
        "exclamations": _vote(c["n_bangs"] * 50 <= words, c["n_bangs"] * 10 > words * 3),
        "stutter": _vote(c["n_same"] * 50 <= words, c["n_same"] * 10 > words * 2),
        "sentences": _vote(c["n_stops"] * 40 >= words, c["n_stops"] * 200 < words),
        "marks": _vote(c["n_marks"] * 50 <= words, c["n_marks"] * 10 > words),
        "letters": _vote(c["n_letters"] * 10 >= c["word_chars"] * 9, c["n_letters"] * 10 < c["word_chars"] * 7),
    }


def counted(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = [text_counts(t.as_py()) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array([o[k] for o in out], pa.int64()) for k in range(len(COUNTS)))], names=["doc_id", *COUNTS])

    return (docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
                .mapInArrow(run, "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS)))


def fit_votes(votes: np.ndarray, weight: np.ndarray, p: RuleParams) -> tuple[np.ndarray, np.ndarray, float]:
    """EM for hidden classes 0 (bad) and 1 (good).  ``votes``: patterns x rules
    of BAD, ABSTAIN, GOOD; ``weight``: documents of each pattern.  Returns each
    pattern's posterior of good, the rules' vote rates where they vote (rules x
    class x bad/good; an abstention says nothing) and the share of good.  Each
    rule's rates get a prior in the sense of its votes, which also tells the
    classes apart."""
    m = votes.shape[1]
    hot = np.stack([votes == v for v in (BAD, GOOD)], axis=2).astype(float)     # patterns x rules x votes
    prior = p.prior * np.array([[3.0, 1.0], [0.2, 3.0]])
    # Start: a text is the likelier bad the more rules say so.
    bad = (votes == BAD).sum(axis=1)
    post = 1.0 / (1.0 + np.exp(4.0 * (bad - 0.5)))
    rates, share = np.zeros((m, 2, 2)), 0.5
    for _ in range(p.rounds):
        for k, q in enumerate((1 - post, post)):
            r = np.einsum("p,prv->rv", weight * q, hot) + prior[k]
            rates[:, k] = r / r.sum(axis=1, keepdims=True)
        share = (weight @ post + 1.0) / (weight.sum() + 2.0)
        log = np.einsum("prv,rkv->pk", hot, np.log(rates)) + np.log([1 - share, share])
        new = 1.0 / (1.0 + np.exp(np.clip(log[:, 0] - log[:, 1], -500, 500)))
        moved = np.abs(new - post).max(initial=0.0)
        post = new
        if moved < 1e-9:
            break
    return post, rates, share


def judge(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", params: RuleParams = RuleParams()) -> DataFrame:
    """doc_id, the counts, votes pattern, base_failed, quality (posterior) and
    kept for every row."""
    p = params
    spark = docs.sparkSession
    named = rules()
    code = sum((v * 3 ** k for k, v in enumerate(named.values())), F.lit(0)).cast("int")
    rows = stage(counted(docs, doc_id, text).withColumn("votes", code), "votes")
    seen = rows.groupBy("votes").agg(F.count(F.lit(1)).alias("n")).orderBy("votes").collect()     # at most 3 ** rules
    votes = np.array([[r.votes // 3 ** k % 3 for k in range(len(named))] for r in seen], dtype=int).reshape(len(seen), len(named))
    post, _, _ = fit_votes(votes, np.array([float(r.n) for r in seen]), p)
    table = spark.createDataFrame([(int(r.votes), float(q)) for r, q in zip(seen, post)], "votes int, quality double")
    failed = (F.col("n_words") < p.min_words) | (F.col("n_repeat_words") * 100 > F.col("n_words") * p.max_repeat_percent)
    return (rows.join(F.broadcast(table), "votes", "left").withColumn("base_failed", failed)
                .withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= p.keep_from)))
