"""Benchmark leaks against looking for every window in every document."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickline.llm import decontaminate as D
from tickline.llm.common import setup

DOCS = "doc_id long, text string, n_words long, row string, item_ids string, key int"
ITEMS = "item_id long, text string, doc_id long, window string"
WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, width=10):
    wins = {}
    for i, t in items:
        w = words(t)
        n = min(width, len(w))
        for k in range(len(w) - n + 1) if n else ():
            wins.setdefault(tuple(w[k:k + n]), set()).add(i)
    out = []
    for i, t in docs:
        w, hit, ids = words(t), set(), set()
        for n in {len(x) for x in wins}:
            for k in range(len(w) - n + 1):
                found = wins.get(tuple(w[k:k + n]))
                if found:
                    hit |= set(range(k, k + n))
                    ids |= found
        out.append((i, len(w), len(hit), sorted(str(x) for x in ids if x is not None)))
    return sorted(out, key=str)


def result(spark, docs, items, params=D.LeakParams()):
    setup(spark)
    d = spark.createDataFrame([(i, t, 1, "r", "i", 2) for i, t in docs], DOCS).repartition(3)
    b = spark.createDataFrame([(i, t, 5, "w") for i, t in items], ITEMS)
    rows = D.benchmark_leaks(d, b, params).collect()
    for r in rows:
        hit = {k for s in r.spans for k in range(s.start, s.start + s.length)}
        assert len(hit) == r.n_hit and r.row.key == 2
    return sorted(((r.row.doc_id, r.n_words, r.n_hit, list(r.item_ids)) for r in rows), key=str)


@pytest.mark.parametrize("params", [D.LeakParams(), D.LeakParams(width=6, shingle=2), D.LeakParams(width=3, shingle=5)])
def test_equals_looking_everywhere(spark, params):
    rng = np.random.default_rng(7)
    vocabulary = ["a", "B", "c3", "é", "日本", "the", "The", "x-y", "of", "zz"]
    text = lambda n: " ".join(rng.choice(vocabulary, n))
    items = [(k, text(int(rng.choice([1, 3, 4, 9, 10, 11, 30])))) for k in range(40)]
    docs = []
    for i in range(80):
        t = text(int(rng.integers(0, 60)))
        for k in rng.choice(40, int(rng.integers(0, 3))):
            w = items[k][1].upper().split(" ")
            t += " " + ", ".join(w[int(rng.integers(0, 3)):])
        docs.append((i, t))
    assert result(spark, docs, items, params) == brute(docs, items, params.width)


def test_edge_rows(spark):
    passage = " ".join(f"w{k}" for k in range(14))
    items = [(1, passage), (2, passage), (2, passage), (None, "only here is this text of no known item at all"), (3, None), (4, " -- "), (5, ""),
             (11, "one two three"), (6, "x" * 60_000), (7, " ".join(f"v{k}" for k in range(70_000)))]
    docs = [(1, None), (2, ""), (3, " .\n"), (None, passage), (4, passage), (4, passage.upper()), (4, passage[:-4]), (5, "x" * 60_000 + " y"),
            (6, "lorem " * 40_000 + passage + " ipsum" * 40_000), (7, "a one two. three b"), (8, "one two four three"),
            (9, "so only here is this text of no known item at all"), (10, " ".join(f"v{k}" for k in range(32_700, 32_850)))]
    docs += [(100 + k, "common words before " + passage) for k in range(300)]                  # a hot passage
    assert result(spark, docs, items) == brute(docs, items)


def test_empty_tables(spark):
    assert result(spark, [], [(1, "a b c")]) == []
    assert result(spark, [(1, "a b c"), (2, None)], []) == [(1, 3, 0, []), (2, 0, 0, [])]
    assert result(spark, [(1, "a b c")], [(1, "  ")]) == [(1, 3, 0, [])]


def test_without_leaks_keeps_clean_rows_whole(spark):
    setup(spark)
    d = spark.createDataFrame([(1, "p q r s", 1, "r", "i", 2), (1, "a b c", 1, "r", "i", 2), (None, None, None, None, None, None)], DOCS)
    left = D.without_leaks(d, spark.createDataFrame([(1, "b c", 5, "w")], ITEMS))
    assert left.columns == d.columns and sorted(map(tuple, left.collect()), key=str) == sorted(
        [(1, "p q r s", 1, "r", "i", 2), (None,) * 6], key=str)


def test_run_hashes_are_the_same_wherever_the_run_stands():
    rng = np.random.default_rng(1)
    w = [b"w%d" % k for k in rng.integers(0, 50, 400)]
    for lo in (0, 17, 200):
        part = D.Runs(w[lo:])
        for size in (1, 5, 10):
            at = np.arange(0, len(w) - lo - size + 1)
            want = {}
            for k, h in zip(at.tolist(), part.hashes(at, size).tolist()):
                assert want.setdefault(tuple(w[lo + k:lo + k + size]), h) == h
            assert len(set(want.values())) == len(want)
            assert (D.Runs(w).hashes(at + lo, size) == part.hashes(at, size)).all()


def test_filter_says_yes_to_all_its_keys(spark):
    setup(spark)
    keys = np.random.default_rng(3).integers(-2**63, 2**63 - 1, 5000)
    f = D.bit_filter(spark.createDataFrame([(int(k),) for k in keys], "k long"), "k", len(keys))
    assert f(keys.view(np.uint64)).all()
    assert f(np.random.default_rng(4).integers(0, 2**63, 20_000).astype(np.uint64)).mean() < 0.01
    assert not D.bit_filter(spark.createDataFrame([], "k long"), "k", 0)(keys.view(np.uint64)).any()


def test_overlaps_are_counted_once(spark):
    spans = [(5, 10), (0, 10), (20, 3), (21, 1), (14, 2)]
    df = spark.createDataFrame([(sorted(spans),)], "s array<struct<start int, length int>>")
    assert df.select(D.covered(F.col("s"))).first()[0] == len({k for a, n in spans for k in range(a, a + n)})
