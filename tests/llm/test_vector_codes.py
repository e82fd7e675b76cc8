"""Product codes against plain Lloyd rounds; cover trees against comparing all."""

import hashlib
import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tickline.llm import vector_codes as V
from tickline.llm.common import setup

ROWS = "vec_id long, embedding array<double>, label int, code int, error string, q string"


def brute(rows, p=V.CodeParams()):
    """{(vec_id, components): (code, error)} and the codebooks, one comparison at a time."""
    q = [(i, [math.floor(p.scale * x) for x in v], lb) for i, v, lb in rows
         if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    usable = [r for r in q if r[1] and len(r[1]) % p.parts == 0 and max(map(abs, r[1])) < V.LARGEST]
    usable.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = len(usable[0][1])
    fit = [r for r in usable if len(r[1]) == width]
    d = width // p.parts
    books = [[r[1][k * d:(k + 1) * d] for r in fit[:p.entries]] for k in range(p.parts)]

    def near(book, v):
        return min((sum((a - b) ** 2 for a, b in zip(e, v)), i) for i, e in enumerate(book))

    for _ in range(p.rounds):
        for k in range(p.parts):
            own = {}
            for r in fit:
                v = r[1][k * d:(k + 1) * d]
                own.setdefault(near(books[k], v)[1], []).append(v)
            for e, vs in own.items():
                books[k][e] = [sum(c) // len(vs) for c in zip(*vs)]
    out = []
    for r in q:
        if r in fit:
            best = [near(books[k], r[1][k * d:(k + 1) * d]) for k in range(p.parts)]
            out.append((r[0], r[2], "".join(f"{e:02x}" for _, e in best), sum(a for a, _ in best)))
        else:
            out.append((r[0], r[2], None, None))
    return out, books


def compare(spark, rows, p=V.CodeParams(), parts=3):
    setup(spark)
    df = spark.createDataFrame([(i, v, lb, 1, "e", "q") for i, v, lb in rows], ROWS).repartition(parts)
    got = V.compress(df, p).collect()
    want, books = brute(rows, p)
    total = {}
    for _, lb, _, e in want:
        if e is not None:
            total[lb] = total.get(lb, 0) + e
    digest = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    key = lambda x: tuple((v is None, v or 0) if not isinstance(v, str) else (False, v) for v in x)
    mine = sorted(((r.vec_id, r.label, r.code, r.error, r.label_error, r.codebooks_sha256) for r in got), key=key)
    theirs = sorted(((i, None if lb is None else str(lb), c, e, total.get(lb), digest) for i, lb, c, e in want), key=key)
    assert mine == theirs


@pytest.mark.parametrize("kind", ["spread", "clusters", "grid"])
def test_equals_plain_lloyd(spark, kind):
    rng = np.random.default_rng(3)
    n, width = 400, 48
    if kind == "spread":
        v = rng.normal(0, .125, (n, width))
    elif kind == "clusters":
        v = rng.normal(0, 1, (9, width))[rng.integers(0, 9, n)] + rng.normal(0, .01, (n, width))
    else:
        v = rng.integers(-1, 2, (n, width)) / 256        # ties and equal entries everywhere
    rows = [(int(i), [float(x) for x in v[k]], None if k % 7 == 0 else k % 5) for k, i in enumerate(rng.permutation(n) * 3)]
    compare(spark, rows, V.CodeParams(block=64, leaf=4))


def test_edge_rows(spark):
    rng = np.random.default_rng(4)
    one = [0.1] * 16
    rows = [(k, [float(x) for x in rng.normal(0, 1, 16)], k % 3) for k in range(90)]
    rows += [(k, one, 9) for k in range(200, 260)]                                          # a hot vector
    rows += [(5, one, 1), (5, one, 1), (None, one, None), (None, [0.5] * 16, 2)]            # ids again, no id
    rows += [(300, None, 1), (301, [float("nan")] * 16, 1), (302, [float("inf")] + one[1:], 1), (303, [None] + one[1:], 1)]   # these go
    rows += [(-5, [], 1), (-4, one + one, 1), (-3, one[:15], 1), (400, [3e5] + one[1:], 7)]    # -4 has the smallest usable id
    compare(spark, rows, V.CodeParams(block=32, leaf=2))
    compare(spark, [r for r in rows if r[0] != -4])


def test_fewer_vectors_than_entries(spark):
    compare(spark, [(2, [0.3] * 32, None), (1, [0.3] * 32, None), (7, [-0.001] * 32, 3)])


def test_nothing_usable(spark):
    setup(spark)
    assert V.compress(spark.createDataFrame([], ROWS)).collect() == []
    got = V.compress(spark.createDataFrame([(1, [1.0] * 3, 2, 1, "e", "q")], ROWS)).collect()
    assert [(r.vec_id, r.label, r.code, r.error, r.label_error) for r in got] == [(1, "2", None, None, None)]


@settings(max_examples=150, deadline=None)
@given(points=st.lists(st.tuples(st.integers(-6, 6), st.integers(-6, 6), st.integers(-40, 40)), min_size=1, max_size=120),
       entries=st.lists(st.tuples(st.integers(-6, 6), st.integers(-6, 6), st.integers(-40, 40)), min_size=1, max_size=12),
       leaf=st.integers(1, 8))
def test_tree_assigns_like_comparing_all(points, entries, leaf):
    x, e = np.array(points, np.int64), np.array(entries, np.int64)
    tree = V.cover_tree(x, leaf)
    want = V.squared(x, e).argmin(1)
    assert (V.nearest(tree, x, e) == want).all()
    sums = np.zeros((len(e), 4), np.int64)
    np.add.at(sums, want, np.concatenate([np.ones((len(x), 1), np.int64), x], 1))
    assert (V.entry_sums(tree, x, e) == sums).all()


def test_tree_is_a_cover_tree():
    x = np.random.default_rng(1).integers(-300, 300, (2000, 4))
    tree = V.cover_tree(x, 8)
    assert sorted(tree.order) == list(range(2000))
    for (first, end, centre, child, children), r in zip(tree.nodes, tree.radius):
        far = V._distance(x[tree.order[first:end]], x[centre])
        assert centre in tree.order[first:end] and far.max() == r
        if children:
            below = tree.nodes[child:child + children]
            assert below[0, 0] == first and below[-1, 1] == end and (below[1:, 0] == below[:-1, 1]).all()
            assert (tree.radius[child:child + children] <= r / 2).all() and below[0, 2] == centre
            c = x[below[:, 2]].astype(float)
            apart = np.sqrt(((c[:, None] - c[None]) ** 2).sum(-1)) + np.eye(len(c)) * 1e9
            assert (apart > r / 2).all()


def test_close_groups_are_assigned_whole():
    rng = np.random.default_rng(2)
    centres = rng.integers(-5000, 5000, (10, 4))
    x = centres[rng.integers(0, 10, 3000)] + rng.integers(-20, 20, (3000, 4))
    *_, compared, _ = V.assign(V.cover_tree(x, 8), x, centres)
    assert len(compared) == 0
