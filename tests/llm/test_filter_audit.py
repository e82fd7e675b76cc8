"""The filter audit against running every order of filters over the rows."""

import itertools

import numpy as np

from tickline.llm import filter_audit
from tickline.llm.common import setup

DOCS = "doc_id long, text string, lang string, part string, failed int, digest string"


def brute(docs, labels):
    """Every order run document by document."""
    texts = [(i, t or "", lg or "") for i, t, lg in docs]
    fails = []
    for i, t, _ in texts:
        w = [x for x in t.replace("\t", " ").replace("\n", " ").split(" ") if x]
        fails.append((len(w) < 100, 100 * len(set(w)) < 80 * len(w), 100 * sum("A" <= c <= "Z" for c in t) > 10 * len(t),
                      any(c in "#$%&*|" for c in t),
                      i is not None and any(j is not None and j < i and u == t for j, u, _ in texts)))
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    out = {}
    for part in {lg for _, _, lg in texts}:
        mine = [k for k, (_, _, lg) in enumerate(texts) if lg == part]
        total = [0] * 5
        for order in itertools.permutations(range(5)):
            left = mine
            for step, f in enumerate(order):
                gone = [k for k in left if fails[k][f]]
                left = [k for k in left if not fails[k][f]]
                total[f] += len(gone)
                out[part, "".join("ABCDE"[x] for x in order), step + 1] = (
                    len(left), len(gone), sum(fails[k][f] for k in mine) - len(gone), sum(fails[k][f] and sum(fails[k]) == 1 for k in mine),
                    sum(texts[k][0] in good for k in gone), sum(texts[k][0] in toxic for k in gone), f)
        for key, row in out.items():
            if key[0] == part:
                out[key] = (*row[:6], total[row[6]])
    return out


def result(spark, docs, labels):
    setup(spark)
    d = spark.createDataFrame([(i, t, lg, "x", 3, "y") for i, t, lg in docs], DOCS)
    n = spark.createDataFrame([(*row, "z") for row in labels], "doc_id long, quality int, toxic int, part string")
    rows = filter_audit.document_audit(d, n).collect()
    got = {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley) for r in rows}
    assert len(got) == len(rows)
    return got


def test_equals_running_every_order(spark):
    rng = np.random.default_rng(5)
    words = [f"w{k}" for k in range(400)] + ["WORD", "a$b", "ü"]
    docs = []
    for i in range(120):
        n = int(rng.choice([0, 5, 99, 100, 130, 300]))
        docs.append((i, " ".join(rng.choice(words[:int(rng.choice([80, 403]))], n)), [None, "", "en", "de"][i % 4]))
    docs += [(i + 500, docs[i % 7][1], "en") for i in range(60)]                             # copies, in other parts too
    docs += [(None, docs[8][1], "de"), (None, docs[8][1], "de"), (8, docs[8][1], "fr")]      # no id; an id again
    docs += [(900, None, "en"), (901, "", "de"), (902, "x" * 200_000, "en"), (903, "A " * 100_000, "fr"), (903, "A " * 100_000, "fr")]
    labels = [(i, int(i % 3 == 0), int(i % 5 == 0)) for i in range(0, 600, 2)] + [(4, 1, None), (None, 1, 1), (901, None, 1)]
    assert result(spark, docs, labels) == brute(docs, labels)


def test_boundaries_of_the_filters():
    ninety, hundred = b"a " * 90, b" ".join(b"w%d" % k for k in range(100))
    assert filter_audit.text_failures(hundred) == 0
    assert filter_audit.text_failures(hundred.rsplit(b" ", 1)[0]) & 1
    assert filter_audit.text_failures(ninety) & 2
    assert filter_audit.text_failures(b"A" + b"b" * 9) & 4 == 0 and filter_audit.text_failures(b"A" + b"b" * 8) & 4
    assert filter_audit.text_failures("A".encode() + "é".encode() * 9) & 4 == 0           # code points, not bytes
    assert filter_audit.text_failures(b"a|b") & 8


def test_no_documents_give_no_rows(spark):
    assert result(spark, [], [(1, 1, 1)]) == {}


def test_no_labels(spark):
    got = result(spark, [(1, "a", "en"), (2, "a", "en")], [])
    assert len(got) == 600 and got["en", "EABCD", 1] == (1, 1, 0, 0, 0, 0, sum(1 for o in itertools.permutations("ABCDE") if o.index("E") < o.index("A")))


def test_contractions_of_other_numbers_of_filters():
    counts = np.arange(2 * 8 * 1, dtype=np.int64).reshape(2, 8, 1)
    got = filter_audit.contractions(counts)
    assert got.shape == (2, 3, 3, 3, 1)
    pattern = np.arange(8)
    for choice in itertools.product(range(3), repeat=3):
        keep = np.ones(8, bool)
        for bit, c in enumerate(choice):
            if c != filter_audit.EITHER:
                keep &= (pattern >> bit & 1) == c
        assert (got[(slice(None), *choice)] == counts[:, keep].sum(1)).all()
