"""How filters of a corpus overlap, for every order in which they can run.

Each document fails or passes each of k filters.  What any order of filters
does to a part of the corpus follows from the 2^k counts of its failure
patterns, so only these are made from the documents.  The counts of a part are
reshaped to a tensor with one axis a filter (0: passes, 1: fails).  A
contraction picks "passes", "fails" or "either" along every axis:

* removed at a step: earlier filters pass, this one fails, later ones either;
* kept after it: earlier ones and this one pass, later ones either;
* redundant: this one fails, whatever the others do, less what it removes;
* unique failures: this one fails, all others pass;
* Shapley sum: what the filter removes, over all orders.

One ``einsum`` makes all 3^k contractions of a part; every (order, step) then
reads its own.  The same is done with the counts of good and of toxic
documents.

On Spark: one pass over the texts makes the failure flags and a SHA-256 of the
text; rows without text then meet their labels and their copies.  Copies are
counted before they meet: a group of copies, however large, is one row for
each part and map task.  The tensors of a part are at most 3 * 2^k numbers.

Defined results: a null text is an empty one; null and empty languages are one
part, the empty string; a row without an id has no smaller id, and gives none,
and has no labels; rows with an equal id are documents of their own, and none
of them counts as a copy of another; several labels of an id count as one that
holds what any of them says; an empty table has no parts and gives no rows.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickline.llm.common import stage

PASS, FAIL, EITHER = 0, 1, 2
MEASURES = ("n", "good", "toxic")
#: Rows without an id share no labels, so their join key is spread.
SPREAD = 1024
#: Parts whose rows are made at a time (120 orders of 5 steps each).
PARTS = 32

_CAPITALS = bytes(range(65, 91))
_MARKS = b"#$%&*|"


def text_failures(text: bytes) -> int:
    """Bits of the filters A to D that a text fails (A is bit 0)."""
    words = text.split()
    n = len(words)
    points = len(text.decode("utf-8", "replace"))
    capitals = len(text) - len(text.translate(None, _CAPITALS))
    return ((n < 100)
            | (100 * len(set(words)) < 80 * n) << 1
            | (100 * capitals > 10 * points) << 2
            | (len(text.translate(None, _MARKS)) < len(text)) << 3)


COPY = 1 << 4      # filter E: a document with a smaller id has the same text


def flagged(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """doc_id, part, failed (bits A to D) and digest of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            failed = pa.array([text_failures(t.as_py()) for t in b.column("text")], pa.int32())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("part"), failed, b.column("digest")],
                                             names=["doc_id", "part", "failed", "digest"])

    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    return docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        F.unhex(F.sha2(whole, 256)).alias("digest"), whole.cast("binary").alias("text"),
    ).mapInArrow(run, "doc_id long, part string, failed int, digest binary")


def labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """``rows`` with booleans good and toxic; unlabelled ones are neither."""
    marks = (labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("_id"))
                   .agg(F.coalesce(F.bool_or(F.col("quality") == 1), F.lit(False)).alias("good"),
                        F.coalesce(F.bool_or(F.col("toxic") == 1), F.lit(False)).alias("toxic"))
                   .withColumn("_salt", F.pmod("_id", F.lit(1)).cast("int")))       # 0, but no constant: it stays a join key
    salt = F.when(F.col("doc_id").isNull(), F.pmod(F.hash("digest"), F.lit(SPREAD))).otherwise(0)
    return (rows.join(marks, (F.col("doc_id") == F.col("_id")) & (salt == F.col("_salt")), "left")
                .select("doc_id", "part", "failed", "digest", *(F.coalesce(F.col(c), F.lit(False)).alias(c) for c in ("good", "toxic"))))


def patterns(rows: DataFrame) -> DataFrame:
    """part, pattern (all five bits), n, good, toxic, from flagged and labelled
    rows.  Rows with an equal text differ only in whether their id is the
    smallest, so each (text, part) keeps two sums: of all its rows and of those
    that are no copies."""
    sums = [F.count(F.lit(1)).alias("n"), F.count_if("good").alias("good"), F.count_if("toxic").alias("toxic")]
    of = F.struct(*MEASURES)
    # Rows of one id first, so that the smallest id's sums are one row.
    each = rows.groupBy("digest", "part", "doc_id").agg(F.first("failed").alias("failed"), *sums)
    no_id = F.col("doc_id").isNull()
    group = each.groupBy("digest", "part").agg(
        F.first("failed").alias("failed"), F.min("doc_id").alias("low"), F.min_by(of, "doc_id").alias("lowest"),
        *(F.sum(c).alias(c) for c in MEASURES),
        *(F.sum(F.when(no_id, F.col(c)).otherwise(0)).alias(f"free_{c}") for c in MEASURES))
    group = stage(group, "audit-texts")
    # The smallest id of a text over all parts: at most as many rows a text as there are parts.
    least = group.groupBy("digest").agg(F.min("low").alias("least"))
    group = group.join(least, "digest")
    first = F.col("low") == F.col("least")
    own = {c: F.col(f"free_{c}") + F.when(first, F.col(f"lowest.{c}")).otherwise(0) for c in MEASURES}
    both = group.select("part", F.explode(F.array(
        F.struct(F.col("failed").alias("pattern"), *(own[c].alias(c) for c in MEASURES)),
        F.struct(F.col("failed").bitwiseOR(F.lit(COPY)).alias("pattern"), *((F.col(c) - own[c]).alias(c) for c in MEASURES)))).alias("x"))
    return both.where("x.n > 0").groupBy("part", "x.pattern").agg(*(F.sum(f"x.{c}").alias(c) for c in MEASURES))


def contractions(counts: np.ndarray) -> np.ndarray:
    """``counts``: parts x 2^k x measures, bit i of a pattern saying that filter
    i fails.  Returns parts x 3 x ... x 3 x measures: along each axis what
    passes, what fails and either."""
    parts, cells, measures = counts.shape
    k = cells.bit_length() - 1
    # C order puts the highest bit on the first axis; turned round, axis i is filter i.
    tensor = counts.reshape(parts, *[2] * k, measures).transpose(0, *range(k, 0, -1), k + 1)
    pick = np.array([[1, 0], [0, 1], [1, 1]], counts.dtype)
    axes, made = list(range(1, k + 1)), list(range(k + 2, 2 * k + 2))
    operands: list = [tensor, [0, *axes, k + 1]]
    for a, m in zip(axes, made):
        operands += [pick, [m, a]]
    return np.einsum(*operands, [0, *made, k + 1], optimize=True)


def selectors(k: int) -> tuple[list[tuple[int, ...]], np.ndarray, np.ndarray]:
    """All orders of k filters, and for each order and step the choice along
    every axis for what the step removes and for what it keeps."""
    orders = list(itertools.permutations(range(k)))
    removed = np.full((len(orders), k, k), EITHER)
    kept = np.full((len(orders), k, k), EITHER)
    for o, order in enumerate(orders):
        for step, f in enumerate(order):
            removed[o, step, list(order[:step])] = PASS
            kept[o, step, list(order[:step + 1])] = PASS
            removed[o, step, f] = FAIL
    return orders, removed, kept


def audit(counts: DataFrame, names: Sequence[str]) -> DataFrame:
    """The report from ``patterns`` rows: one row per part, order and step.
    ``names`` are the filters' letters, by bit."""
    names = list(names)
    k = len(names)
    per_part = counts.groupBy("part").agg(F.collect_list(F.struct("pattern", *MEASURES)).alias("cells"))    # 2^k cells at most
    longs = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
    schema = "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in longs)

    def report(parts: list[str], table: np.ndarray) -> pa.RecordBatch:
        orders, removed, kept = selectors(k)
        all_of = contractions(table)
        at = lambda choice: all_of[(slice(None), *np.moveaxis(choice, -1, 0))]      # parts x orders x steps x measures
        gone, left = at(removed), at(kept)
        order = np.array(orders)
        fails = at(np.where(np.arange(k) == np.arange(k)[:, None], FAIL, EITHER))[..., 0]       # parts x filters
        only = at(np.where(np.arange(k) == np.arange(k)[:, None], FAIL, PASS))[..., 0]
        shapley = np.zeros((len(parts), k), np.int64)
        for f in range(k):
            shapley[:, f] = (gone[..., 0] * (order == f)).sum((1, 2))
        n = len(orders) * k
        columns = (left[..., 0], gone[..., 0], fails[:, order] - gone[..., 0], only[:, order], gone[..., 1], gone[..., 2], shapley[:, order])
        texts = ["".join(names[f] for f in o) for o in orders]
        return pa.RecordBatch.from_arrays(
            [pa.array([p for p in parts for _ in range(n)], pa.string()),
             pa.array(np.repeat(texts, k).tolist() * len(parts), pa.string()),
             pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(orders) * len(parts))),
             *(pa.array(np.ascontiguousarray(c).reshape(-1).astype(np.int64)) for c in columns)],
            names=["part", "filter_order", "step", *longs])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = b.to_pylist()
            for at in range(0, len(rows), PARTS):
                some = rows[at:at + PARTS]
                table = np.zeros((len(some), 1 << k, len(MEASURES)), np.int64)
                for i, row in enumerate(some):
                    for cell in row["cells"]:
                        table[i, cell["pattern"]] = [cell[m] for m in MEASURES]
                yield report([row["part"] for row in some], table)

    return per_part.mapInArrow(run, schema)


def document_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The report of the filters A (under 100 words), B (under 80 % distinct
    words), C (over 10 % capitals), D (a mark of ``#$%&*|``) and E (copy of a
    document with a smaller id), by language."""
    return audit(patterns(labelled(flagged(docs), labels)), "ABCDE")
