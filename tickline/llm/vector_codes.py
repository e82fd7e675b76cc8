"""Product codes of vectors, trained by Lloyd rounds over cover trees.

Components become integers, floor(scale * x), and a vector is cut into equal
consecutive parts.  Each part position has a codebook; a vector's code names
the nearest entry for each of its parts.

A task packs its vectors into blocks of bounded size and builds a cover tree
of every part position in each: a node is a ball (a centre that is one of its
points, a radius that covers all of them), its children are balls of at most
half the radius whose centres are further apart than that.  The points of a
subtree are a run of the block's tree order, so cumulative sums give a
subtree's count and sum as one difference.  Trees are written once and read by
every round.

To assign, a tree is walked from the root.  With r a node's radius and d1 the
distance from its centre to the nearest entry, an entry j at dj with
dj - r > d1 + r is nearest to no point of the node (triangle inequality) and is
left out below it.  When one entry remains the whole subtree is its own.  Only
leaves that stay ambiguous compare their points, exactly in integers, with the
entries that remain; ties go to the lower index.  The bounds are floating
point with a margin, so rounding can only make a node ambiguous.

A task adds up its blocks and shows one row per entry; what reaches the driver
is the codebook, whose size is a parameter.

Defined results: rows whose vector is null or holds null or non-finite
components go.  The width is that of the smallest vec_id (null ids last, ties
by components) whose vector has a positive multiple of ``parts`` components; a vector
of another width, or with a component of ``LARGEST`` or over (beyond which
64-bit sums are not exact), stays with a null code and error and trains
nothing.  Repeated ids are rows of their own.  With fewer vectors than entries
the codebook has as many entries as vectors; an entry equal to an earlier one
is never the nearest.  An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickline.llm.common import stage
from tickline.operators.joins import attach, materialize

LARGEST = 1 << 26       # of an integer component: squares and sums stay exact in 64 bits


@dataclass(frozen=True)
class CodeParams:
    parts: int = 16
    entries: int = 64
    rounds: int = 2
    scale: int = 256
    block: int = 4096      # vectors of a block
    leaf: int = 16         # points of a node that is not split


# ---------------------------------------------------------------------------
# one cover tree
# ---------------------------------------------------------------------------
@dataclass
class Tree:
    order: np.ndarray      # points in tree order
    nodes: np.ndarray      # per node: first and end in ``order``, centre (a point), first child, children
    radius: np.ndarray


def cover_tree(points: np.ndarray, leaf: int) -> Tree:
    """The tree of ``points`` (n x d integers, n > 0), nodes by level."""
    order = np.arange(len(points))
    span = _distance(points, points[0])
    nodes, radius = [[0, len(points), 0, 0, 0]], [float(span.max())]
    at = 0
    while at < len(nodes):
        first, end, centre, _, _ = nodes[at]
        if end - first > leaf and radius[at] > 0:
            half = radius[at] / 2
            rest, put, nodes[at][3] = order[first:end].copy(), first, len(nodes)
            while len(rest):
                far = _distance(points[rest], points[centre])
                near = far <= half
                mine = rest[near]
                order[put:put + len(mine)] = mine
                nodes.append([put, put + len(mine), centre, 0, 0])
                radius.append(float(far[near].max()))
                put, rest = put + len(mine), rest[~near]
                if len(rest):
                    centre = rest[0]
            nodes[at][4] = len(nodes) - nodes[at][3]
        at += 1
    return Tree(order, np.array(nodes, np.int64), np.array(radius))


def _distance(points: np.ndarray, centre: np.ndarray) -> np.ndarray:
    apart = points - centre
    return np.sqrt((apart * apart).sum(1).astype(np.float64))


def squared(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances, points x entries."""
    out = np.zeros((len(points), len(entries)), np.int64)
    for k in range(points.shape[1]):
        apart = points[:, k, None] - entries[None, :, k]
        out += apart * apart
    return out


_FAR = np.iinfo(np.int64).max


def assign(tree: Tree, points: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Nearest entries of a tree's points: (first, end, entry) of the runs of
    the tree order that are decided whole, then (positions in the order, their
    entries) of the points that were compared one by one."""
    first_of = np.zeros(len(entries), bool)
    first_of[np.unique(entries, axis=0, return_index=True)[1]] = True
    level, open_ = np.zeros(1, np.int64), first_of[None, :]
    runs, singles, theirs = [], [], []
    while len(level):
        start, end, centre, child, children = tree.nodes[level].T
        r = tree.radius[level]
        apart = np.where(open_, squared(points[centre], entries), _FAR)
        near = apart.argmin(1)
        far = np.sqrt(apart.astype(np.float64))
        reach = far[np.arange(len(level)), near] + 2 * r
        open_ = open_ & (far <= (reach * (1 + 1e-9) + 1e-6)[:, None])
        whole = (open_.sum(1) == 1) | (r == 0)
        runs.append(np.stack([start[whole], end[whole], near[whole]]))
        last = ~whole & (children == 0)
        if last.any():
            size = (end - start)[last]
            at = np.repeat(start[last] - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())
            some = np.where(np.repeat(open_[last], size, 0), squared(points[tree.order[at]], entries), _FAR)
            singles.append(at)
            theirs.append(some.argmin(1))
        down = ~whole & (children > 0)
        size = children[down]
        level = np.repeat(child[down] - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum()) if down.any() else level[:0]
        open_ = np.repeat(open_[down], size, 0)
    none = np.zeros(0, np.int64)
    return (*np.concatenate(runs, 1), np.concatenate([none, *singles]), np.concatenate([none, *theirs]))


def entry_sums(tree: Tree, points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """entries x (1 + d): how many points each entry has, and their sums."""
    in_order = points[tree.order]
    total = np.zeros((len(points) + 1, points.shape[1] + 1), np.int64)
    total[1:, 0] = 1
    total[1:, 1:] = in_order
    rows, total = total[1:], np.cumsum(total, 0)
    first, end, entry, at, theirs = assign(tree, points, entries)
    out = np.zeros((len(entries), points.shape[1] + 1), np.int64)
    np.add.at(out, entry, total[end] - total[first])
    np.add.at(out, theirs, rows[at])
    return out


def nearest(tree: Tree, points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """The entry of every point, in the points' own order."""
    first, end, entry, at, theirs = assign(tree, points, entries)
    in_order = np.empty(len(points), np.int64)
    in_order[at] = theirs
    for a, b, e in zip(first, end, entry):
        in_order[a:b] = e
    out = np.empty_like(in_order)
    out[tree.order] = in_order
    return out


# ---------------------------------------------------------------------------
# on Spark
# ---------------------------------------------------------------------------
BLOCK_SCHEMA = "ids array<long>, labels array<string>, q binary, orders binary, sizes array<int>, nodes binary, radius binary"


def integer_vectors(vectors: DataFrame, p: CodeParams, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """vec_id, label (as text), q (integer components) of the rows that stay, and
    whether 64-bit sums hold them."""
    x = F.col(vector).cast("array<double>")
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    rows = vectors.where(F.col(vector).isNotNull() & ~bad).select(
        F.col(vec_id).cast("long").alias("vec_id"), F.col(label).cast("string").alias("label"),
        F.transform(x, lambda v: F.floor(v * p.scale)).alias("q"))
    return rows.withColumn("exact", F.forall("q", lambda v: (v < LARGEST) & (v > -LARGEST)))


def first_vectors(rows: DataFrame, p: CodeParams) -> np.ndarray:
    """The vectors of the smallest ids, as many as a codebook has entries."""
    def of(some: DataFrame) -> list[list[int]]:
        return [r.q for r in some.orderBy(F.col("vec_id").asc_nulls_last(), "q").limit(p.entries).select("q").collect()]

    cut = rows.where(F.col("exact") & (F.size("q") > 0) & (F.size("q") % p.parts == 0))
    q = of(cut)
    if q and any(len(x) != len(q[0]) for x in q):
        q = of(cut.where(F.size("q") == len(q[0])))
    return np.array(q, np.int64)


def blocks(rows: DataFrame, width: int, p: CodeParams) -> DataFrame:
    """Rows of ``BLOCK_SCHEMA``: vectors and their trees, written once."""
    def pack(ids: list, labels: list, q: list) -> pa.RecordBatch:
        table = np.concatenate(q)
        d = width // p.parts
        trees = [cover_tree(table[:, k * d:(k + 1) * d], p.leaf) for k in range(p.parts)]
        return pa.RecordBatch.from_pylist([{
            "ids": sum((x.to_pylist() for x in ids), []), "labels": sum((x.to_pylist() for x in labels), []),
            "q": table.astype(np.int32).tobytes(), "orders": np.concatenate([t.order for t in trees]).astype(np.int32).tobytes(),
            "sizes": [len(t.nodes) for t in trees], "nodes": np.concatenate([t.nodes for t in trees]).astype(np.int32).tobytes(),
            "radius": np.concatenate([t.radius for t in trees]).tobytes()}], schema=out)

    out = pa.schema([("ids", pa.list_(pa.int64())), ("labels", pa.list_(pa.string())), ("q", pa.binary()), ("orders", pa.binary()),
                     ("sizes", pa.list_(pa.int32())), ("nodes", pa.binary()), ("radius", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, labels, q, held = [], [], [], 0
        for b in batches:
            for at in range(0, b.num_rows, p.block):
                s = b.slice(at, p.block)
                if held and held + s.num_rows > p.block:
                    yield pack(ids, labels, q)
                    ids, labels, q, held = [], [], [], 0
                ids.append(s.column(0))
                labels.append(s.column(1))
                q.append(s.column(2).flatten().to_numpy(zero_copy_only=False).reshape(-1, width))
                held += s.num_rows
        if held:
            yield pack(ids, labels, q)

    return stage(rows.select("vec_id", "label", "q").mapInArrow(run, BLOCK_SCHEMA), "codes-blocks")


def unpacked(row: dict, width: int, p: CodeParams) -> Iterator[tuple[int, Tree, np.ndarray]]:
    """(part position, tree, points) of a block."""
    q = np.frombuffer(row["q"], np.int32).reshape(-1, width).astype(np.int64)
    orders = np.frombuffer(row["orders"], np.int32).reshape(p.parts, -1)
    nodes = np.frombuffer(row["nodes"], np.int32).reshape(-1, 5).astype(np.int64)
    radius = np.frombuffer(row["radius"], np.float64)
    d, at = width // p.parts, 0
    for k, n in enumerate(row["sizes"]):
        yield k, Tree(orders[k], nodes[at:at + n], radius[at:at + n]), q[:, k * d:(k + 1) * d]
        at += n


def lloyd_round(trees: DataFrame, books: np.ndarray, p: CodeParams) -> np.ndarray:
    """The codebooks (parts x entries x d) after one round."""
    parts, entries, d = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((parts, entries, d + 1), np.int64)
        for b in batches:
            for i in range(b.num_rows):
                for k, tree, points in unpacked(b.slice(i, 1).to_pylist()[0], parts * d, p):
                    total[k] += entry_sums(tree, points, books[k])
        part, entry = np.nonzero(total[..., 0])
        if len(part):
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(entry), pa.array(total[part, entry].tolist(), pa.list_(pa.int64()))],
                                             names=["part", "entry", "s"])

    sums = (trees.select("q", "orders", "sizes", "nodes", "radius").mapInArrow(run, "part long, entry long, s array<long>")
                 .groupBy("part", "entry").agg(F.array(*(F.sum(F.col("s")[k]) for k in range(d + 1))).alias("s")))
    out = books.copy()
    for r in sums.collect():        # the codebook: parts * entries rows at most
        out[r.part, r.entry] = np.floor_divide(r.s[1:], r.s[0])
    return out


def coded(trees: DataFrame, books: np.ndarray, p: CodeParams) -> DataFrame:
    """vec_id, label, code and error of every vector."""
    parts, _, d = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                row = b.slice(i, 1).to_pylist()[0]
                n = len(row["ids"])
                code, error = np.zeros((n, parts), np.int64), np.zeros(n, np.int64)
                for k, tree, points in unpacked(row, parts * d, p):
                    code[:, k] = nearest(tree, points, books[k])
                    apart = points - books[k][code[:, k]]
                    error += (apart * apart).sum(1)
                digits = max(2, len(f"{books.shape[1] - 1:x}"))
                texts = ["".join(f"{c:0{digits}x}" for c in line) for line in code.tolist()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["ids"], pa.int64()), pa.array(row["labels"], pa.string()), pa.array(texts, pa.string()), pa.array(error)],
                    names=["vec_id", "label", "code", "error"])

    return trees.mapInArrow(run, "vec_id long, label string, code string, error long")


def books_digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()


def train(vectors: DataFrame, params: CodeParams = CodeParams(), **columns: str) -> tuple[np.ndarray, DataFrame, DataFrame]:
    """The codebooks (parts x entries x d), the blocks with their trees, and
    the rows that no code fits."""
    p = params
    rows = integer_vectors(vectors, p, **columns)
    first = first_vectors(rows, p)
    if not len(first):
        return np.zeros((p.parts, 0, 0), np.int64), rows.sparkSession.createDataFrame([], BLOCK_SCHEMA), rows
    width = first.shape[1]
    fits = F.col("exact") & (F.size("q") == width)
    trees = blocks(rows.where(fits), width, p)
    books = np.ascontiguousarray(first.reshape(len(first), p.parts, -1).transpose(1, 0, 2))
    for _ in range(p.rounds):
        books = lloyd_round(trees, books, p)
    return books, trees, rows.where(~fits)


def compress(vectors: DataFrame, params: CodeParams = CodeParams(), **columns: str) -> DataFrame:
    """vec_id, label (as text), code, error, label_error, codebooks_sha256 of
    every row with a usable vector."""
    books, trees, others = train(vectors, params, **columns)
    done = stage(coded(trees, books, params), "codes-coded") if books.shape[1] else trees.select(
        F.lit(0).cast("long").alias("vec_id"), F.lit("").alias("label"), F.lit("").alias("code"), F.lit(0).cast("long").alias("error"))
    done = done.unionByName(others.select("vec_id", "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error")))
    key = F.coalesce(F.concat(F.lit("="), F.col("label")), F.lit(""))
    sums = materialize(done.groupBy(key.alias("_label")).agg(F.sum("error").alias("label_error")))
    return attach(done.withColumn("_label", key), sums, "_label", "left").select(
        "vec_id", "label", "code", "error", "label_error", F.lit(books_digest(books)).alias("codebooks_sha256"))
