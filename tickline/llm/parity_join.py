"""N-gram Jaccard self-join by parity sketches.

A document's set holds its distinct word shingles.  Hash every shingle to one
bit of a sketch and XOR: the Hamming distance of two sketches is at most the
symmetric difference of the sets.  For sets of at most U shingles with Jaccard
similarity >= t the symmetric difference is at most
D = floor(2 U (1 - t) / (1 + t)), so of D + 1 sketch segments at least one is
equal (pigeonhole).  That segment is the join key; pairs that meet are
verified on the sets.  No linked pair is missed.

* A segment without any token says little: many unrelated sets have the same
  ones empty.  So a group has w segments more than D + 1; then w + 1 of them
  are equal, and a set with at most w empty ones needs to show only the others.
  (w is set so that few sets have more; those show the empty ones too.)
* Sizes are cut into bands so that linked sets lie in one band or in
  neighbours; a document takes part in the group of its own band and in the
  next one's.  All of a group share U, and with it the sketch's width.
* Documents with the same set are one class from the start (copies cost
  nothing), and only classes meet.
* What is asked for is the component, so pairs within one component need no
  check.  The classes of a bucket are compared in place, a bucket of many in
  blocks of bounded size, by a folded parity sketch of a few bits a shingle:
  its Hamming distance is a lower bound as well, and a sharp one.
  Each block joins up what passes and shows only a forest, one pair less than
  it has classes at most; those pairs are verified on the sets and contracted.
* A pair that passes and is not linked can hide others.  So buckets that still
  hold several components are gone through again: classes with a passing
  partner in another component are shown, one row each, and a block verifies
  them on their sets in place, joins up as it goes and shows a forest again.

So rows do not grow with the square of a group of near copies (comparisons in
place do), and no pair of different components goes unchecked.

Defined results: a null text or one without words is empty and linked with
nothing; a text with fewer words than a shingle is one shingle; repeated rows
(also with equal doc_id) are members of one class; rows with a null doc_id
take part, and a component of such rows only has a null id.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickline.llm.common import discard, packed, stage, words
from tickline.llm.components import components
from tickline.operators.joins import Measured

SEGMENT_BITS = 1 << 16     # of one segment; only a hash of its set bits is kept
SEEN_SETS = 500_000        # that a task remembers
BLOCK = 4096               # classes of a bucket that are compared at a time,
BLOCK_SHINGLES = 1 << 24   # or fewer if they have more shingles than that
FOLD = 2                   # bits a shingle of a folded sketch, at least
_ODD = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class JoinParams:
    """Shingles of ``width`` words; linked when num/den <= Jaccard similarity."""
    width: int = 3
    num: int = 90
    den: int = 100


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * _ODD
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def shingles(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles."""
    w = words(text)
    if not w:
        return np.empty(0, np.uint64)
    if len(w) < width:
        return np.array([xxhash.xxh3_64_intdigest(b"\x00" + b" ".join(w))], np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, w), dtype=np.uint64, count=len(w))
    n = len(w) - width + 1
    s = np.zeros(n, np.uint64)
    for k in range(width):
        s = _mix(s * _ODD + h[k:k + n])
    return np.unique(s)


class Bands:
    """Size bands and the number of segments of each group."""

    def __init__(self, p: JoinParams):
        self.p, self.lows = p, [1, 2]
        self.groups: dict[int, tuple[int, int]] = {}

    def _until(self, size: int) -> None:
        while self.lows[-1] <= size:
            # the largest set that may be linked to one just below this bound is still in the next band
            reach = (self.lows[-1] - 1) * self.p.den // self.p.num + 1
            self.lows.append(max(self.lows[-1] + 1, reach))

    def band(self, size: int) -> int:
        self._until(size)
        return int(np.searchsorted(self.lows, size, side="right")) - 1

    def segments(self, group: int) -> tuple[int, int]:
        """Segments D + 1 + w, with U the largest size of the group's band, and
        w: what the smallest sets of the group leave empty, with a margin (0 if
        that can't be had, at low similarities)."""
        if group not in self.groups:
            while len(self.lows) < group + 2:
                self._until(self.lows[-1])
            most = 2 * (self.lows[group + 1] - 1) * (self.p.den - self.p.num) // (self.p.den + self.p.num)
            least, spare = self.lows[max(0, group - 1)], 0
            for m in range(most + 1, 2 * most + 3):
                empty = m * (1 - 1 / m) ** least
                if m - empty - np.sqrt(empty) >= most + 1:
                    spare = m - most - 1
                    break
            self.groups[group] = (most + 1 + spare, spare) if most else (1, 0)
        return self.groups[group]

    def keys(self, s: np.ndarray) -> np.ndarray:
        """The join keys of a set, from the segments of its two groups.  A group
        with D = 0 links equal sets only, which are one class already."""
        if not len(s):
            return np.empty(0, np.int64)
        out = []
        own = self.band(len(s))
        # XOR of a random word per bit: the hash of a segment's parity bits.
        bits = _mix((s & np.uint64(SEGMENT_BITS - 1)) + np.uint64(1))
        for group in (own, own + 1):
            m, spare = self.segments(group)
            if m == 1:
                continue
            sketch = np.zeros(m, np.uint64)
            at = ((s >> np.uint64(16)) % np.uint64(m)).astype(np.int64)
            np.bitwise_xor.at(sketch, at, bits)
            place = _mix(np.arange(m, dtype=np.uint64) + (np.uint64(group) << np.uint64(40)))
            keys = _mix(sketch ^ place)
            full = np.bincount(at, minlength=m) > 0
            out.append(keys[full] if m - full.sum() <= spare else keys)
        return np.concatenate(out).view(np.int64) if out else np.empty(0, np.int64)


def _print(s: np.ndarray) -> tuple[int, int]:
    d = np.frombuffer(xxhash.xxh3_128_digest(s.tobytes()), np.int64)
    return int(d[0]), int(d[1])


def folded(s: np.ndarray) -> bytes:
    """Parity sketch of at least ``FOLD`` bits a shingle; its width is a power of
    two (64 bits or more), so that a wider one folds to a narrower by XOR."""
    width = max(64, 1 << (FOLD * len(s) - 1).bit_length()) if len(s) else 64
    bits = np.bincount(((s >> np.uint64(8)) & np.uint64(width - 1)).astype(np.int64), minlength=width) & 1
    return np.packbits(bits.astype(np.uint8), bitorder="little").tobytes()


def _narrow(x: np.ndarray, words: int) -> np.ndarray:
    while x.shape[-1] > words:
        half = x.shape[-1] // 2
        x = x[..., :half] ^ x[..., half:]
    return x


def _bound(total, p: JoinParams):
    """The symmetric difference that linked sets of ``total`` shingles
    together may have at most."""
    return total * (p.den - p.num) // (p.den + p.num)


def _sketched(docs: DataFrame, p: JoinParams) -> DataFrame:
    """doc_id, n (set size), f1, f2 (set's print), keys, fold.  A task shows the
    keys of a set once, so that copies do not crowd the buckets."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands = Bands(p)
        seen: set[tuple[int, int]] = set()
        none = np.empty(0, np.int64)
        for b in batches:
            n, f1, f2, keys, fold = [], [], [], [], []
            for t in b.column(1):
                s = shingles(t.as_py(), p.width)
                x, y = _print(s)
                n.append(len(s))
                f1.append(x)
                f2.append(y)
                keys.append(none if (x, y) in seen else bands.keys(s))
                if len(seen) >= SEEN_SETS:
                    seen.clear()
                seen.add((x, y))
                fold.append(folded(s))
            ends = np.cumsum([0, *map(len, keys)]).astype(np.int32)
            flat = np.concatenate(keys) if keys else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays([
                b.column(0), pa.array(n, pa.int64()), pa.array(f1, pa.int64()), pa.array(f2, pa.int64()),
                pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, pa.int64())), pa.array(fold, pa.binary())],
                names=["doc_id", "n", "f1", "f2", "keys", "fold"])

    return docs.mapInArrow(run, "doc_id long, n long, f1 long, f2 long, keys array<long>, fold binary")


def _sets(docs: DataFrame, wanted: DataFrame, p: JoinParams) -> DataFrame:
    """cid and the set (packed sorted hashes) of the wanted classes, from the
    text of one of their documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cid, out = [], []
            for c, f1, f2, t in zip(*(b.column(k).to_pylist() for k in range(3)), b.column(3)):
                s = shingles(t.as_py(), p.width)
                if _print(s) == (f1, f2):          # doc_id may stand on other texts too
                    cid.append(c)
                    out.append(s.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(cid, pa.int64()), pa.array(out, pa.binary())], names=["cid", "set"])

    side = Measured(wanted, wanted.count()).side()
    found = (docs.join(side, docs["doc_id"].eqNullSafe(side["first_doc"])).select("cid", "f1", "f2", "text")
                 .mapInArrow(run, "cid long, set binary"))
    return stage(found.dropDuplicates(["cid"]), "sets")


def _verified(pairs: DataFrame, classes: DataFrame, docs: DataFrame, p: JoinParams) -> DataFrame:
    """The pairs (u, v) whose sets are similar enough."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = []
            for x, y in zip(b.column(2), b.column(3)):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = len(x) + len(y) - len(np.union1d(x, y))
                keep.append(p.den * both >= p.num * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], names=["u", "v"]).filter(pa.array(keep, pa.bool_()))

    ends = pairs.select(F.col("u").alias("cid")).unionByName(pairs.select(F.col("v").alias("cid"))).distinct()
    sets = _sets(docs, stage(classes.select("cid", "f1", "f2", "first_doc").join(ends, "cid", "left_semi"), "wanted"), p)
    other = sets.select(F.col("cid").alias("v"), F.col("set").alias("set_v"))
    own = sets.select(F.col("cid").alias("u"), F.col("set").alias("set_u"))
    links = stage(pairs.join(other, "v").join(own, "u").select("u", "v", "set_u", "set_v").mapInArrow(run, "u long, v long"), "links")
    discard(sets)
    return links


def _meetings(rows: DataFrame) -> DataFrame:
    """(key, cid, n, blocks) of the keys that several classes hold; ``blocks``
    are those that the key's bucket is compared in.  Near copies share many
    keys, so of buckets with the same classes one is kept (buckets go by 128
    bits of sums of their classes' hashes)."""
    each = rows.select(F.explode("keys").alias("key"), "cid", "n")
    bucket = Window.partitionBy("key").orderBy("cid")
    whole = bucket.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = F.lag("cid").over(bucket)
    # Each class once, in buckets of several.  What follows uses the same shuffle; its inputs are made behind it.
    each = (each.select("key", "cid", "n", (F.first("cid").over(whole) != F.last("cid").over(whole)).alias("several"), before.alias("before"))
                .where(F.col("several") & (F.col("before").isNull() | (F.col("before") != F.col("cid")))))
    held = F.greatest(F.lit(1), F.least(F.lit(BLOCK), F.lit(BLOCK_SHINGLES) / F.max("n").over(whole)))
    sums = []
    for seed in (1, 2):
        h = F.xxhash64("cid", F.lit(seed))
        sums += [F.sum(h.bitwiseAND(F.lit(0xFFFFFFFF))).over(whole), F.sum(F.shiftrightunsigned(h, 32)).over(whole)]
    met = stage(each.select("key", "cid", "n", F.ceil(F.count(F.lit(1)).over(whole) / held).cast("int").alias("blocks"),
                            *(F.xxhash64(F.lit(k), *sums).alias(f"same{k}") for k in (1, 2)), F.col("before").isNull().alias("first")), "meetings")
    one = met.where("first").groupBy("same1", "same2").agg(F.min("key").alias("key")).select("key")
    kept = stage(met.select("key", "cid", "n", "blocks").join(one, "key", "left_semi"), "buckets")
    discard(met)
    return kept


def _merged(root: DataFrame, links: DataFrame) -> DataFrame:
    """The roots (id, root) after more links: only the old roots that the new
    links touch are contracted again."""
    old = root.withColumnRenamed("id", "v")
    for end in ("u", "v"):
        links = links.join(root.select(F.col("id").alias(end), F.col("root").alias("r")), end, "left").withColumn(end, F.coalesce("r", end)).drop("r")
    new = components(links)
    moved = old.join(new.select(F.col("id").alias("root"), F.col("root").alias("r")), "root", "left").select(F.col("v").alias("id"), F.coalesce("r", "root").alias("root"))
    # ids seen for the first time (a root is an id of its own component already)
    return stage(moved.unionByName(new.join(root.select("id"), "id", "left_anti")), "roots")


def _dealt(met: DataFrame, values: DataFrame, column: str) -> DataFrame:
    """The rows of every pair of a bucket's blocks together: key, i, j, cid, n,
    root, b (a row's own block), ``column``."""
    blocks = F.col("blocks")
    rows = (met.join(values.select("cid", column), "cid").withColumn("b", F.pmod(F.xxhash64("cid"), blocks).cast("int"))
               .withColumn("o", F.explode(F.sequence(F.lit(0), blocks - 1)))
               .select("key", F.least("b", "o").alias("i"), F.greatest("b", "o").alias("j"), "cid", "n", "root", "b", column))
    return rows.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "cid")


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, list[tuple]]]:
    """((key, i, j), its rows), from batches sorted by that."""
    group, rows = None, []
    for b in batches:
        for r in zip(*(c.to_pylist() for c in b.columns)):
            if r[:3] != group:
                if len(rows) > 1:
                    yield group, rows
                group, rows = r[:3], []
            rows.append(r)
    if len(rows) > 1:
        yield group, rows


class _Block:
    """Classes that are compared with each other, or across two blocks."""

    def __init__(self, group: tuple, rows: list[tuple], p: JoinParams):
        self.p, self.across = p, group[1] != group[2]
        self.cid, self.n, self.root, self.block = (np.array([r[k] for r in rows]) for k in (3, 4, 5, 6))
        self.label = np.unique(self.root, return_inverse=True)[1]
        self.last = [r[7] for r in rows]
        self.sketch = None

    def rest(self, k: int) -> np.ndarray:
        """Classes after the ``k``-th that are of another component and of a fitting size."""
        m, p = self.n[k + 1:], self.p
        ok = (self.label[k + 1:] != self.label[k]) & (np.minimum(m, self.n[k]) * p.den >= np.maximum(m, self.n[k]) * p.num)
        if self.across:
            ok &= self.block[k + 1:] != self.block[k]
        return np.flatnonzero(ok) + k + 1

    def passing(self, k: int) -> np.ndarray:
        """Of those, the ones whose folded sketch is near enough."""
        if self.sketch is None:
            w = min(map(len, self.last)) // 8
            self.sketch = np.stack([_narrow(np.frombuffer(x, np.uint64), w) for x in self.last])
        at = self.rest(k)
        if len(at):
            at = at[np.bitwise_count(self.sketch[at] ^ self.sketch[k]).sum(axis=1) <= _bound(self.n[at] + self.n[k], self.p)]
        return at

    def similar(self, a: int, b: int) -> bool:
        x, y = (np.frombuffer(self.last[k], np.uint64) for k in (a, b))
        both = len(x) + len(y) - len(np.union1d(x, y))
        return self.p.den * both >= self.p.num * (len(x) + len(y) - both)

    def join(self, a: int, b: int) -> None:
        self.label[self.label == self.label[b]] = self.label[a]

    def forest(self) -> list[tuple[int, int]]:
        """Pairs that pass and join up all that do."""
        out = []
        for k in range(len(self.cid) - 1):
            for v in self.passing(k).tolist():
                if self.label[v] != self.label[k]:
                    out.append((int(self.cid[k]), int(self.cid[v])))
                    self.join(k, v)
        return out

    def open(self) -> list[int]:
        """The classes with a passing partner in another component."""
        mark = np.zeros(len(self.cid), bool)
        for k in range(len(self.cid) - 1):
            at = self.passing(k)
            mark[at] = True
            mark[k] |= len(at) > 0
        return np.flatnonzero(mark).tolist()

    def links(self) -> list[tuple[int, int]]:
        """Verified pairs that join up all that are similar; ``last`` holds the sets."""
        out = []
        for k in range(len(self.cid) - 1):
            for v in self.rest(k).tolist():
                if self.label[v] != self.label[k] and self.similar(k, v):
                    out.append((int(self.cid[k]), int(self.cid[v])))
                    self.join(k, v)
        return out


def _pairs_of(rows: DataFrame, p: JoinParams, exact: bool) -> DataFrame:
    """A forest (u, v) from every block: of what passes, or of what is similar."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group, rows in _blocks(batches):
            block = _Block(group, rows, p)
            found = block.links() if exact else block.forest()
            if found:
                yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)], names=["u", "v"])

    pairs = rows.mapInArrow(run, "u long, v long")
    return pairs.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()


def _open_rows(rows: DataFrame, p: JoinParams) -> DataFrame:
    """key, i, j, cid, n, root, b of the classes that a block leaves open."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group, rows in _blocks(batches):
            at = _Block(group, rows, p).open()
            if at:
                yield pa.RecordBatch.from_pylist([dict(zip(names, rows[k])) for k in at], schema=schema)

    names = ("key", "i", "j", "cid", "n", "root", "b")
    schema = pa.schema([(c, pa.int32() if c in ("i", "j", "b") else pa.int64()) for c in names])
    return rows.mapInArrow(run, "key long, i int, j int, cid long, n long, root long, b int")


def _mixed(met: DataFrame, root: DataFrame) -> DataFrame:
    """The buckets that hold several components."""
    now = met.join(root.withColumnRenamed("id", "cid"), "cid", "left").withColumn("root", F.coalesce("root", "cid"))
    key = now.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi").select("key")
    return now.join(key, "key")


def similar_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", params: JoinParams = JoinParams()) -> DataFrame:
    """doc_id, n (set size), f1 and f2 (the set's print), root and component_id
    for every row of ``docs``; the last two are null for a row that is linked
    with no other and has no equal."""
    p = params
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    rows = stage(_sketched(docs, p), "sketches")
    classes = stage(rows.where("n > 0").groupBy("n", "f1", "f2")
                        .agg(F.min("doc_id").alias("first_doc"), F.count(F.lit(1)).alias("members"))
                        .withColumn("number", F.monotonically_increasing_id()), "classes")
    # A class goes by half of its print, unless two classes share that half.
    if classes.groupBy("f1").agg(F.count(F.lit(1)).alias("c")).where("c > 1").isEmpty():
        classes = classes.withColumn("cid", F.col("f1"))
        keyed = rows.withColumn("cid", F.col("f1"))
    else:
        classes = classes.withColumn("cid", F.col("number"))
        keyed = rows.join(classes.select("n", "f1", "f2", "cid"), ["n", "f1", "f2"])
    prints = stage(rows.select("doc_id", "n", "f1", "f2"), "prints")
    met = _meetings(keyed)
    folds = stage(keyed.select("cid", "n", "fold").join(met.select("cid").distinct(), "cid", "left_semi").dropDuplicates(["cid"]), "folds")
    discard(rows)
    root = None
    if not met.isEmpty():
        pairs = stage(_pairs_of(_dealt(met.withColumn("root", F.col("cid")), folds, "fold"), p, False), "pairs")
        root = components(_verified(pairs, classes, docs, p))
        left = stage(_open_rows(_dealt(_mixed(met, root), folds, "fold"), p), "open")
        if not left.isEmpty():
            sets = _sets(docs, stage(classes.select("cid", "f1", "f2", "first_doc").join(left.select("cid").distinct(), "cid", "left_semi"), "wanted"), p)
            rows_of = left.join(sets, "cid").select("key", "i", "j", "cid", "n", "root", "b", "set").repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "cid")
            root = _merged(root, stage(_pairs_of(rows_of, p, True), "links"))
    named = classes.select("cid", "n", "f1", "f2", "first_doc", "members")
    if root is not None:
        named = named.join(root.withColumnRenamed("id", "cid"), "cid", "left").withColumn("linked", F.col("root").isNotNull()).withColumn("root", F.coalesce("root", "cid"))
    else:
        named = named.withColumn("linked", F.lit(False)).withColumn("root", F.col("cid"))
    # Components of one class with one member keep their own id; only others are joined to the rows.
    named = named.where("linked or members > 1")
    ids = named.groupBy("root").agg(F.min("first_doc").alias("component_id"))
    named = stage(named.join(ids, "root").select("n", "f1", "f2", "root", "component_id"), "named")
    return prints.join(named, ["n", "f1", "f2"], "left")


def similar_classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", params: JoinParams = JoinParams()) -> DataFrame:
    """doc_id, n_shingles, component_id (least doc_id of the component) for
    every row of ``docs``."""
    return similar_groups(docs, doc_id, text, params).select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def drop_similar(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", params: JoinParams = JoinParams()) -> DataFrame:
    """``docs`` with all its columns and, of each component, the row of its
    least doc_id only (a null id counts as more than any)."""
    found = stage(similar_groups(docs, doc_id, text, params), "groups")
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("f1"), F.col("f2"))
    first = found.where("root is not null").groupBy("root").agg(F.min(order).alias("first"))
    # One row for each different (doc_id, set): whether its row stays, and how many rows it stands for.
    marks = stage(found.join(first, "root", "left").groupBy("doc_id", "f1", "f2")
                       .agg(F.count(F.lit(1)).alias("rows"), F.max(F.coalesce(order == F.col("first"), F.lit(True))).alias("stays"), F.max(F.col("root").isNotNull()).alias("grouped")), "marks")
    ids = stage(marks.groupBy("doc_id").agg(F.sum("rows").alias("rows"), F.min("stays").alias("stays"), F.max("grouped").alias("grouped")).where("grouped and (rows > 1 or not stays)"), "ids")

    def side(df: DataFrame) -> DataFrame:
        return Measured(df.select("doc_id"), df.count()).side()

    # The rows go as one column, so that no name of theirs clashes with the keys.
    all_rows = packed(docs).withColumn("id", F.col("row")[doc_id].cast("long"))
    same = F.col("id").eqNullSafe(F.col("doc_id"))
    rest = all_rows.join(side(ids), same, "left_anti")
    several = ids.where("rows > 1")
    if several.isEmpty():
        return rest.select("row.*")
    # An id on several rows: tell them apart by their sets.
    @F.pandas_udf("array<long>")
    def prints(texts):
        return texts.map(lambda t: list(_print(shingles(t, params.width))))

    rows = all_rows.join(side(several), same, "left_semi").withColumn("print", prints(F.coalesce(F.col("row")[text].cast("string"), F.lit(""))))
    stay = marks.where("stays or not grouped").select("doc_id", F.array("f1", "f2").alias("own"), "grouped")
    rows = rows.join(stay, same & (F.col("print") == F.col("own")))
    once = rows.where("grouped").dropDuplicates(["id", "print"])
    return rest.select("row").unionByName(rows.where("not grouped").unionByName(once).select("row")).select("row.*")
