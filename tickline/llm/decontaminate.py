"""Benchmark passages in documents, by a prefix-filtered join.

An item's windows are its runs of ``width`` words (a shorter item is one window).  A
window's tokens are its word shingles of ``shingle`` words.  A document that
holds the window holds all of its tokens, so any one of them may stand for it:
with the tokens in order of rarity, the prefix that has to be joined is the
rarest one alone.

1. The tokens of all windows are counted in the documents.  A window with a
   token that occurs nowhere is in no document and goes.
2. Of the others the rarest token is the prefix (ties: the smaller hash, then
   the first position in the window).
3. The documents are read again.  Where a prefix token stands, the window
   would begin as many words earlier as the token stands into it (positional
   bound), and has to end within the text (length bound).  Those runs of words
   are looked up by exact equality with the windows.

Hashes only choose what is looked at: they are of 64 bits and the last step
compares texts.  What a task holds of the benchmark are bit filters of bounded
size (``FILTER_BITS`` at most, whatever its number of windows), which let all
true cases through; the joins decide.  They broadcast a side only when it is
measured small.  A document's words never leave its task but for the runs that
pass both filters.

Words are maximal runs of 0-9, a-z and everything beyond ASCII, after A-Z in
lower case.

Defined results: a null text has no words; an item without words has no
windows; items of equal text are each reported; an item without an id marks
words as hit but is neither counted nor named; rows with a repeated or null
doc_id are documents of their own; without items nothing is hit.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickline.llm.common import stage
from tickline.operators.joins import Measured, attach, materialize

_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
CHUNK_WORDS = 1 << 15          # words of a text that are hashed at a time
FILTER_BITS = 1 << 28          # of a bit filter at most (32 MB)
BITS_A_KEY = 64                # below that bound
_MULTIPLIER = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


@dataclass(frozen=True)
class LeakParams:
    width: int = 10
    shingle: int = 5


def leak_words(text: bytes) -> list[bytes]:
    return text.translate(_TABLE).split()


# ---------------------------------------------------------------------------
# hashes of runs of words
# ---------------------------------------------------------------------------
class Runs:
    """Hashes of runs of words: a polynomial over the bytes of the words joined
    by single blanks, modulo 2^64, from cumulative sums."""

    _up = np.ones(1, np.uint64)
    _down = np.ones(1, np.uint64)

    def __init__(self, words: list[bytes]):
        text = np.frombuffer(b" ".join(words), np.uint8)
        if len(text) >= len(Runs._up):
            size = 1 << len(text).bit_length()
            Runs._up = _powers(_MULTIPLIER, size)
            Runs._down = _powers(pow(_MULTIPLIER, -1, 1 << 64), size)
        self.sums = np.zeros(len(text) + 1, np.uint64)
        np.cumsum((text.astype(np.uint64) + np.uint64(1)) * Runs._up[:len(text)], out=self.sums[1:])
        blanks = np.flatnonzero(text == 32)
        self.first = np.concatenate([[0], blanks + 1])
        self.end = np.concatenate([blanks, [len(text)]])

    def hashes(self, starts: np.ndarray, length: int) -> np.ndarray:
        """Of the runs of ``length`` words that begin at the words ``starts``."""
        a = self.first[starts]
        h = (self.sums[self.end[starts + length - 1]] - self.sums[a]) * Runs._down[a]
        h ^= h >> np.uint64(31)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        return h ^ (h >> np.uint64(29))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out)


# ---------------------------------------------------------------------------
# bit filters
# ---------------------------------------------------------------------------
class BitFilter:
    """Two bits a key; says yes to every key that was put in."""

    def __init__(self, bits: int, words: np.ndarray):
        self.bits, self.words = bits, words

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        out = np.ones(len(keys), bool)
        for at in (keys & np.uint64(self.bits - 1), (keys >> np.uint64(32)) & np.uint64(self.bits - 1)):
            out &= (self.words[at >> np.uint64(5)] >> (at & np.uint64(31)).astype(np.uint32)) & np.uint32(1) > 0
        return out


def bit_filter(keys: DataFrame, column: str, n: int) -> BitFilter:
    """Of a column of longs with about ``n`` values.  Spark sets the bits; the
    driver gets the filter's words, ``FILTER_BITS`` / 32 at most."""
    bits = min(FILTER_BITS, 1 << max(10, (n * BITS_A_KEY).bit_length()))
    k = F.col(column)
    at = F.explode(F.array(k.bitwiseAND(F.lit(bits - 1)), F.shiftrightunsigned(k, 32).bitwiseAND(F.lit(bits - 1)))).alias("at")
    words = (keys.select(at).groupBy(F.shiftright("at", 5).cast("int").alias("w"))
                 .agg(F.bit_or(F.expr("shiftleft(1L, cast(at & 31 AS int))")).alias("b")).toArrow())
    table = np.zeros(bits // 32, np.uint32)
    table[words.column("w").to_numpy()] = words.column("b").to_numpy().astype(np.uint32)
    return BitFilter(bits, table)


class Sized(Measured):
    """A staged table whose texts count with their real size."""

    def __init__(self, df: DataFrame):
        done = materialize(df)
        super().__init__(done.df, done.rows)
        texts = [f.name for f in df.schema.fields if f.dataType == T.StringType()]
        self.text_bytes = done.df.agg(sum((F.coalesce(F.sum(F.octet_length(c)), F.lit(0)) for c in texts), F.lit(0))).first()[0]

    @property
    def bytes(self) -> int:
        return super().bytes + self.text_bytes


# ---------------------------------------------------------------------------
# items
# ---------------------------------------------------------------------------
def item_windows(items: DataFrame, p: LeakParams, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """item_id, window (its words joined by blanks), length, code (the window's
    hash), tokens (hashes by position)."""
    names = ["item_id", "window", "length", "code", "tokens"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, t in zip(b.column(0).to_pylist(), b.column(1)):
                words = leak_words(t.as_py() or b"")
                for at in range(0, len(words), CHUNK_WORDS):
                    some = words[at:at + CHUNK_WORDS + p.width - 1]
                    if at and len(some) < p.width:
                        continue
                    length = min(p.width, len(some))
                    size = min(p.shingle, length)
                    n = len(some) - length + 1
                    runs = Runs(some)
                    tokens = runs.hashes(np.arange(len(some) - size + 1), size).view(np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([i] * n, pa.string()), pa.array([b" ".join(some[k:k + length]).decode("utf-8", "replace") for k in range(n)], pa.string()),
                         pa.array([length] * n, pa.int32()), pa.array(runs.hashes(np.arange(n), length).view(np.int64)),
                         pa.array([tokens[k:k + length - size + 1] for k in range(n)], pa.list_(pa.int64()))], names=names)

    return (items.select(F.col(item_id).cast("string").alias("item_id"), F.col(text).cast("string").cast("binary").alias("text"))
                 .mapInArrow(run, "item_id string, window string, length int, code long, tokens array<long>").dropDuplicates(["item_id", "window"]))


# ---------------------------------------------------------------------------
# documents
# ---------------------------------------------------------------------------
def _chunks(words: list[bytes], overlap: int) -> Iterator[tuple[int, int, list[bytes]]]:
    """For each stretch of ``CHUNK_WORDS``: the first word shown, the first of
    its own, and its words with ``overlap`` more on either side."""
    for at in range(0, len(words), CHUNK_WORDS):
        lo = max(0, at - overlap)
        yield lo, at, words[lo:at + CHUNK_WORDS + overlap]


def _own(lo: int, at: int, some: list[bytes], size: int) -> np.ndarray:
    """Where a stretch's own runs of ``size`` words begin."""
    return np.arange(at - lo, min(at - lo + CHUNK_WORDS, len(some) - size + 1))


def token_counts(docs: DataFrame, text: str, known: BitFilter, sizes: list[int]) -> Measured:
    """token, n: how often runs of ``sizes`` words that the filter knows stand in the documents."""
    shared = docs.sparkSession.sparkContext.broadcast((known.bits, known.words))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        knows = BitFilter(*shared.value)
        for b in batches:
            found = []
            for t in b.column(0):
                for lo, at, some in _chunks(leak_words(t.as_py() or b""), max(sizes)):
                    runs = Runs(some)
                    for size in sizes:
                        h = runs.hashes(_own(lo, at, some, size), size)
                        found.append(h[knows(h)])
            if found:
                keys, n = np.unique(np.concatenate(found), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(n)], names=["token", "n"])

    done = materialize(docs.select(F.col(text).cast("string").cast("binary")).mapInArrow(run, "token long, n long")
                           .groupBy("token").agg(F.sum("n").alias("n")))
    shared.destroy()
    return done


def rarest(windows: DataFrame, counts: Measured) -> DataFrame:
    """window, length, code, token, place (of the rarest token) of the windows
    whose tokens all occur."""
    tokens = windows.select("window", "length", "code", F.posexplode("tokens").alias("place", "token"))
    best = F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token", "place")).alias("x")
    return (attach(tokens, counts, "token", "left").groupBy("window", "length", "code").agg(best).where("x.n > 0")
            .select("window", "length", "code", "x.token", "x.place"))


def candidate_runs(docs: DataFrame, keep: list[str], text: str, prefixes: BitFilter, ends: BitFilter, shapes: list[tuple[int, int, int]]) -> DataFrame:
    """key, row (the columns ``keep``), n_words, and the runs of words (start,
    place, window) around prefix tokens that both filters know.  ``shapes`` are
    the (token's words, window's words, token's place) that windows have."""
    shared = docs.sparkSession.sparkContext.broadcast((prefixes.bits, prefixes.words, ends.bits, ends.words))
    by_size: dict[int, list[tuple[int, int]]] = {}
    for size, length, place in shapes:
        by_size.setdefault(size, []).append((length, place))
    overlap = max((length for _, length, _ in shapes), default=1)
    run_type = pa.list_(pa.struct([("start", pa.int32()), ("place", pa.int32()), ("window", pa.string())]))

    def runs_of(words: list[bytes], is_prefix: BitFilter, is_window: BitFilter) -> list[dict]:
        out = []
        for lo, at, some in _chunks(words, overlap) if by_size else ():
            runs = Runs(some)
            for size, ways in by_size.items():
                own = _own(lo, at, some, size)
                here = own[is_prefix(runs.hashes(own, size))]
                for length, place in ways if len(here) else ():
                    start = here - place
                    start = start[(start >= 0) & (start + length <= len(some))]
                    start = start[is_window(runs.hashes(start, length))]
                    out += [{"start": lo + s, "place": place, "window": b" ".join(some[s:s + length]).decode("utf-8", "replace")} for s in start.tolist()]
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        bits, table, end_bits, end_table = shared.value
        is_prefix, is_window = BitFilter(bits, table), BitFilter(end_bits, end_table)
        key = TaskContext.get().partitionId() << 40
        for b in batches:
            words = [leak_words(t.as_py() or b"") for t in b.column(1)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(key, key + b.num_rows), pa.int64()), b.column(0), pa.array(map(len, words), pa.int64()),
                 pa.array([runs_of(w, is_prefix, is_window) for w in words], run_type)], names=["key", "row", "n_words", "runs"])
            key += b.num_rows

    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in keep)).alias("row"), F.col(text).cast("string").cast("binary").alias("text"))
    schema = T.StructType([T.StructField("key", T.LongType()), T.StructField("row", rows.schema["row"].dataType), T.StructField("n_words", T.LongType()),
                           T.StructField("runs", T.ArrayType(T.StructType([
                               T.StructField("start", T.IntegerType()), T.StructField("place", T.IntegerType()), T.StructField("window", T.StringType())])))])
    # Written once, so that a row's key is the same for all who read it.
    out = stage(rows.mapInArrow(run, schema), "leaks-runs")
    shared.destroy()
    return out


def covered(spans: Column) -> Column:
    """Words inside any of the spans (sorted structs of start and length)."""
    def add(acc: Column, s: Column) -> Column:
        end = F.greatest(acc["end"], s["start"] + s["length"])
        return F.struct((acc["n"] + end - F.greatest(acc["end"], s["start"])).cast("long").alias("n"), end.alias("end"))

    return F.aggregate(spans, F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end")), add, lambda acc: acc["n"])


def benchmark_leaks(docs: DataFrame, items: DataFrame, params: LeakParams = LeakParams(), keep: list[str] | None = None, text: str = "text",
                    item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row per document: row (a struct of its columns ``keep``, all by
    default), n_words, n_hit, spans (start and length in words of every window
    found, sorted) and item_ids (as texts, sorted)."""
    p = params
    by_item = stage(item_windows(items, p, item_id, item_text), "leaks-windows")
    windows = by_item.select("window", "length", "code", "tokens").dropDuplicates(["window"])
    tokens = materialize(windows.select(F.explode("tokens").alias("token")).distinct())
    sizes = sorted({min(p.shingle, r.length) for r in windows.select("length").distinct().collect()})       # ``shingle`` values at most
    none = BitFilter(32, np.zeros(1, np.uint32))
    counts = token_counts(docs, text, bit_filter(tokens.df, "token", tokens.rows) if sizes else none, sizes or [1])
    best = Sized(rarest(windows, counts))
    shapes = [tuple(r) for r in best.df.select(F.least(F.lit(p.shingle), F.col("length")), "length", "place").distinct().collect()]    # width ** 2 at most
    prefixes, ends = (bit_filter(best.df, c, best.rows) for c in ("token", "code"))
    rows = candidate_runs(docs, keep or docs.columns, text, prefixes, ends, sorted(shapes))
    runs = rows.select("key", F.explode("runs").alias("r")).select("key", "r.start", "r.place", "r.window")
    found = stage(attach(runs, best, ["window", "place"]).select("key", "start", "length", "window"), "leaks-found")
    # A document's own runs: as many as it has words, and each window has one length.
    spans = found.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("start", "length"))).alias("spans"))
    names = Sized(by_item.where("item_id IS NOT NULL").select("window", "item_id").join(found.select("window").distinct(), "window", "left_semi"))
    named = (attach(found.select("key", "window").distinct(), names, "window")
             .groupBy("key").agg(F.array_sort(F.collect_set("item_id")).alias("item_ids")))
    hits = materialize(spans.join(named, "key", "left"))
    return attach(rows.select("key", "row", "n_words"), hits, "key", "left").select(
        "row", "n_words", F.coalesce(covered(F.col("spans")), F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("spans", F.array().cast("array<struct<start int, length int>>")).alias("spans"),
        F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"))


def without_leaks(docs: DataFrame, items: DataFrame, params: LeakParams = LeakParams(), text: str = "text") -> DataFrame:
    """The documents, with all their columns, that hold no window of any item."""
    return benchmark_leaks(docs, items, params, text=text).where(F.col("n_hit") == 0).select("row.*")
