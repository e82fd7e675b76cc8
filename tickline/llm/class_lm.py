"""Language-model scores by Brown's class-based bigrams.

A word's probability after another is the probability of its class after the
other's class, times the probability of the word within its class.  Exchange
clustering finds the classes: a unit moves to the class that raises the
likelihood of the training bigrams most, until no move helps.

* Counts of all training words come from Spark; nothing is dropped from them.
* First the ``head`` most frequent words, each for itself, and ``endings``
  buckets of all other words by their last letters are clustered.  Their bigram
  matrix is counted over all training tokens; its size is bounded by
  (head + endings)^2 whatever the corpus, so these passes run in one place.
* Then every other training word starts in its ending's class and moves by the
  same criterion, in batched rounds over Spark.  A table holds a row for each part of
  the words, by hash: packed counts of their neighbours' classes and of the
  neighbours beyond the head themselves.  Every word finds its best class given
  all others; what the moves change in their neighbours' counts goes, packed, to
  the neighbours' parts by shuffle.  All words move in the first round, then one hash
  half after the other.  A round that lowers the likelihood, or leaves it, is taken
  back and tried with half of its words.  Rounds end when a sweep raises the
  likelihood by no more than ``settled`` (nats a token) or when not even a 64th
  of the words raises it; the head words stay.
* A word never seen in training has the class of its ending.
* Counts and classes of the ``lookup`` most frequent words (a bound) are
  broadcast; those of each text's other words are joined by shuffle, so every
  token is scored with its exact count and its own class.

A document's tokens are its words and one end; its first word follows an end.
P(class after class) leans on P(class) with weight ``lean``; P(word in class)
is add-``alpha`` over the class's words and one unknown word.

Defined results: a null or empty text is one end; rows without an id are
learned from and scored; without training rows every count is 0.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pandas.util import hash_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickline.llm.common import discard, settings, stage, words

LONGEST = 64               # bytes up to which a word stands for itself
CHUNK = 12_000_000         # bytes of text that a task takes at once
SPAN = 1 << 18             # unit bigrams whose counts are added up in one place
RARE = 1 << 60             # numbers of words that have no place in the lookup start here
LEVELS = 100_000           # counts from here on are one level of the threshold search


@dataclass(frozen=True)
class LmParams:
    head: int = 1536
    endings: int = 512
    classes: int = 64
    lookup: int = 400_000
    alpha: float = 0.1
    lean: float = 5.0
    settled: float = 1e-3

    @property
    def units(self) -> int:
        """Units besides the end, which has the number ``units``."""
        return self.head + self.endings


def keys(text: str | None) -> list[bytes]:
    """The words of a text; one of more than ``LONGEST`` bytes is a byte that no
    UTF-8 holds, its SHA-256 and its last letters, so every word is short."""
    found = words(text)
    if found and max(map(len, found)) > LONGEST:
        return [w if len(w) <= LONGEST else b"\xff" + hashlib.sha256(w).digest() + w[-3:] for w in found]
    return found


def chunks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Batches joined until their texts, the last column, have ``size`` bytes."""
    held, nbytes = [], 0
    for b in batches:
        b = b.set_column(b.num_columns - 1, "text", b.column(b.num_columns - 1).cast(pa.large_string()))
        held.append(b)
        nbytes += b.column(b.num_columns - 1).nbytes
        if nbytes >= size:
            yield pa.concat_batches(held)
            held, nbytes = [], 0
    if held:
        yield pa.concat_batches(held)


def tokenised(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """The words of ``keys`` for many texts: of each token the place of its word in
    the third result and the place of its text."""
    found = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))       # at exactly the six bytes of the word rule
    coded = found.flatten().dictionary_encode()
    word = coded.indices.to_numpy()
    text = np.repeat(np.arange(len(texts), dtype=np.int32), pc.list_value_length(found).to_numpy())
    empty = pc.index(coded.dictionary, pa.scalar("", pa.large_string())).as_py()     # white space at an end
    if empty >= 0:
        word, text = word[word != empty], text[word != empty]
    distinct = coded.dictionary.cast(pa.large_binary())
    if len(distinct) and pc.max(pc.binary_length(distinct)).as_py() > LONGEST:
        distinct = pa.array([w if len(w) <= LONGEST else keys(w.decode())[0] for w in distinct.to_pylist()], pa.large_binary())
    return word, text, distinct


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, n) over all ``text``; the end has a null word."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ends = 0
        for b in chunks(batches, 2 * CHUNK):
            word, _, distinct = tokenised(b.column(0))
            n = np.bincount(word, minlength=len(distinct))
            yield pa.RecordBatch.from_arrays([distinct.cast(pa.binary()), pa.array(n, pa.int64())], names=["word", "n"])
            ends += b.num_rows
        yield pa.RecordBatch.from_arrays([pa.array([None], pa.binary()), pa.array([ends], pa.int64())], names=["word", "n"])

    return texts.mapInArrow(run, "word binary, n long").where("n > 0").groupBy("word").agg(F.sum("n").alias("n"))


def frequent(counts: DataFrame, most: int) -> list[tuple[bytes, int]]:
    """The most frequent words, as many as ``most`` allows without cutting
    through words of equal count; the most frequent first."""
    short = counts.where(F.col("word").isNotNull())
    levels = sorted(short.groupBy(F.least("n", F.lit(LEVELS)).alias("n")).agg(F.count(F.lit(1)).alias("c")).collect(), reverse=True)     # at most LEVELS rows
    total, least = 0, None
    for n, c in levels:
        if total + c > most:
            break
        total, least = total + c, n
    if least is None:
        return []
    got = short.where(F.col("n") >= least).toPandas()
    return sorted(zip(map(bytes, got.word), map(int, got.n)), key=lambda x: (-x[1], x[0]))


def head_words(counts: DataFrame, most: int) -> list[tuple[bytes, int]]:
    """The ``most`` most frequent words, those of equal count by their bytes."""
    short = counts.where(F.col("word").isNotNull())
    return [(bytes(r.word), r.n) for r in short.orderBy(F.desc("n"), "word").limit(most).collect()]


def ending(word: bytes, p: LmParams) -> int:
    """The unit of a word that is no head word."""
    return p.head + zlib.crc32(word[-3:]) % p.endings


def word_numbers(found: list[bytes], seed: int) -> np.ndarray:
    """Numbers from ``RARE`` on for words that have no place in the lookup."""
    if not found:
        return np.empty(0, np.int64)
    return (hash_array(np.array(found, object), hash_key=f"{seed:016d}", categorize=False) >> np.uint64(4)).astype(np.int64) | RARE


class Lookup:
    """Frequent words with unit and count (what the executors get)."""

    def __init__(self, top: list[tuple[bytes, int]], p: LmParams):
        self.p = p
        self.at = {w: k for k, (w, _) in enumerate(top)}
        self.counts = np.array([n for _, n in top] + [0], np.int64)
        self.head = min(p.head, len(top))
        # Words beyond the head have units of their own after the end's.
        self.unit = np.array([k if k < p.head else p.units + 1 + k - p.head for k in range(len(top))] + [0], np.int32)
        self.bucket = np.array([*range(p.units + 1), *(ending(w, p) for w, _ in top[p.head:])], np.int32)

    def found(self, distinct: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
        """``places`` of the words of an Arrow array, with the places in it of those
        that are not there, and these words."""
        miss, tokens = len(self.at), distinct.to_pylist()
        at = np.fromiter(map(self.at.get, tokens, repeat(miss)), np.int64, len(tokens))
        units, rare = self.unit[at], np.flatnonzero(at == miss)
        last = pc.binary_slice(distinct.take(pa.array(rare)), -3).dictionary_encode()
        units[rare] = np.array([ending(w, self.p) for w in last.dictionary.to_pylist()], np.int32)[last.indices.to_numpy()]
        return at, units, rare, [tokens[k] for k in rare]

    def places(self, tokens: list[bytes]) -> tuple[np.ndarray, np.ndarray, list[tuple[int, bytes]]]:
        """Place in the lookup of each token (the last place if it is not
        there), its unit, and the tokens that are not there."""
        miss = len(self.at)
        at = np.fromiter(map(self.at.get, tokens, repeat(miss)), np.int64, len(tokens))
        units = self.unit[at]
        rare = [(int(k), tokens[k]) for k in np.flatnonzero(at == miss)]
        for k, w in rare:
            units[k] = ending(w, self.p)
        return at, units, rare


def between(of: np.ndarray, text: np.ndarray, texts: int, end: int) -> np.ndarray:
    """One row of all texts' tokens ``of`` with ``end`` before the first text and after each."""
    out = np.full(len(of) + texts + 1, end, of.dtype)
    out[np.arange(len(of)) + text + 1] = of
    return out


def unit_bigrams(texts: DataFrame, lookup, p: LmParams) -> np.ndarray:
    """Matrix of unit bigrams over all ``text``, ends included."""
    size = p.units + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        look, total = lookup.value, np.zeros(size * size, np.int64)
        for b in chunks(batches, CHUNK):
            word, text, distinct = tokenised(b.column(0))
            seq = between(look.bucket[look.found(distinct)[1]][word], text, b.num_rows, p.units).astype(np.int64)
            total += np.bincount(seq[:-1] * size + seq[1:], minlength=size * size)
        at = np.flatnonzero(total)
        cuts = np.searchsorted(at, np.arange(spans + 1) * SPAN)
        for k in np.flatnonzero(np.diff(cuts)):
            part = at[cuts[k]:cuts[k + 1]]
            yield rows(int(k), part - k * SPAN, total[part])

    def rows(span: int, code: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([span], pa.int32()), pa.array([pack(code, 3)], pa.binary()), pa.array([pack(n, 1)], pa.binary())], names=["span", "code", "n"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = {}
        for b in batches:
            for span, code, n in zip(b.column("span").to_pylist(), b.column("code"), b.column("n")):
                total.setdefault(span, np.zeros(SPAN, np.int64))[unpack(code.as_buffer(), 3)] += unpack(n.as_buffer(), 1)
        for span, n in total.items():
            at = np.flatnonzero(n)
            yield rows(span, at, n[at])

    spans, packed = -(-size * size // SPAN), "span int, code binary, n binary"
    out = np.zeros(spans * SPAN)
    for r in texts.mapInArrow(run, packed).repartitionById(spans, F.col("span")).mapInArrow(add, packed).collect():     # at most size^2 counts
        out[r.span * SPAN + unpack(r.code, 3)] = unpack(r.n, 1)
    return out[:size * size].reshape(size, size)


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


def exchange(big: np.ndarray, p: LmParams) -> np.ndarray:
    """Class of every unit by exchange clustering; the end keeps a class of
    its own, the last."""
    size, c = len(big), p.classes + 1
    use = big.sum(axis=1) + big.sum(axis=0)
    order = [u for u in np.argsort(-use[:-1], kind="stable") if use[u] > 0]
    cls = np.zeros(size, int)
    cls[order] = np.arange(len(order)) % p.classes
    cls[-1] = p.classes
    hot = np.eye(c)[cls]
    after, before = big @ hot, big.T @ hot          # unit x class: counts of the classes that follow, that precede
    g = hot.T @ after                               # class x class
    least = 1e-12 * _xlogx(g.sum())                 # more than rounding, so every move raises the likelihood and the passes end
    moves = 1
    while moves:
        moves = 0
        for u in order:
            a, s = cls[u], big[u, u]
            r, q = after[u].copy(), before[u].copy()
            nr, nq = r.sum(), q.sum()
            rest = g.copy()
            rest[a] -= r
            rest[:, a] -= q
            rest[a, a] += s
            r[a] -= s
            q[a] -= s
            f = _xlogx(rest)
            by_row = _xlogx(rest + r) - f            # row b gets r: entry (b, c)
            by_col = _xlogx(rest + q[:, None]) - f   # column b gets q: entry (c, b)
            d = np.diag(rest)
            gain = (by_row.sum(axis=1) - np.diag(by_row) + by_col.sum(axis=0) - np.diag(by_col)
                    + _xlogx(d + r + q + s) - _xlogx(d))
            out, into = rest.sum(axis=1), rest.sum(axis=0)
            out, into = out + q, into + r           # all tokens of each class but the unit's
            gain -= _xlogx(out + nr) - _xlogx(out) + _xlogx(into + nq) - _xlogx(into)
            b = int(gain[:p.classes].argmax())
            if b != a and gain[b] > gain[a] + 1e-9 * abs(gain[a]) + least:
                g = rest
                g[b] += r
                g[:, b] += q
                g[b, b] += s
                after[:, a] -= big[:, u]
                after[:, b] += big[:, u]
                before[:, a] -= big[u]
                before[:, b] += big[u]
                cls[u] = b
                moves += 1
    return cls


@dataclass
class ClassModel:
    """What scoring needs; all of bounded size."""
    params: LmParams
    cls: np.ndarray            # class of each unit
    trans: np.ndarray          # log10 P(class after class)
    norm: np.ndarray           # of each class: words' mass + alpha * (types + 1)
    tokens: int                # N
    types: int                 # V
    ends: int


def likelihood(g: np.ndarray) -> float:
    """Log likelihood of the class bigrams ``g``, but for the words' own share."""
    return float(_xlogx(g).sum() - _xlogx(g.sum(axis=0)).sum() - _xlogx(g.sum(axis=1)).sum())


def pack(x: np.ndarray, width: int) -> bytes:
    """Numbers from 0 on in ``width`` bytes each, equal places together; larger ones follow in 8."""
    top = (1 << 8 * width) - 1
    low = np.minimum(x, top).astype("<i8")
    return len(x).to_bytes(8, "little") + low.view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes() + np.asarray(x, "<i8")[low == top].tobytes()


def unpack(packed, width: int) -> np.ndarray:
    size, top = int.from_bytes(packed[:8], "little"), (1 << 8 * width) - 1
    out = np.zeros((size, 8), np.uint8)
    out[:, :width] = np.frombuffer(packed, np.uint8, size * width, 8).reshape(width, size).T
    out = out.view("<i8").ravel()
    out[out == top] = np.frombuffer(packed, "<i8", -1, 8 + size * width)
    return out


def part_of(number: np.ndarray, parts: int) -> np.ndarray:
    return ((number.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)) >> np.uint64(33)).astype(np.int64) % parts


#: A row for each part of the words, by hash: sorted word numbers, their classes, how many
#: contexts each has, the contexts' codes and counts, how many links, their other words
#: (times 2, plus 1 if the other word precedes) and counts; with packed bytes a number.
STATE = {"word": 3, "cls": 1, "size": 1, "code": 1, "n": 1, "reach": 1, "far": 3, "times": 1}
#: Rows for a part: its state as it was; counts, links or classes of some of its words.
OLD, ADDED, LINKS, MOVED, CLASSES = range(5)
WIDTHS = {ADDED: (3, 1, 1), LINKS: (3, 3, 1), MOVED: (3, 2, 1), CLASSES: (3, 1, 1)}
ROWS = f"part int, kind int, {', '.join(f'{f} binary' for f in STATE)}"
WORDS = {"spark.sql.execution.arrow.maxRecordsPerBatch": "100000"}    # words alone are short
NARROW = {"spark.sql.execution.arrow.maxRecordsPerBatch": "64"}      # packed rows are long


def _batch(part: int, kind: int, fields: dict[str, bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([kind], pa.int32()), *(pa.array([fields.get(f)], pa.binary()) for f in STATE)],
                                      names=["part", "kind", *STATE])


def _sent(kind: int, parts: int, word: np.ndarray, code: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
    """A row of ``kind`` for each part that has some of the words."""
    part = part_of(word, parts)
    order = np.argsort(part, kind="stable")
    cuts = np.searchsorted(part[order], np.arange(parts + 1))
    for k in np.flatnonzero(np.diff(cuts)):
        at = order[cuts[k]:cuts[k + 1]]
        yield _batch(int(k), kind, {f: pack(x[at], w) for f, x, w in zip(("word", "code", "n"), (word, code, n), WIDTHS[kind])})


def neighbours(texts: DataFrame, lookup, cls: np.ndarray, seed: int, parts: int, p: LmParams) -> DataFrame:
    """Packed rows for the parts over all ``text``, of words beyond the head by number.
    ``LINKS``: a word beyond the head too that follows or precedes the word.
    ``ADDED``, a code of the first classes: one that follows; from classes + 1 on, one of a
    head word or end that precedes; from twice that on, of another word that precedes;
    from three times that on, the word after itself."""
    c = p.classes + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        look = lookup.value
        first = len(look.at)
        for b in chunks(batches, CHUNK):
            of, text, distinct = tokenised(b.column(0))
            at, units, rare, missed = look.found(distinct)
            number = np.concatenate((np.arange(first), word_numbers(missed, seed)))
            at[rare] = np.arange(first, len(number))           # from here on, places in ``number``
            klass = between(cls[look.bucket[units]][of], text, b.num_rows, p.classes)
            at = between(at[of], text, b.num_rows, -1)
            tail = at >= look.head
            here = np.flatnonzero(tail)
            word = at[here] * (3 * c + 1)
            both = tail[:-1] & tail[1:]
            a, z = at[:-1][both], at[1:][both]
            code, n = np.unique(np.concatenate((word + klass[here + 1], word + klass[here - 1] + np.where(tail[here - 1], 2 * c, c), a[a == z] * (3 * c + 1) + 3 * c)), return_counts=True)
            word, code = np.divmod(code, 3 * c + 1)
            yield from _sent(ADDED, parts, number[word], code, n)
            code, n = np.unique((a << 32) | z, return_counts=True)
            a, z = number[code >> 32], number[code & 0xFFFFFFFF]
            yield from _sent(LINKS, parts, np.concatenate((a, z)), np.concatenate((z * 2, a * 2 + 1)), np.concatenate((n, n)))

    return texts.mapInArrow(run, ROWS)


TABLED = 32                # counts up to here have their terms in a table


def _steps(x: np.ndarray) -> np.ndarray:
    """f(x + m) - f(x) of x log x for m from 0 to ``TABLED``, m first."""
    m = np.arange(TABLED + 1.0).reshape(-1, *([1] * x.ndim))
    return _xlogx(x + m) - _xlogx(x)


class _Steps:
    """Tables of steps by the class bigrams ``g``, for classes under ``k``."""

    def __init__(self, g: np.ndarray, k: int):
        self.cells = []
        for grid in (g, g.T):
            table = _steps(grid[:k].T)                         # m, c, b
            table[:, np.arange(k), np.arange(k)] = 0.0
            self.cells.append(table)
        self.totals = [_steps(g.sum(axis=1)[:k]), _steps(g.sum(axis=0)[:k])]


FEW = 1                    # counts up to here are added up for all words at once


def best_classes(r0: np.ndarray, q0: np.ndarray, s: np.ndarray, a: np.ndarray, g: np.ndarray, k: int, steps: _Steps | None = None) -> np.ndarray:
    """The best class under ``k`` of every word, all others staying: ``r0`` and
    ``q0`` (words x classes) count what follows and precedes, ``s`` the word
    after itself, ``a`` is the class it has.  The sums are those of ``exchange``;
    steps by small counts are looked up, and only those that the word's own leaving
    changes are worked out."""
    steps = steps or _Steps(g, k)
    i = np.arange(len(a))
    r, q = r0.copy(), q0.copy()
    r[i, a] -= s
    q[i, a] -= s
    gain, staying = np.zeros((len(a), k)), np.zeros(len(a))
    # Row b gets r and column b gets q; only what a word meets changes a cell.
    for grid, table, x, y0 in ((g, steps.cells[0], r, q0), (g.T, steps.cells[1], q, r0)):
        w, c = np.divmod(np.flatnonzero((x != 0).ravel()), x.shape[1])
        n = x[w, c]
        own = c == a[w]
        plain = x.copy()
        plain[i, a] = 0.0
        for m in range(1, FEW + 1):
            at = np.flatnonzero(np.bincount(w[(n == m) & ~own], minlength=len(a)))
            if len(at):
                gain[at] += (plain[at] == m).astype(float) @ table[m]
        more = np.flatnonzero(own | (n > FEW))
        whole = more[own[more] | (n[more] > TABLED)]           # a cell that the word leaves, or a count beyond the table
        looked = more[~own[more] & (n[more] <= TABLED)]
        term = np.empty((len(more), k))
        if len(more):
            at = np.flatnonzero(own[more] | (n[more] > TABLED))
            rest = grid[:k, c[whole]].T - np.where(own[whole][:, None], y0[w[whole], :k], 0.0)
            rest = np.maximum(rest, 0)
            cell = _xlogx(rest + n[whole, None]) - _xlogx(rest)
            inner = np.flatnonzero(c[whole] < k)
            cell[inner, c[whole[inner]]] = 0.0
            term[at] = cell
            term[np.flatnonzero(~own[more] & (n[more] <= TABLED))] = table[n[looked].astype(int), c[looked]]
            starts = np.flatnonzero(np.append(True, w[more][1:] != w[more][:-1]))
            gain[w[more[starts]]] += np.add.reduceat(term, starts, axis=0)
        rest = np.maximum(grid[a[w], c] - n - np.where(own, y0[w, a[w]], 0.0), 0)      # staying: the word's own counts are out first
        staying += np.bincount(w, weights=np.where(own, 0.0, _xlogx(rest + n) - _xlogx(rest)), minlength=len(a))
    gain[i, a] = staying
    diag, m = np.diag(g)[:k], r[:, :k] + q[:, :k] + s[:, None]
    w, c = np.divmod(np.flatnonzero((m != 0).ravel()), k)
    n, own = m[w, c], c == a[w]
    d = np.where(own, diag[c] - (r0[w, a[w]] + q0[w, a[w]] - s[w]), diag[c])
    gain[w, c] += _xlogx(d + n) - _xlogx(d)
    for total, table, n in ((g.sum(axis=1)[:k], steps.totals[0], r0.sum(axis=1)), (g.sum(axis=0)[:k], steps.totals[1], q0.sum(axis=1))):
        rise = table[np.minimum(n, TABLED).astype(int)]
        large = np.flatnonzero(n > TABLED)
        rise[large] = _xlogx(total + n[large, None]) - _xlogx(total)
        rise[i, a] = _xlogx(total[a]) - _xlogx(total[a] - n)
        gain -= rise
    best = gain.argmax(axis=1)
    return np.where(gain[i, best] > gain[i, a] + 1e-9 * np.abs(gain[i, a]), best, a)


CLEAN = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}      # shuffle files go with their jobs
BLOCK = 1024               # words whose classes are worked out at once
PART_WORDS = 100_000       # words of one part, on average


def _unpacked(b: pa.RecordBatch, row: int, fields=tuple(STATE)) -> dict[str, np.ndarray]:
    return {f: unpack(b.column(f)[row].as_buffer(), STATE[f]) for f in fields}


def _sums(key: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and the sums of their numbers, but for sums of 0."""
    order = np.argsort(key, kind="stable")
    key, n = key[order], n[order]
    if len(key):
        first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        key, n = key[first], np.add.reduceat(n, first)
    return key[n != 0], n[n != 0]


def _joined(old: dict | None, rows: list[tuple[int, tuple[np.ndarray, np.ndarray, np.ndarray]]], c: int) -> dict[str, np.ndarray]:
    """A part's state with its rows (kind, (word, code, n)) worked in."""
    of = {k: [np.concatenate(x) for x in zip(*(r for kind, r in rows if kind == k))] or [np.empty(0, np.int64)] * 3 for k in WIDTHS}
    wide = 3 * c + 1
    o = old
    if o is None:
        word, klass, _ = of[CLASSES]
        order = np.argsort(word)
        o = {"word": word[order], "cls": klass[order], "size": np.zeros(len(word), np.int64), "reach": np.zeros(len(word), np.int64)} | {f: np.empty(0, np.int64) for f in ("code", "n", "far", "times")}
    places = np.arange(len(o["word"]))
    at = {k: np.searchsorted(o["word"], of[k][0]) for k in (ADDED, LINKS, MOVED)}
    if len(at[ADDED]) or len(at[MOVED]):
        was, to = np.divmod(of[MOVED][1], wide)
        more, m = _sums(np.concatenate((at[ADDED] * wide + of[ADDED][1], at[MOVED] * wide + was, at[MOVED] * wide + to)), np.concatenate((of[ADDED][2], -of[MOVED][2], of[MOVED][2])))
        key = np.repeat(places * wide, o["size"]) + o["code"]
        to = np.searchsorted(key, more)
        had = np.append(key, -1)[to] == more
        n = o["n"].copy()
        n[to[had]] += m[had]
        left = n != 0
        new, size = to[~had], np.bincount(more[~had] // wide, minlength=len(places)) - np.bincount(key[~left] // wide, minlength=len(places))
        left = np.insert(left, new, True)
        o = o | {"size": o["size"] + size, "code": np.insert(o["code"], new, more[~had] % wide)[left], "n": np.insert(n, new, m[~had])[left]}
    if len(at[LINKS]):                                         # all come with the first rows
        order = np.lexsort((of[LINKS][1], at[LINKS]))
        word, far, n = at[LINKS][order], of[LINKS][1][order], of[LINKS][2][order]
        first = np.flatnonzero(np.append(True, (word[1:] != word[:-1]) | (far[1:] != far[:-1])))
        o = o | {"reach": np.bincount(word[first], minlength=len(places)), "far": far[first], "times": np.add.reduceat(n, first)}
    return o


def _states(rows: DataFrame, parts: int, c: int) -> DataFrame:
    """A state for each part, from its ``rows``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        old, kept, added = {}, {}, {}
        for b in batches:
            for k, (part, kind) in enumerate(zip(b.column("part").to_pylist(), b.column("kind").to_pylist())):
                if kind == OLD:
                    kept[part] = {f: b.column(f)[k].as_py() for f in ("word", "cls", "reach", "far", "times")}
                    old[part] = _unpacked(b, k, ("word", "size", "code", "n"))
                else:
                    added.setdefault(part, []).append((kind, tuple(unpack(b.column(f)[k].as_buffer(), w) for f, w in zip(("word", "code", "n"), WIDTHS[kind]))))
        for part in sorted({*old, *added}):
            o = _joined(old.pop(part, None), added.pop(part, []), c)
            same = kept.pop(part, {})
            yield _batch(part, OLD, same | {f: pack(o[f], w) for f, w in STATE.items() if f not in same})

    return stage(rows.repartitionById(parts, F.col("part")).mapInArrow(run, ROWS), "lm-states")


def _class_bigrams(states: DataFrame, c: int) -> np.ndarray:
    """Class bigrams that hold a word beyond the head."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g, wide = np.zeros((c, c)), 3 * c + 1
        for b in batches:
            for row in range(b.num_rows):
                x = _unpacked(b, row, ("cls", "size", "code", "n"))
                n = np.bincount(np.repeat(x["cls"], x["size"]) * wide + x["code"], weights=x["n"], minlength=c * wide).reshape(c, wide)
                g += n[:, :c] + n[:, c:2 * c].T
        at = np.flatnonzero(g)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(g.ravel()[at].astype(np.int64), pa.int64())], names=["code", "n"])

    g = np.zeros(c * c)
    for r in states.select("cls", "size", "code", "n").mapInArrow(run, "code long, n long").groupBy("code").agg(F.sum("n").alias("n")).collect():     # at most c^2 rows
        g[r.code] = r.n
    return g.reshape(c, c)


def _ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of each range, one after the other."""
    return np.arange(size.sum()) + np.repeat(start - (np.cumsum(size) - size), size)


def _best(x: dict[str, np.ndarray], picked: np.ndarray, g: np.ndarray, c: int) -> np.ndarray:
    """The best class of the ``picked`` words of a part.  Of words that occur once and
    have the same class and context, one is worked out for all."""
    start = np.cumsum(x["size"]) - x["size"]
    size, cls = x["size"][picked], x["cls"][picked]
    once = np.flatnonzero(size == 2)
    code, n = x["code"], x["n"]
    a, z = start[picked[once]], start[picked[once]] + 1
    single = (n[a] == 1) & (n[z] == 1) & (code[a] < c) & (code[z] >= c) & (code[z] < 3 * c)
    once, a, z = once[single], a[single], z[single]
    _, first, same = np.unique((cls[once] * c + code[a]) * c + code[z] % c, return_index=True, return_inverse=True)
    rest = np.ones(len(picked), bool)
    rest[once] = False
    work = np.concatenate((np.flatnonzero(rest), once[first]))
    best, steps = cls.copy(), _Steps(g, c - 1)
    for k in range(0, len(work), BLOCK):
        at = work[k:k + BLOCK]
        of, cell = np.repeat(np.arange(len(at)), size[at]), _ranges(start[picked[at]], size[at])
        out = np.zeros((len(at), 3 * c + 1))
        out[of, code[cell]] = n[cell]
        best[at] = best_classes(out[:, :c], out[:, c:2 * c] + out[:, 2 * c:3 * c], out[:, 3 * c], cls[at], g, c - 1, steps)
    best[once] = best[once[first]][same]
    return best


def _moved(states: DataFrame, g: np.ndarray, parts: int, c: int, share: int, turn: int) -> DataFrame:
    """Rows for the next states: every state with the classes of the moved words of one
    of ``share`` hash groups, and what the moves change in their neighbours' contexts."""
    wide = 3 * c + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in range(b.num_rows):
                x = _unpacked(b, row, [f for f in STATE if f != "far"])
                mixed = (x["word"].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)
                picked = np.flatnonzero(mixed % np.uint64(share) == turn % share)
                to = _best(x, picked, g, c)
                go = to != x["cls"][picked]
                word, to = picked[go], to[go]
                size = x["reach"][word]
                cell = _ranges((np.cumsum(x["reach"]) - x["reach"])[word], size)
                far = unpack(b.column("far")[row].as_buffer(), STATE["far"])[cell]
                base = np.where(far & 1, 0, 2 * c)  # a word that precedes gets what follows it, and the other way round
                code = (np.repeat(x["cls"][word], size) + base) * wide + np.repeat(to, size) + base
                yield from _sent(MOVED, parts, far >> 1, code, x["times"][cell])
                x["cls"][word] = to
                same = {f: b.column(f)[row].as_py() for f in STATE if f != "cls"}
                yield _batch(b.column("part")[row].as_py(), OLD, same | {"cls": pack(x["cls"], STATE["cls"])})

    return states.mapInArrow(run, ROWS)


def exchange_rest(met: DataFrame, start: DataFrame, parts: int, heads: np.ndarray, p: LmParams) -> tuple[DataFrame, np.ndarray]:
    """(word, cls) of every word beyond the head from its class in ``start``, and
    the class bigrams of all tokens; ``met`` are the words' neighbours, ``heads``
    the class bigrams of heads and ends."""
    spark, c = met.sparkSession, p.classes + 1

    def begun(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            word, klass = (b.column(f).to_numpy().astype(np.int64) for f in ("word", "cls"))
            yield from _sent(CLASSES, parts, word, klass, np.zeros(len(word), np.int64))

    with settings(spark, WORDS):
        begin = stage(start.mapInArrow(begun, ROWS), "lm-begin")
    with settings(spark, NARROW):
        states = _states(met.union(begin), parts, c)
        discard(begin)
        g = heads + _class_bigrams(states, c)
        value, share, turn, gains = likelihood(g), 1, 0, []
        while True:
            new = _states(_moved(states, g, parts, c, share, turn), parts, c)
            after = heads + _class_bigrams(new, c)
            gain = likelihood(after) - value
            if np.array_equal(g, after):                       # no move
                discard(new)
                gain = 0.0
            elif gain <= 1e-12 * _xlogx(after.sum()):          # no more than rounding: taken back
                discard(new)
                if share == 64:
                    break
                share *= 2
                continue
            else:
                discard(states)
                states, g, value = new, after, value + gain
            gains.append(gain)
            if len(gains) > 2 and sum(gains[-share:]) <= p.settled * g.sum():
                break
            share, turn = max(2, share // 2), turn + 1

    def classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in range(b.num_rows):
                x = _unpacked(b, row, ("word", "cls"))
                for k in range(0, len(x["word"]), 50_000):
                    yield pa.RecordBatch.from_arrays([pa.array(x["word"][k:k + 50_000]), pa.array(x["cls"][k:k + 50_000], pa.int32())], names=["word", "cls"])

    return states.select("word", "cls").mapInArrow(classes, "word long, cls int"), g


def first_classes(counts: DataFrame, lookup, cls: np.ndarray, seed: int, p: LmParams) -> DataFrame:
    """(word, n, cls, id): the class of each head word and end, of every other
    word its ending's, and that word's number (null for heads and ends)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        look = lookup.value
        for b in batches:
            words_ = b.column(0).cast(pa.large_binary())
            ends = words_.is_null().to_numpy(zero_copy_only=False)
            words_ = pc.fill_null(words_, b"")
            at, units, rare, missed = look.found(words_)
            units = np.where(ends, p.units, look.bucket[units])
            at[rare] = word_numbers(missed, seed)
            heads = ends | (at < look.head)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(cls[units], pa.int32()), pa.array(at, pa.int64(), mask=heads)], names=["word", "n", "cls", "id"])

    with settings(counts.sparkSession, WORDS):
        return stage(counts.mapInArrow(run, "word binary, n long, cls int, id long"), "lm-first")


def fit(train: DataFrame, text: str = "text", params: LmParams = LmParams()):
    """(model, lookup broadcast, table of words with counts and classes) learned
    from all rows of ``train``."""
    with settings(train.sparkSession, CLEAN):
        return _fit(train, text, params)


def _fit(train: DataFrame, text: str, p: LmParams):
    texts = train.select(F.col(text).cast("string").alias("text"))
    counts = stage(word_counts(texts), "word-counts")
    heads, top = head_words(counts, p.head), frequent(counts, p.lookup)
    top = top if len(top) > len(heads) else heads
    look = Lookup(top, p)
    lookup = train.sparkSession.sparkContext.broadcast(look)
    big = unit_bigrams(texts, lookup, p)
    cls = exchange(big, p)
    known = np.r_[:p.head, p.units]
    hot = np.eye(p.classes + 1)[cls[known]]
    seed = 0
    first = first_classes(counts, lookup, cls, seed, p)
    while not first.where(F.col("id") >= RARE).groupBy("id").count().where("count > 1").isEmpty():     # no two words share a number
        seed += 1
        first = first_classes(counts, lookup, cls, seed, p)
    start = first.where("id is not null").select(F.col("id").alias("word"), "cls")
    parts = max(8, start.count() // PART_WORDS)
    rest, g = exchange_rest(neighbours(texts, lookup, cls, seed, parts, p), start, parts, hot.T @ big[np.ix_(known, known)] @ hot, p)
    rest = rest.select(F.col("word").alias("id"), F.col("cls").alias("own"))
    table = stage(first.join(rest, "id", "left").select("word", "n", F.coalesce("own", "cls").alias("cls")), "lm-words")
    discard(first)
    mass, types = np.zeros(p.classes + 1), np.zeros(p.classes + 1)
    for r in table.groupBy("cls").agg(F.sum("n").alias("mass"), F.count(F.lit(1)).alias("types")).collect():     # at most one row a class
        mass[r.cls], types[r.cls] = r.mass, r.types
    cls = np.concatenate((cls, np.zeros(len(look.bucket) - len(cls), int)))
    if len(cls) > p.units + 1:
        got = table.where(F.col("word").isNotNull() & (F.col("n") >= int(look.counts[:-1].min()))).select("word", "cls").toPandas()     # the words of the lookup
        units = np.concatenate([look.places([bytes(w) for w in got.word])[1], np.empty(0, np.int32)]).astype(int)
        use = units > p.units
        cls[units[use]] = got.cls.to_numpy()[use]
    plain = (mass + p.alpha) / (mass + p.alpha).sum()
    trans = np.log10((g + p.lean * plain) / (g.sum(axis=1, keepdims=True) + p.lean))
    norm = mass + p.alpha * (types + 1)
    norm[-1] = mass[-1] + p.alpha                   # the end's class holds nothing else
    ends = counts.where("word is null").first()
    return ClassModel(p, cls, trans, norm, int(mass.sum()), int(types.sum()), int(ends.n) if ends else 0), lookup, table


def score(df: DataFrame, fitted, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score and score for every
    row: log10 probability of the whole text by unigrams and by classes."""
    model, lookup, table = fitted
    p = model.params
    spark = df.sparkSession
    shared = spark.sparkContext.broadcast(model)
    base_norm = model.tokens + 0.1 * (model.types + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        m, look = shared.value, lookup.value
        cls, miss, row = m.cls, len(look.at), TaskContext.get().partitionId() << 40
        base_of = np.log10((look.counts + 0.1) / base_norm)
        emit_of = np.log10((look.counts + p.alpha) / m.norm[cls[look.unit]])
        base_of[miss] = emit_of[miss] = 0.0        # rare words follow by the join
        names = ["row", "doc_id", "n_tokens", "n_known", "base", "own", "word", "k", "unseen", "before", "after"]
        base_end = np.log10((m.ends + 0.1) / base_norm)
        for b in chunks(batches, CHUNK):
            of, text, distinct = tokenised(b.column(1))
            at, units, *_ = look.found(distinct)
            size, klass = b.num_rows, cls[units]
            c = between(klass[of], text, size, p.classes)
            known = between((at != miss)[of], text, size, True)
            ends = np.flatnonzero(between(np.zeros(len(of), bool), text, size, True))
            steps = np.where(known[:-1] & known[1:], m.trans[c[:-1], c[1:]], 0.0)
            added = lambda x: np.bincount(text, weights=x, minlength=size)      # noqa: E731
            tokens, missed = (np.bincount(x, minlength=size) for x in (text, text[at[of] == miss]))
            own = np.add.reduceat(steps, ends[:-1]) + added(emit_of[at][of])
            base = added(base_of[at][of]) + base_end
            yield pa.RecordBatch.from_arrays([
                pa.array(np.arange(row, row + size)), b.column(0), pa.array(tokens + 1), pa.array(tokens - missed + (m.ends > 0)), pa.array(base), pa.array(own),
                *(pa.nulls(size, kind) for kind in (pa.binary(), pa.int64(), pa.int32(), pa.int32(), pa.int32()))], names=names)
            rare = np.flatnonzero(at[of] == miss)
            here = rare + text[rare] + 1               # places in ``c`` and ``known``
            for k in range(0, len(rare), 20_000):
                x, z = rare[k:k + 20_000], here[k:k + 20_000]
                yield pa.RecordBatch.from_arrays([
                    pa.array(row + text[x].astype(np.int64)), *(pa.nulls(len(x), kind) for kind in (pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64())),
                    distinct.take(pa.array(of[x])).cast(pa.binary()), pa.array(x.astype(np.int64)), pa.array(klass[of[x]], pa.int32()),
                    pa.array(c[z - 1], pa.int32(), mask=~known[z - 1]), pa.array(c[z + 1], pa.int32(), mask=~known[z + 1])], names=names)
            row += size

    both = stage(df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
                   .mapInArrow(run, "row long, doc_id long, n_tokens long, n_known long, base double, own double, word binary, k long, unseen int, before int, after int"), "lm-parts")
    n = F.coalesce("n", F.lit(0))
    rare = (both.where("word is not null").select("row", "word", "k", "unseen", "before", "after").join(table.where("word is not null"), "word", "left")
                .select("row", "k", n.alias("n"), F.coalesce("cls", "unseen").alias("cls"), "before", "after"))
    # One document's rare words in a row: a rare word's class comes with the join, so the steps to and from it follow here.
    rare = rare.withColumn("before", F.coalesce("before", F.lag("cls").over(Window.partitionBy("row").orderBy("k"))))
    c = range(p.classes + 1)
    trans = F.broadcast(spark.createDataFrame([(a, b, float(model.trans[a, b])) for a in c for b in c], "a int, b int, lp double"))
    norms = F.broadcast(spark.createDataFrame([(a, float(model.norm[a])) for a in c], "cls int, norm double"))
    rare = (rare.join(norms, "cls").join(trans.select(F.col("a").alias("before"), F.col("b").alias("cls"), F.col("lp").alias("into")), ["before", "cls"])
                .join(trans.select(F.col("a").alias("cls"), F.col("b").alias("after"), F.col("lp").alias("out")), ["cls", "after"], "left"))
    rest = rare.groupBy("row").agg(F.count_if(F.col("n") > 0).alias("rare_known"),
                                   F.sum(F.log10((F.col("n") + 0.1) / F.lit(base_norm))).alias("rare_base"),
                                   F.sum(F.log10((F.col("n") + p.alpha) / F.col("norm")) + F.col("into") + F.coalesce("out", F.lit(0.0))).alias("rare_own"))
    return (both.where("word is null").select("row", "doc_id", "n_tokens", "n_known", "base", "own").join(rest, "row", "left")
                .select("doc_id", "n_tokens", (F.col("n_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"), F.lit(model.tokens).cast("long").alias("train_tokens"),
                        (F.col("base") + F.coalesce("rare_base", F.lit(0.0))).alias("base_score"), (F.col("own") + F.coalesce("rare_own", F.lit(0.0))).alias("score")))
