"""Byte-level BPE encoding and decoding by prefix dynamic programming.

For byte-level BPE the encoding of a prefix of a piece ends in one certain
token.  ``PrefixTable`` stores that token for every prefix length: among the
vocabulary tokens that end at a position, exactly one continues the encoding
of the shorter prefix without a merge across the joint.  So

* encoding is one pass over the bytes, then a walk back from the end,
* appending bytes only extends the table (``append``),
* after an edit only the positions near it are recomputed (``replace``): once
  as many positions in a row as the longest token has bytes agree with the old
  table, all later ones do.

Texts are first cut into pieces by a pattern; ``EncodedText`` keeps the pieces
of one text and re-cuts only around appends and edits.  A piece that is itself
a vocabulary entry is that one token, as in the public rank-file encoders.

Defined results: a null or empty text has no tokens and decodes to no bytes;
repeated rows are encoded each; other columns are left alone.
"""

from __future__ import annotations

import base64
import hashlib
import sys
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PAIR_MEMO = 500_000      # remembered pair verdicts per worker; emptied when full
PIECE_MEMO = 250_000       # remembered pieces per worker, in each of two generations
PIECE_MEMO_CHARS = 64      # longer pieces are not remembered
START, UNSET = -1, -2      # in place of a token: the start of a piece; none known
NATIVE = sys.byteorder == "little" and array("I").itemsize == 4


def parse_ranks(data: bytes) -> dict[bytes, int]:
    """A rank file: one base64 token and its rank a line."""
    out = {}
    for line in data.splitlines():
        if line.strip():
            token, rank = line.split()
            out[base64.b64decode(token)] = int(rank)
    return out


class Vocabulary:
    """Ranks, the tokens' bytes, and the test whether two tokens may stand
    next to each other in an encoding."""

    def __init__(self, ranks: dict[bytes, int], memo: float = 1.0):
        self.most_pairs = int(PAIR_MEMO * memo)
        import ahocorasick
        self.ranks = ranks
        self.bytes_of = {r: t for t, r in ranks.items()}
        self.longest = max(map(len, ranks), default=1)
        self.suffixes = ahocorasick.Automaton()
        for token, rank in ranks.items():
            # The automaton works on characters: one Latin-1 character a byte.
            self.suffixes.add_word(token.decode("latin-1"), (len(token), rank))
        self.suffixes.make_automaton()
        self._events: dict[int, tuple | None] = {}
        self.pairs: dict[int, bool] = {}

    def merge(self, data: bytes) -> tuple[list[bytes], list[tuple[int, bytes, bytes]]]:
        """Plain merging (lowest rank first, then leftmost): the final parts,
        and after each merge (its rank, the first part, the last part)."""
        parts = [data[i:i + 1] for i in range(len(data))]
        events = []
        ranks = self.ranks
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                r = ranks.get(parts[i] + parts[i + 1])
                if r is not None and (best is None or r < best):
                    best, at = r, i
            if best is None:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
            events.append((best, parts[0], parts[-1]))
        return parts, events

    def _history(self, token: int) -> tuple | None:
        """The merges that build a token from its bytes; None if plain
        merging of its bytes does not end in it."""
        got = self._events.get(token, 0)
        if got == 0:
            data = self.bytes_of[token]
            parts, events = self.merge(data)
            got = None if len(parts) != 1 else (
                [e[0] for e in events],
                [data[:1], *(e[1] for e in events)],      # first part after k merges
                [data[-1:], *(e[2] for e in events)])     # last part after k merges
            self._events[token] = got
        return got

    def reachable(self, token: int) -> bool:
        return self._history(token) is not None

    def adjacent(self, left: int, right: int) -> bool:
        """Whether merging the two tokens' bytes gives just these two tokens.

        Both sides build up independently, in rank order, unless at some point
        the pair across the joint has the lowest rank (leftmost first on ties).
        ``left`` START asks whether ``right`` may begin a piece."""
        key = left << 32 | right
        got = self.pairs.get(key)
        if got is None:
            got = self._adjacent(left, right) if left >= 0 else left == START and self.reachable(right)
            if len(self.pairs) >= self.most_pairs:
                self.pairs.clear()
            self.pairs[key] = got
        return got

    def _adjacent(self, left: int, right: int) -> bool:
        a, b = self._history(left), self._history(right)
        if a is None or b is None:
            return False
        (ra, _, ends), (rb, starts, _) = a, b
        na, nb, i, j = len(ra), len(rb), 0, 0
        rank = self.ranks.get
        never = 1 << 60
        while True:
            across = rank(ends[i] + starts[j], never)
            x = ra[i] if i < na else never
            y = rb[j] if j < nb else never
            if across < x and across <= y and across < never:
                return False
            if x == never and y == never:
                return True
            if x <= y:
                i += 1
            else:
                j += 1


class PrefixTable:
    """Last token of the encoding of every prefix of one byte string."""

    def __init__(self, vocab: Vocabulary, data: bytes = b""):
        self.vocab, self.data, self.last = vocab, b"", []
        self.append(data)

    def append(self, data: bytes) -> None:
        self.data += data
        self._fill(len(self.last))

    def _fill(self, start: int, settled=None) -> int:
        """Compute ``last`` from position ``start`` on; returns where it
        stopped.  ``settled(pos, token)`` may end the pass early."""
        v, last, n = self.vocab, self.last, len(self.data)
        del last[start:]
        last.extend([UNSET] * (n - start))
        pairs, adjacent = v.pairs, v.adjacent
        begin = max(0, start - v.longest + 1)
        done = start - 1
        for end, (length, token) in v.suffixes.iter(self.data[begin:].decode("latin-1")):
            end += begin
            if end < start or last[end] >= 0:
                continue
            before = end - length
            if before < -1:
                continue
            left = last[before] if before >= 0 else START
            fits = pairs.get(left << 32 | token)
            if fits is None:
                fits = adjacent(left, token)
            if fits:
                last[end] = token
                done = end
                if settled is not None and settled(end, token):
                    break
        if settled is None and n and last[-1] < 0:
            raise ValueError("the vocabulary does not cover every byte")
        return done

    def replace(self, start: int, stop: int, data: bytes) -> None:
        """Replace bytes [start, stop); recompute only until the table agrees
        with the old one over a whole token's reach."""
        old, shift = self.last, len(data) - (stop - start)
        self.data = self.data[:start] + data + self.data[stop:]
        self.last = old[:start]
        agree = 0
        edit_end = start + len(data)
        longest = self.vocab.longest

        def settled(pos: int, token: int) -> bool:
            nonlocal agree
            agree = agree + 1 if pos >= edit_end and old[pos - shift] == token else 0
            return agree >= longest

        done = self._fill(start, settled)
        if done + 1 < len(self.data):
            self.last[done + 1:] = old[done + 1 - shift:]

    def tokens(self, end: int | None = None) -> list[int]:
        """Encoding of the prefix of length ``end`` (default: all)."""
        out, at = [], (len(self.data) if end is None else end) - 1
        last, bytes_of = self.last, self.vocab.bytes_of
        while at >= 0:
            token = last[at]
            out.append(token)
            at -= len(bytes_of[token])
        out.reverse()
        return out


class Encoder:
    """Cuts texts into pieces and encodes them, with a memo of short pieces."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, memo: float = 1.0):
        self.vocab = Vocabulary(ranks, memo)
        self.pattern = regex.compile(pattern)
        self.table = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            self.table[rank] = token
        self.memo = _Memo(self, int(PIECE_MEMO * memo))

    def piece(self, piece: str) -> list[int]:
        data = piece.encode("utf-8")
        whole = self.vocab.ranks.get(data)
        return [whole] if whole is not None else PrefixTable(self.vocab, data).tokens()

    def packed(self, text: str | None) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        return b"".join(map(self.memo.__getitem__, self.pattern.findall(text)))

    def encode(self, text: str | None) -> list[int]:
        return np.frombuffer(self.packed(text), "<u4").tolist()

    def decode(self, ids) -> bytes:
        return b"".join(map(self.table.__getitem__, ids))


class _Memo(dict):
    """Piece -> packed ids.  When full, the entries become the older
    generation; those asked for again come back."""

    def __init__(self, encoder: Encoder, most: int):
        super().__init__()
        self.most = most
        self.encoder, self.older = encoder, {}

    def __missing__(self, piece: str) -> bytes:
        ids = self.older.get(piece)
        if ids is None:
            ids = self._encode(piece)
        if len(piece) <= PIECE_MEMO_CHARS:
            if len(self) >= self.most:
                self.older = dict(self)
                self.clear()
            self[piece] = ids
        return ids

    def _encode(self, piece: str) -> bytes:
        return array("I", self.encoder.piece(piece)).tobytes() if NATIVE else np.asarray(self.encoder.piece(piece), "<u4").tobytes()


class EncodedText:
    """One text kept encoded under appends and edits.

    A match of the pattern depends on its own characters and at most
    ``lookahead`` characters after its start or end, so cutting again from the
    last boundary that lies ``lookahead`` characters before a change, until a
    boundary of the old cut comes back behind it, gives the cut of the whole."""

    lookahead = 3

    def __init__(self, encoder: Encoder, text: str = ""):
        self.encoder = encoder
        self.text = text
        self.starts: list[int] = []
        self.ids: list[list[int]] = []
        self._recut(0, 0, 0, [], [])

    def _recut(self, keep: int, edit_end: int, shift: int, old_starts: list[int], old_ids: list[list[int]]) -> None:
        begin = old_starts[keep] if keep < len(old_starts) else 0
        starts, ids = old_starts[:keep], old_ids[:keep]
        known = {s + shift: k for k, s in enumerate(old_starts)}
        for m in self.encoder.pattern.finditer(self.text, begin):
            k = known.get(m.start())
            if k is not None and m.start() >= edit_end and k >= keep:
                starts += [s + shift for s in old_starts[k:]]
                ids += old_ids[k:]
                break
            starts.append(m.start())
            ids.append(self.encoder.piece(m.group()))
        self.starts, self.ids = starts, ids

    def replace(self, start: int, stop: int, text: str) -> None:
        import bisect
        old_starts, old_ids = self.starts, self.ids
        self.text = self.text[:start] + text + self.text[stop:]
        # the piece that ends at or after (start - lookahead), and the one before it
        keep = max(0, bisect.bisect_left(old_starts, start - self.lookahead) - 2)
        self._recut(keep, start + len(text), len(text) - (stop - start), old_starts, old_ids)

    def append(self, text: str) -> None:
        self.replace(len(self.text), len(self.text), text)

    def tokens(self) -> list[int]:
        return [t for piece in self.ids for t in piece]


# --- Spark ------------------------------------------------------------------

_ENCODERS: dict[bytes, Encoder] = {}


def _encoder(data: bytes, pattern: str, memo: float = 1.0) -> Encoder:
    key = hashlib.sha1(data + pattern.encode() + repr(memo).encode()).digest()
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(parse_ranks(data), pattern, memo)
    return _ENCODERS[key]


def _shared_ranks(spark: SparkSession, path: str):
    """The rank file goes to the executors as one broadcast: its size is that
    of the vocabulary, whatever the corpus."""
    with open(path, "rb") as f:
        return spark.sparkContext.broadcast(f.read())


def encode(df: DataFrame, text: str, ranks_path: str, pattern: str, ids: str = "ids") -> DataFrame:
    """Adds array<int> ``ids``; every other column is kept."""
    ranks = _shared_ranks(df.sparkSession, ranks_path)

    @F.pandas_udf("array<int>")
    def run(texts):
        enc = _encoder(ranks.value, pattern)
        return texts.map(lambda t: np.frombuffer(enc.packed(t), "<i4"))

    return df.withColumn(ids, run(F.coalesce(F.col(text), F.lit(""))))


def decode(df: DataFrame, ids: str, ranks_path: str, pattern: str, out: str = "decoded") -> DataFrame:
    """Adds binary ``out``: the bytes of the ids; null ids give no bytes."""
    ranks = _shared_ranks(df.sparkSession, ranks_path)

    @F.pandas_udf("binary")
    def run(rows):
        enc = _encoder(ranks.value, pattern)
        return rows.map(lambda r: enc.decode(() if r is None else r))

    return df.withColumn(out, run(F.col(ids)))


def round_trip(df: DataFrame, doc_id: str, text: str, ranks_path: str, pattern: str, keep_ids: bool = False, memo: float = 1.0) -> DataFrame:
    """Per row: doc_id, n_tokens, SHA-256 of the packed ids, SHA-256 of the
    bytes that decoding those ids gives; with ``keep_ids`` also the packed ids.
    One pass over the texts, no shuffle.  ``memo`` scales what a worker
    remembers of pieces (memory against time)."""
    ranks = _shared_ranks(df.sparkSession, ranks_path)
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] + ["ids"] * keep_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _encoder(ranks.value, pattern, memo)
        for b in batches:
            n, ids_sha, out_sha, ids = [], [], [], []
            for t in b.column(1):
                packed = enc.packed(t.as_py())
                back = enc.decode(np.frombuffer(packed, "<u4").tolist())
                n.append(len(packed) // 4)
                ids_sha.append(hashlib.sha256(packed).hexdigest())
                out_sha.append(hashlib.sha256(back).hexdigest())
                ids.append(packed)
            columns = [b.column(0), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(out_sha, pa.string()), pa.array(ids, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns[:len(names)], names=names)

    return (df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
              .mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids binary" * keep_ids))
