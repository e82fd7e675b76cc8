"""Binary intraday tick files as a Spark data source (``format("ticks")``).

File layout: a 56-byte header, then 40-byte little-endian records
(u8 raw time, 4 x f4 prices, 4 x u4 counts).  The reader

* opens files through Arrow's file systems, so paths may be local, ``file:``
  URIs or those of any store that Arrow knows; a name is taken as it stands
  first (commas and brackets are part of it) and as a pattern only if no such
  file is there; several go as a JSON list (``load([...])``),
* plans one input partition per byte range of whole records (so one large
  file is read by many tasks in parallel) from names and sizes alone: headers
  are read, and time ranges looked up, by the tasks,
* decodes each range with numpy in blocks and yields Arrow record batches
  (no per-row Python),
* drops a partial trailing record and fails on a file shorter than the header,
* widens f4 -> double and u4 -> bigint, derives ``datetime`` from the raw
  clock, ``contract`` from the file name (or the ``contract`` option), and
  ``record_no`` = the record's ordinal in its file,
* accepts pushed comparisons on ``raw_time`` / ``datetime`` / ``record_no``
  and applies them exactly while decoding (enable with
  ``spark.sql.python.filterPushdown.enabled``; set by ``tickline.context``),
* takes a time range for each file with option ``files`` (a JSON list of name,
  first and end raw time; files that are not there are left out),
* with option ``chronological`` (times never go back within a file) finds the
  records of a file's range and of a pushed one by binary search, and reads only
  those.

As a stream (``readStream.format("ticks")``) the offset is the number of whole
records of every file: files that grow, and new ones, are followed, and each
record is read once.  With ``recordsPerTrigger`` a trigger takes at most so many,
shared among the files that have some.  Files are expected to grow only.

The writer (``df.write.format("ticks")``) writes one file per contract and
task (and value of the column ``part``, if there is one), records in the order
given; used to make fixtures and exports.  Files get their names when all tasks
are done, so tasks that fail or run twice leave none.
"""

from __future__ import annotations

import datetime as _dt
import fnmatch
import json
import re
import struct
import uuid
from collections.abc import Sequence

from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, DataSourceStreamReader, EqualTo, GreaterThan,
    GreaterThanOrEqual, InputPartition, LessThan, LessThanOrEqual, WriterCommitMessage,
)

from tickline.schema import (
    CONTRACT_PATTERN, EPOCH_SHIFT_US, FILE_TYPE_ID, HEADER_FORMAT, HEADER_SIZE,
    RECORD_DTYPE, RECORD_SIZE, SCAN_SCHEMA,
)

DEFAULT_SPLIT_RECORDS = 4_000_000      # 160 MB of records per input partition
BLOCK_RECORDS = 262_144                # decode block (10 MB)
_INT64_MAX = (1 << 63) - 1


def contract_of(path: str) -> str:
    """Per-file helper mirroring ``functions.expr.contract_from_file``."""
    name = re.split(r"[/\\]", path)[-1]
    stem = name.rsplit(".", 1)[0] if "." in name[1:] else name
    m = re.match(CONTRACT_PATTERN, stem)
    return m.group(1) if m else stem.split("_")[0]


_SCHEME = re.compile(r"[A-Za-z][A-Za-z0-9+.-]+:")      # two letters at least: a drive is none


def _store(path: str):
    """(Arrow file system, the path in it, head, base): ``head`` + the path
    beyond ``base`` is the name again."""
    from pyarrow import fs

    if path.startswith("file:"):
        inner = re.sub("^file:(//)?(?=/)", "", path)
        return fs.LocalFileSystem(), inner, path[:len(path) - len(inner)], ""
    if not _SCHEME.match(path):
        return fs.LocalFileSystem(), path, "", ""
    head, rest = re.match("([^:]+:(?://[^/]*)?)/*(.*)", path, re.S).groups()
    store, base = fs.FileSystem.from_uri(head + "/")
    base = base.rstrip("/")
    return store, f"{base}/{rest}", head, base


def _matching(store, pattern: str) -> list[str]:
    """Paths that match a pattern, one folder level after the other."""
    from pyarrow import fs

    found = ["/" if pattern.startswith("/") else ""]
    for part in filter(None, pattern.split("/")):
        if any(c in part for c in "*?["):
            found = [i.path for f in found for i in store.get_file_info(fs.FileSelector(f, allow_not_found=True))
                     if fnmatch.fnmatchcase(i.base_name, part)]
        else:
            found = [f"{f.rstrip('/')}/{part}" if f else part for f in found]
    return found


def sized_files(paths: str | Sequence[str]) -> dict[str, int]:
    """Name and bytes of the files that ``paths`` name: files, folders of
    ``*.scid``, or patterns."""
    from pyarrow import fs

    out = {}
    for path in [paths] if isinstance(paths, str) else paths:
        store, inner, head, base = _store(path)
        info = store.get_file_info(inner)
        if info.type == fs.FileType.Directory:
            infos = [i for i in store.get_file_info(fs.FileSelector(inner)) if i.base_name.endswith(".scid")]
        elif info.type == fs.FileType.NotFound and any(c in inner for c in "*?["):
            infos = store.get_file_info(_matching(store, inner))
        else:
            infos = [info]
        for i in sorted(infos, key=lambda i: i.path):
            if i.type == fs.FileType.File:
                out[path if i is info else head + i.path[len(base):]] = i.size
    return out


def existing_files(names: Sequence[str]) -> dict[str, int]:
    """Name and bytes of those of the exact ``names`` that are there, asked for in one call a store."""
    from pyarrow import fs

    by_store: dict = {}
    for name in names:
        store, inner, head, _ = _store(name)
        by_store.setdefault((type(store), head), (store, {}))[1][name] = inner
    out = {}
    for store, inner in by_store.values():
        for name, i in zip(inner, store.get_file_info(list(inner.values()))):
            if i.type == fs.FileType.File:
                out[name] = i.size
    return out


def list_files(paths: str | Sequence[str]) -> list[str]:
    """Names of a file, of a folder's ``*.scid``, of a pattern, or of a list of those."""
    return list(sized_files(paths))


def open_file(path: str):
    store, inner, _, _ = _store(path)
    return store.open_input_file(inner)


def read_header(path: str) -> dict:
    with open_file(path) as f:
        return _header(path, f)


def _header(path: str, f) -> dict:
    data = f.read_at(min(HEADER_SIZE, f.size()), 0)
    if len(data) < HEADER_SIZE:
        raise ValueError(f"{path}: file is too small to contain a valid header")
    ftype, hsize, rsize, version, unused, utc_start, _ = struct.unpack(HEADER_FORMAT, data)
    return {"file_type_id": ftype.rstrip(b"\x00").decode("utf-8", "replace"), "header_size": hsize,
            "record_size": rsize, "version": version, "unused1": unused, "utc_start_index": utc_start}


class TickRange(InputPartition):
    """Records [first, stop) of a file, with raw times from ``lo`` to ``hi``."""

    def __init__(self, path: str, first: int, stop: int, lo: int = 0, hi: int = _INT64_MAX):
        self.path, self.first, self.stop, self.lo, self.hi = path, first, stop, lo, hi


def _to_raw(value) -> int:
    if isinstance(value, _dt.datetime):
        if value.tzinfo is None:
            value = value.replace(tzinfo=_dt.timezone.utc)
        delta = value - _dt.datetime(1970, 1, 1, tzinfo=_dt.timezone.utc)
        return (delta.days * 86_400 + delta.seconds) * 1_000_000 + delta.microseconds + EPOCH_SHIFT_US
    return int(value)


def copy_prefix(src: str, dst: str, size: int) -> None:
    """The first ``size`` bytes of a file to another one, which appears whole."""
    store, inner, _, _ = _store(dst)
    store.create_dir(inner.rsplit("/", 1)[0], recursive=True)
    part = f"{inner}.{uuid.uuid4().hex[:8]}{_UNFINISHED}"
    with open_file(src) as a, store.open_output_stream(part) as b:
        while size > 0 and (block := a.read(min(size, BLOCK_RECORDS * RECORD_SIZE))):
            b.write(block)
            size -= len(block)
    store.move(part, inner)


def whole_records(size: int) -> int:
    """Of a file of ``size`` bytes."""
    return max(0, size - HEADER_SIZE) // RECORD_SIZE


def first_at_or_after(fh, raw: int, lo: int, hi: int) -> int:
    """First record in [lo, hi) of an open chronological file whose time is at least ``raw``, else ``hi``."""
    while lo < hi:
        mid = (lo + hi) // 2
        if int.from_bytes(fh.read_at(8, HEADER_SIZE + mid * RECORD_SIZE), "little") < raw:
            lo = mid + 1
        else:
            hi = mid
    return lo


class TickFileReader(DataSourceReader):
    def __init__(self, options, schema):
        self.paths = json.loads(options["paths"]) if options.get("paths") else options.get("path")
        self.files = json.loads(options["files"]) if options.get("files") else None
        self.chronological = str(options.get("chronological", "false")).lower() == "true"
        self.contract = options.get("contract")
        self.split = int(options.get("splitRecords", DEFAULT_SPLIT_RECORDS))
        self.schema = schema
        # inclusive bounds
        self.raw_lo, self.raw_hi = 0, _INT64_MAX
        self.rec_lo, self.rec_hi = 0, _INT64_MAX

    def pushFilters(self, filters):
        for f in filters:
            col = f.attribute[0] if len(f.attribute) == 1 else None
            if col not in ("raw_time", "datetime", "record_no") or not isinstance(
                    f, (GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual, EqualTo)):
                yield f
                continue
            try:
                v = _to_raw(f.value) if col != "record_no" else int(f.value)
            except (TypeError, ValueError):
                yield f
                continue
            lo, hi = (self.rec_lo, self.rec_hi) if col == "record_no" else (self.raw_lo, self.raw_hi)
            if isinstance(f, GreaterThan):
                lo = max(lo, v + 1)
            elif isinstance(f, GreaterThanOrEqual):
                lo = max(lo, v)
            elif isinstance(f, LessThan):
                hi = min(hi, v - 1)
            elif isinstance(f, LessThanOrEqual):
                hi = min(hi, v)
            else:
                lo, hi = max(lo, v), min(hi, v)
            if col == "record_no":
                self.rec_lo, self.rec_hi = lo, hi
            else:
                self.raw_lo, self.raw_hi = lo, hi

    def partitions(self):
        if self.files is not None:
            sizes = existing_files([name for name, _, _ in self.files])
            files = [(name, sizes[name], lo or 0, _INT64_MAX if hi is None else hi - 1) for name, lo, hi in self.files if name in sizes]
        else:
            files = [(name, size, 0, _INT64_MAX) for name, size in sized_files(self.paths).items()]
            if not files:
                raise FileNotFoundError(f"no tick files at {self.paths}")
        parts = []
        for path, size, lo, hi in files:
            n = whole_records(size)
            first, stop = max(0, self.rec_lo), min(n, self.rec_hi + 1 if self.rec_hi < _INT64_MAX else n)
            lo, hi = max(lo, self.raw_lo), min(hi, self.raw_hi)
            if size < HEADER_SIZE:
                parts.append(TickRange(path, 0, 0))         # its task says so
            elif lo <= hi:
                parts += [TickRange(path, k, min(stop, k + self.split), lo, hi) for k in range(first, stop, self.split)]
        return parts or [TickRange("", 0, 0)]

    def read(self, partition: TickRange):
        import numpy as np
        import pyarrow as pa

        if not partition.path:
            return
        dtype = np.dtype(RECORD_DTYPE)
        contract = self.contract or contract_of(partition.path)
        names = [f.name for f in self.schema.fields]
        with open_file(partition.path) as fh:
            _header(partition.path, fh)
            pos, stop = partition.first, partition.stop
            if self.chronological:
                pos = first_at_or_after(fh, partition.lo, pos, stop) if partition.lo > 0 else pos
                stop = first_at_or_after(fh, partition.hi + 1, pos, stop) if partition.hi < _INT64_MAX else stop
            while pos < stop:
                count = min(BLOCK_RECORDS, stop - pos)
                buf = fh.read_at(count * RECORD_SIZE, HEADER_SIZE + pos * RECORD_SIZE)
                count = len(buf) // RECORD_SIZE
                if count == 0:
                    break
                rec = np.frombuffer(buf[:count * RECORD_SIZE], dtype=dtype)
                if (rec["raw_time"] > _INT64_MAX).any():
                    raise ValueError(f"{partition.path}: a time from 2^63 on is no tick time")
                raw = rec["raw_time"].astype(np.int64)
                ordinal = np.arange(pos, pos + count, dtype=np.int64)
                keep = (raw >= partition.lo) & (raw <= partition.hi)
                pos += count
                if not keep.any():
                    continue
                cols = {
                    "datetime": pa.array(raw[keep] - EPOCH_SHIFT_US, type=pa.int64()).cast(
                        pa.timestamp("us", tz="UTC")),
                    "raw_time": pa.array(raw[keep]),
                    "open": pa.array(rec["open"][keep].astype(np.float64)),
                    "high": pa.array(rec["high"][keep].astype(np.float64)),
                    "low": pa.array(rec["low"][keep].astype(np.float64)),
                    "close": pa.array(rec["close"][keep].astype(np.float64)),
                    "num_trades": pa.array(rec["num_trades"][keep].astype(np.int64)),
                    "volume": pa.array(rec["volume"][keep].astype(np.int64)),
                    "bid_volume": pa.array(rec["bid_volume"][keep].astype(np.int64)),
                    "ask_volume": pa.array(rec["ask_volume"][keep].astype(np.int64)),
                    "record_no": pa.array(ordinal[keep]),
                }
                k = int(keep.sum())
                cols["contract"] = pa.array([contract] * k, type=pa.string())
                cols["file"] = pa.array([partition.path] * k, type=pa.string())
                yield pa.RecordBatch.from_arrays([cols[n] for n in names], names=names)


class TickFileStream(DataSourceStreamReader):
    """Follows tick files by record number."""

    def __init__(self, options, schema):
        self.decoder = TickFileReader(options, schema)
        self.limit = int(options.get("recordsPerTrigger", 0))
        # Where the stream has come to: the engine does not tell a restarted source.
        self.at = json.loads(options.get("startOffset") or "{}")

    def initialOffset(self):
        return {}

    def latestOffset(self):
        files = self.decoder.files
        sizes = sized_files(self.decoder.paths) if files is None else existing_files([name for name, _, _ in files])
        there = {p: max(whole_records(size), self.at.get(p, 0)) for p, size in sizes.items()}
        more = {p: n - self.at.get(p, 0) for p, n in there.items() if n > self.at.get(p, 0)}
        if self.limit and sum(more.values()) > self.limit:
            left, take = self.limit, dict.fromkeys(more, 0)
            while left:
                open_ = [p for p in more if take[p] < more[p]]
                share = max(1, left // len(open_))
                for p in open_[:left]:
                    n = min(share, more[p] - take[p])
                    take[p], left = take[p] + n, left - n
            more = take
        self.at = {**self.at, **{p: self.at.get(p, 0) + n for p, n in more.items()}}
        return self.at

    def partitions(self, start, end):
        self.at = {p: max(n, self.at.get(p, 0)) for p, n in {**self.at, **end}.items()}
        split = self.decoder.split
        span = {name: (lo or 0, _INT64_MAX if hi is None else hi - 1) for name, lo, hi in self.decoder.files or ()}
        return [TickRange(p, first, min(stop, first + split), *span.get(p, ()))
                for p, stop in sorted(end.items()) for first in range(start.get(p, 0), stop, split)]

    def read(self, partition: TickRange):
        return self.decoder.read(partition)

    def commit(self, end):
        pass


class TickFileWriter(DataSourceArrowWriter):
    def __init__(self, options, overwrite):
        self.path = options.get("path")
        self.suffix = options.get("nameSuffix", "_FUT_CME")

    def write(self, iterator):
        import numpy as np
        import pyarrow.compute as pc
        from pyspark import TaskContext

        ctx = TaskContext.get()
        task = f"{ctx.partitionId() if ctx else 0:05d}-{uuid.uuid4().hex[:8]}"
        store, folder, _, _ = _store(self.path)
        store.create_dir(folder, recursive=True)
        handles, written = {}, []
        dtype = np.dtype(RECORD_DTYPE)
        try:
            for batch in iterator:
                parts = pc.fill_null(batch.column("part"), "") if "part" in batch.schema.names else None
                keys = pc.fill_null(batch.column("contract"), "")
                if parts is not None:
                    keys = pc.binary_join_element_wise(keys, parts, self.suffix + ".")
                for c in pc.unique(keys).to_pylist():
                    sub = batch.filter(pc.equal(keys, c))
                    fh = handles.get(c)
                    if fh is None:
                        name = f"{folder.rstrip('/')}/{c}{self.suffix if parts is None else ''}.{task}.scid"
                        fh = handles[c] = store.open_output_stream(name + _UNFINISHED)
                        fh.write(struct.pack(HEADER_FORMAT, FILE_TYPE_ID, HEADER_SIZE, RECORD_SIZE, 1, 0, 0,
                                             b"\x00" * 36))
                        written.append(name)
                    rec = np.zeros(sub.num_rows, dtype=dtype)
                    rec["raw_time"] = sub.column("raw_time").to_numpy(zero_copy_only=False)
                    for f in ("open", "high", "low", "close"):
                        rec[f] = sub.column(f).to_numpy(zero_copy_only=False).astype(np.float32)
                    for f in ("num_trades", "volume", "bid_volume", "ask_volume"):
                        rec[f] = sub.column(f).to_numpy(zero_copy_only=False).astype(np.uint32)
                    fh.write(rec.tobytes())
        finally:
            for fh in handles.values():
                fh.close()
        return _Written(written)

    def commit(self, messages):
        store = _store(self.path)[0]
        for name in (n for m in messages if m for n in m.files):
            store.move(name + _UNFINISHED, name)

    def abort(self, messages):
        store = _store(self.path)[0]
        for name in (n for m in messages if m for n in m.files):
            store.delete_file(name + _UNFINISHED)


_UNFINISHED = ".unfinished"


class _Written(WriterCommitMessage):
    def __init__(self, files):
        self.files = files


class TickFileSource(DataSource):
    @classmethod
    def name(cls):
        return "ticks"

    def schema(self):
        return SCAN_SCHEMA

    def reader(self, schema):
        return TickFileReader(self.options, schema)

    def streamReader(self, schema):
        return TickFileStream(self.options, schema)

    def writer(self, schema, overwrite):
        return TickFileWriter(self.options, overwrite)


def register(spark) -> None:
    spark.dataSource.register(TickFileSource)


def scan_ticks(spark, path: str | Sequence[str] | None = None, contract: str | None = None, split_records: int | None = None,
               chronological: bool = False, files: Sequence[tuple[str, int | None, int | None]] | None = None):
    """Read tick files (files, patterns or folders of ``*.scid``) as a DataFrame
    with the tick schema plus ``record_no`` and ``file``.  ``files`` names them
    with a raw time range each (from, before; None: open) instead; those that
    are not there are left out.  ``chronological`` promises that times never go
    back within a file."""
    register(spark)
    r = spark.read.format("ticks")
    if contract:
        r = r.option("contract", contract)
    if split_records:
        r = r.option("splitRecords", str(int(split_records)))
    if chronological:
        r = r.option("chronological", "true")
    if files is not None:
        return r.option("files", json.dumps([list(f) for f in files])).load()
    return r.option("paths", json.dumps([path] if isinstance(path, str) else list(path))).load()


def follow_ticks(spark, path: str | Sequence[str] | None = None, records_per_trigger: int | None = None, start: str | None = None,
                 files: Sequence[tuple[str, int | None, int | None]] | None = None):
    """Stream of the records that are, or come to be, in tick files (``files``:
    as for ``scan_ticks``).  A limited stream that is restarted must be told its
    last offset (``start``)."""
    register(spark)
    r = spark.readStream.format("ticks")
    if files is not None:
        r = r.option("files", json.dumps([list(f) for f in files]))
    else:
        r = r.option("paths", json.dumps([path] if isinstance(path, str) else list(path)))
    if records_per_trigger:
        r = r.option("recordsPerTrigger", str(int(records_per_trigger)))
    if start:
        r = r.option("startOffset", start)
    return r.load()


def write_ticks(df, path: str) -> str:
    """Write ticks as binary files, one per contract (and ``part``, if the frame
    has such a column) per task, in each partition's row order (sort first for
    chronological files)."""
    register(df.sparkSession)
    cols = ["raw_time", "open", "high", "low", "close", "num_trades", "volume", "bid_volume",
            "ask_volume", "contract"]
    if "part" in df.columns:
        cols.append("part")
    df.select(*cols).write.format("ticks").mode("append").save(path)
    return path
