"""WARC archives: writer with revisits, splittable reader.

``write`` gives every row one gzip member in archives under a folder that all
executors share.  Of records with equal payloads (SHA-1 and length) of at
least ``MIN_REVISIT`` bytes, the one with the largest id is a response; the
others are revisits, which hold its headers and point to it.  Each task writes
under names of its own and reports what it wrote; only archives in that report
(the manifest, committed by Spark) belong to the output, so repeated attempts
leave no record twice.

``read`` needs no index.  Archives are cut into byte ranges; a task looks for
the gzip magic in its range, accepts a candidate only if it inflates to a WARC
header, and owns the records that start in its range (it reads past the end of
the range to finish the last one).  After an accepted member the next one
starts where it ends.

Folders are opened through Arrow's file systems: local paths and ``file:``,
``hdfs:``, ``s3:``, ``gs:`` URIs.

Defined results: a null payload is empty; a null url leaves its header out; a
null id is written as such and counts as less than any; rows that repeat an id
and payload of a response are responses too.  A member that breaks off or
whose digest is wrong raises an error.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickline.context import workspace
from tickline.llm.common import stage
from tickline.operators.joins import Measured

MIN_REVISIT = 1000
ARCHIVE_BYTES = 256 << 20      # a task starts a new archive beyond this
SPLIT_BYTES = 32 << 20         # byte range of one reading task
CHUNK = 1 << 16
MAGIC = b"\x1f\x8b\x08"
DATE = "2024-01-01T00:00:00Z"  # fixed, so that reruns write the same bytes
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
COLUMNS = "page_id long, url string, record_type string, payload binary, payload_bytes long, payload_digest string, refers_to long"


def _open(folder: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(folder) if ":" in folder.split("/")[0] else (pafs.LocalFileSystem(), folder)


def _urn(page_id: int | None) -> str:
    return f"<urn:x-page:{'' if page_id is None else page_id}>"


def _id(urn: str) -> int | None:
    text = urn.removeprefix("<urn:x-page:").removesuffix(">")
    return int(text) if text else None


def member(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """One record as a gzip member."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_urn(page_id)}", f"WARC-Date: {DATE}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {quote(url, safe=SAFE)}")
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_urn(refers_to)}"]
    head += [f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    gz = zlib.compressobj(3, zlib.DEFLATED, 31)
    return gz.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + gz.flush()


#: Characters of a URI that stay as they are.
SAFE = "%:/?#[]@!$&'()*+,;=-._~"


def parse(record: bytes) -> tuple:
    """One inflated record as a row of COLUMNS."""
    head, _, rest = record.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    size = int(fields["content-length"])
    if len(rest) < size:
        raise ValueError("a record is shorter than its Content-Length")
    block = rest[:size]
    http, _, payload = block.partition(b"\r\n\r\n")
    kind = fields["warc-type"]
    digest = base64.b32decode(fields["warc-payload-digest"].removeprefix("sha1:"))
    if kind == "revisit":
        told = {k.strip().lower(): v.strip() for k, _, v in (x.partition(b":") for x in http.split(b"\r\n")[1:])}
        payload, length, refers = None, int(told[b"content-length"]), _id(fields["warc-refers-to"])
    else:
        length, refers = len(payload), None
        if hashlib.sha1(payload).digest() != digest:
            raise ValueError(f"the payload of {fields['warc-record-id']} does not have its digest")
    return _id(fields["warc-record-id"]), fields.get("warc-target-uri"), kind, payload, length, digest.hex(), refers


def plan(pages: DataFrame, page_id: str = "page_id", url: str = "url", payload: str = "html") -> DataFrame:
    """page_id, url, payload, revisit, refers_to for every row.  The payloads
    themselves are not shuffled unless the revisits are too many to broadcast."""
    base = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"),
                        F.coalesce(F.col(payload).cast("string"), F.lit("")).cast("binary").alias("payload"))
    base = base.withColumn("digest", F.sha1("payload")).withColumn("n", F.length("payload"))
    small = stage(base.where(F.col("n") >= MIN_REVISIT).select("page_id", "digest", "n"), "digests")
    groups = small.groupBy("digest", "n").agg(F.count(F.lit(1)).alias("c"), F.max("page_id").alias("refers_to")).where("c > 1").drop("c")
    again = stage(small.join(groups, ["digest", "n"]).where(~F.col("page_id").eqNullSafe(F.col("refers_to")))
                       .select(F.col("page_id").alias("_id"), F.col("digest").alias("_digest"), F.col("n").alias("_n"), "refers_to").distinct(), "revisits")
    side = Measured(again, again.count()).side().withColumn("revisit", F.lit(True))
    same = F.col("page_id").eqNullSafe(F.col("_id")) & (F.col("digest") == F.col("_digest")) & (F.col("n") == F.col("_n"))
    return base.join(side, same, "left").select("page_id", "url", "payload", F.coalesce("revisit", F.lit(False)).alias("revisit"), "refers_to")


def write(planned: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write the planned records; returns the manifest (path, bytes, records)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = _open(folder)
        files.create_dir(base, recursive=True)
        done, out, path, size, records = [], None, "", 0, 0

        def close():
            if out is not None:
                out.close()
                done.append((f"{folder}/{path}", size, records))

        for b in batches:
            for page_id, url, payload, revisit, refers_to in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), b.column(3).to_pylist(), b.column(4).to_pylist()):
                if out is None or size >= archive_bytes:
                    close()
                    path, size, records = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = files.open_output_stream(f"{base}/{path}", compression=None)
                data = member(page_id, url, payload.as_py(), refers_to, revisit)
                out.write(data)
                size += len(data)
                records += 1
        close()
        yield pa.RecordBatch.from_arrays([pa.array([d[k] for d in done], t) for k, t in enumerate((pa.string(), pa.int64(), pa.int64()))], names=["path", "bytes", "records"])

    return stage(planned.select("page_id", "url", "payload", "revisit", "refers_to").mapInArrow(run, "path string, bytes long, records long"), "manifest")


class _Bytes:
    """Forward reads of one archive from any position."""

    def __init__(self, files: pafs.FileSystem, path: str):
        self.file = files.open_input_file(path)
        self.size = self.file.size()

    def at(self, pos: int, n: int = CHUNK) -> bytes:
        return self.file.read_at(max(0, min(n, self.size - pos)), pos) if pos < self.size else b""


def _is_record(src: _Bytes, pos: int) -> bool:
    """Whether the bytes at ``pos`` inflate to a WARC header."""
    gz, got = zlib.decompressobj(31), b""
    while b"\r\n\r\n" not in got and not gz.eof:
        data = src.at(pos)
        if not data:
            return False
        try:
            got += gz.decompress(data)
        except zlib.error:
            return False
        pos += len(data)
        if not b"WARC/".startswith(got[:5]) and got[:5] != b"WARC/":
            return False
    head = got.partition(b"\r\n\r\n")[0].lower()
    return head.startswith(b"warc/") and b"\nwarc-type:" in head and b"\ncontent-length:" in head


def _inflate(src: _Bytes, pos: int) -> tuple[bytes, int]:
    """The member at ``pos`` and the position behind it."""
    gz, parts = zlib.decompressobj(31), []
    while not gz.eof:
        data = src.at(pos)
        if not data:
            raise ValueError("an archive breaks off within a record")
        parts.append(gz.decompress(data))
        pos += len(data)
    return b"".join(parts), pos - len(gz.unused_data)


def records(src: _Bytes, start: int, end: int) -> Iterator[bytes]:
    """The inflated records that start in [start, end)."""
    pos = start
    while pos < min(end, src.size):
        window = src.at(pos, CHUNK + len(MAGIC) - 1)
        at = window.find(MAGIC)
        if at < 0:
            pos += max(1, len(window) - len(MAGIC) + 1)
        elif pos + at >= end:
            return
        elif _is_record(src, pos + at):
            record, pos = _inflate(src, pos + at)
            yield record
        else:
            pos += at + 1


def read(manifest: DataFrame, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """COLUMNS of every record in the archives (columns path and bytes)."""
    splits = stage(manifest.select("path", "bytes", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.col("bytes") - 1, F.lit(0)), F.lit(split_bytes).cast("long"))).alias("start")), "splits")
    kinds = (pa.int64(), pa.string(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.int64())
    names = [c.split()[0] for c in COLUMNS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, start in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                files, base = _open(path)
                src, rows, held = _Bytes(files, base), [], 0
                for r in records(src, start, start + split_bytes):
                    rows.append(parse(r))
                    held += len(r)
                    if held > 8 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in rows], t) for k, t in enumerate(kinds)], names=names)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in rows], t) for k, t in enumerate(kinds)], names=names)

    n = splits.count()
    return splits.select("path", "start").repartition(max(1, n), "path", "start").mapInArrow(run, COLUMNS)


def archive_folder(spark: SparkSession) -> str:
    return workspace(spark, "warc")
