"""Changing a Parquet table by whole files, so that a broken job can be mended.

A job first writes its new files beside the months, under ``_staged/<job>``
(Spark skips names that begin with an underscore).  Then one small record,
``_publish/<job>.json``, names the files to bring in and the files to take out;
putting it in its place is the commit.  What follows only carries it out: new
files are renamed into their months, old ones deleted, and the record goes to
``_done``.

* A job that breaks before the record has changed nothing: ``recover`` drops
  what it staged.
* One that breaks after it is finished by ``recover``, which every writer calls
  first; each step may be done again.
* Between the two, readers that go through ``table_files`` see the table as the
  record will leave it.

A job with a name that is in ``_done`` has happened; a stream that names its
jobs by batch is so kept from adding a batch twice.  One writer at a time may
change a table.  Renames and deletes are file-system calls of the driver, one a
file; no data passes through it.
"""

from __future__ import annotations

import json
import re
import uuid

from pyspark.sql import DataFrame, SparkSession

STAGED, RECORDS, DONE = "_staged", "_publish", "_done"


class _Files:
    """The few file-system calls that publishing takes, of any store Spark knows."""

    def __init__(self, spark: SparkSession, root: str):
        self.path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self.fs = self.path(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self.jvm = spark.sparkContext._jvm

    def exists(self, p: str) -> bool:
        return bool(self.fs.exists(self.path(p)))

    def names(self, p: str) -> list[str]:
        return sorted(s.getPath().getName() for s in self.fs.listStatus(self.path(p))) if self.exists(p) else []

    def move(self, a: str, b: str) -> None:
        """``a`` to ``b``; done already if only ``b`` is there."""
        if self.exists(a):
            self.fs.mkdirs(self.path(b).getParent())
            if not self.fs.rename(self.path(a), self.path(b)):
                raise OSError(f"cannot rename {a} to {b}")
        elif not self.exists(b):
            raise FileNotFoundError(f"neither {a} nor {b} is there")

    def delete(self, p: str) -> None:
        self.fs.delete(self.path(p), True)

    def put(self, p: str, text: str) -> None:
        out = self.fs.create(self.path(p), True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()

    def get(self, p: str) -> str:
        stream = self.fs.open(self.path(p))
        try:
            return bytes(self.jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
        finally:
            stream.close()


def names_in(spark: SparkSession, folder: str) -> list[str]:
    return _Files(spark, folder).names(folder)


def text_of(spark: SparkSession, path: str) -> str:
    return _Files(spark, path).get(path)


def _step(action, *args):
    """Every change of a table goes through here, one file at a time."""
    return action(*args)


def new_job(name: str) -> str:
    return f"{name}-{uuid.uuid4().hex[:12]}"


def staged_path(table_path: str, job: str) -> str:
    return f"{table_path.rstrip('/')}/{STAGED}/{job}"


def move_staged(spark: SparkSession, table_path: str, old: str, new: str) -> None:
    """Let what ``old`` has staged be staged by ``new``."""
    _Files(spark, table_path).move(staged_path(table_path, old), staged_path(table_path, new))


def relative(file: str) -> str:
    """``month=.../name`` of a data file's path."""
    return re.search(r"([^/]+=[^/]*/)*[^/]+$", file).group(0)


def publish(spark: SparkSession, table_path: str, job: str, remove: list[str] = (), note: dict | None = None) -> None:
    """Commit what ``job`` has staged, taking out the files ``remove`` (paths
    below the table).  With a ``note`` the record is kept as done."""
    root, f = table_path.rstrip("/"), _Files(spark, table_path)
    base = staged_path(root, job)
    add = [f"{month}/{name}" for month in f.names(base) if "=" in month for name in f.names(f"{base}/{month}") if name.endswith(".parquet")]
    record = {"add": add, "remove": sorted(remove), "note": note}
    _put_record(f, root, job, record)
    _carry_out(f, root, job, record)


def _put_record(f: _Files, root: str, job: str, record: dict) -> None:
    _step(f.put, f"{root}/{RECORDS}/.{job}", json.dumps(record))
    _step(f.move, f"{root}/{RECORDS}/.{job}", f"{root}/{RECORDS}/{job}.json")


def _carry_out(f: _Files, root: str, job: str, record: dict) -> None:
    for name in record["add"]:
        _step(f.move, f"{root}/{STAGED}/{job}/{name}", f"{root}/{name}")
    for name in record["remove"]:
        _step(f.delete, f"{root}/{name}")
    for month in {name.rsplit("/", 1)[0] for name in record["remove"] if "/" in name}:
        if not any(n.endswith(".parquet") for n in f.names(f"{root}/{month}")):
            _step(f.delete, f"{root}/{month}")
    if record["note"] is None:
        _step(f.delete, f"{root}/{RECORDS}/{job}.json")
    else:
        _step(f.move, f"{root}/{RECORDS}/{job}.json", f"{root}/{DONE}/{job}.json")
    _step(f.delete, f"{root}/{STAGED}/{job}")


def move_out(spark: SparkSession, table_path: str, job: str, remove: list[str], other: str) -> None:
    """Commit what ``job`` has staged in the table ``other`` and take ``remove``
    out of this one: both or neither.  This table's record goes first and
    counts only once the other's job is committed."""
    root, f = table_path.rstrip("/"), _Files(spark, table_path)
    taken = published_files(spark, other)
    months = {name.rsplit("/", 1)[0] for name in remove}
    _put_record(f, root, job, {"add": [], "remove": sorted(remove), "note": None, "other": other})
    publish(spark, other, job, [n for n in taken if n.rsplit("/", 1)[0] in months], note={})
    _carry_out(f, root, job, _read(f, root, job))


def _read(f: _Files, root: str, job: str) -> dict:
    return json.loads(f.get(f"{root}/{RECORDS}/{job}.json"))


def _holds(spark: SparkSession, job: str, record: dict) -> bool:
    """Whether a record is a commit: alone, or with its other table's."""
    if "other" not in record:
        return True
    root, f = record["other"].rstrip("/"), _Files(spark, record["other"])
    return f.exists(f"{root}/{RECORDS}/{job}.json") or f.exists(f"{root}/{DONE}/{job}.json")


def _records(spark: SparkSession, root: str) -> dict[str, dict]:
    f = _Files(spark, root)
    return {name[:-5]: json.loads(f.get(f"{root}/{RECORDS}/{name}")) for name in f.names(f"{root}/{RECORDS}") if not name.startswith(".")}


def recover(spark: SparkSession, table_path: str) -> None:
    """Finish jobs that were committed, drop what others have left."""
    root, f = table_path.rstrip("/"), _Files(spark, table_path)
    for job, record in _records(spark, root).items():
        if _holds(spark, job, record):
            _carry_out(f, root, job, record)
        else:
            _step(f.delete, f"{root}/{RECORDS}/{job}.json")
    for name in f.names(f"{root}/{RECORDS}"):
        _step(f.delete, f"{root}/{RECORDS}/{name}")
    for job in f.names(f"{root}/{STAGED}"):
        _step(f.delete, f"{root}/{STAGED}/{job}")


def done_record(spark: SparkSession, table_path: str, job: str) -> dict | None:
    """The record of a job with a note that is finished."""
    path, f = f"{table_path.rstrip('/')}/{DONE}/{job}.json", _Files(spark, table_path)
    return json.loads(f.get(path)) if f.exists(path) else None


def _sources(spark: SparkSession, table_path: str) -> list[tuple[str, list[str]]] | None:
    """Where the table's files are, as (folder, files below it), while a commit
    is being carried out; None if there is none and the table's folder says it all."""
    root = table_path.rstrip("/")
    records = {j: r for j, r in _records(spark, root).items() if _holds(spark, j, r)}
    if not records:
        return None
    f = _Files(spark, root)
    gone = {n for r in records.values() for n in r["remove"]}
    here = [f"{m}/{n}" for m in f.names(root) if "=" in m for n in f.names(f"{root}/{m}") if n.endswith(".parquet")]
    out = [(root, [n for n in here if n not in gone])]
    for job, r in records.items():
        base = f"{root}/{STAGED}/{job}"
        out.append((base, [n for n in r["add"] if f.exists(f"{base}/{n}")]))
    return [(base, names) for base, names in out if names]


def published_files(spark: SparkSession, table_path: str) -> list[str]:
    """The data files of the table, as paths below it."""
    root, sources = table_path.rstrip("/"), _sources(spark, table_path)
    if sources is not None:
        return sorted(n for _, names in sources for n in names)
    f = _Files(spark, root)
    return [f"{m}/{n}" for m in f.names(root) if "=" in m for n in f.names(f"{root}/{m}") if n.endswith(".parquet")]


def read_published(spark: SparkSession, table_path: str, schema, only: list[str] | None = None, fmt: str = "parquet") -> DataFrame:
    """The table as its last commit leaves it, or its files ``only`` (paths below it)."""
    root, sources = table_path.rstrip("/"), _sources(spark, table_path)
    reader = lambda: spark.read.schema(schema).format(fmt) if schema is not None else spark.read.format(fmt)
    if sources is None:
        if only is None:
            return reader().load(root)
        sources = [(root, only)]
    elif only is not None:
        sources = [(base, [n for n in names if n in set(only)]) for base, names in sources]
    parts = [reader().option("basePath", base).load([f"{base}/{n}" for n in names]) for base, names in sources if names]
    if not parts:
        return spark.createDataFrame([], schema if schema is not None else "path string, modificationTime timestamp, length long, content binary")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
