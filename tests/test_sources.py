"""Binary tick files: layout, edge cases, splits, pushdown; calendar parsing."""

import json
import os
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickline.schema import (
    EPOCH_SHIFT_US, FIRST_BUNDLE_TRADE, HEADER_FORMAT, LAST_BUNDLE_TRADE, RECORD_DTYPE,
)
from tickline.sources.scid import contract_of, scan_ticks


def _write(path, rows, tail=b""):
    rec = np.zeros(len(rows), dtype=np.dtype(RECORD_DTYPE))
    for i, r in enumerate(rows):
        rec[i] = r
    with open(path, "wb") as fh:
        fh.write(struct.pack(HEADER_FORMAT, b"SCID", 56, 40, 1, 0, 0, b"\x00" * 36))
        fh.write(rec.tobytes())
        fh.write(tail)


def _raw(iso):
    import datetime as dt
    d = dt.datetime.fromisoformat(iso).replace(tzinfo=dt.timezone.utc)
    return int(d.timestamp()) * 1_000_000 + d.microsecond + EPOCH_SHIFT_US


ROWS = [
    (_raw("2024-03-01T14:30:00"), 0.0, 5001.25, 5000.75, 5001.0, 1, 3, 3, 0),
    (_raw("2024-03-01T14:30:00"), FIRST_BUNDLE_TRADE, 5001.5, 5001.0, 5001.25, 2, 5, 0, 5),
    (_raw("2024-03-01T14:30:00.5"), LAST_BUNDLE_TRADE, 5001.5, 5001.0, 5001.5, 1, 1, 1, 0),
    (_raw("2024-03-02T00:00:00"), 0.0, 5002.0, 5001.5, 5001.75, 1, 3_000_000_000, 0, 3_000_000_000),
]


@pytest.fixture
def files(tmp_path):
    _write(tmp_path / "ESZ24_FUT_CME.scid", ROWS, tail=b"\x01" * 17)     # partial trailing record
    _write(tmp_path / "NQH25.scid", ROWS[:2])
    _write(tmp_path / "weird-name_x.scid", ROWS[:1])
    return tmp_path


def test_decode_and_edges(spark, files):
    df = scan_ticks(spark, str(files)).orderBy("file", "record_no")
    rows = df.collect()
    assert len(rows) == 4 + 2 + 1                                  # partial record ignored
    es = [r for r in rows if r.contract == "ESZ24"]
    assert [r.record_no for r in es] == [0, 1, 2, 3]
    assert es[1].open == FIRST_BUNDLE_TRADE and es[2].open == LAST_BUNDLE_TRADE
    assert es[3].volume == 3_000_000_000                            # u4 above 2^31 survives
    assert es[0].raw_time == es[1].raw_time                         # equal times kept, order by record
    assert str(es[3].datetime) == "2024-03-02 00:00:00"
    assert {r.contract for r in rows} == {"ESZ24", "NQH25", "weird-name"}


def test_contract_names():
    assert contract_of("C:\\Ticks\\Data\\ESZ24_FUT_CME.scid") == "ESZ24"
    assert contract_of("/x/NQH25.scid") == "NQH25"
    assert contract_of("/x/abc_def.scid") == "abc"


def test_short_file_fails(spark, tmp_path):
    (tmp_path / "ESZ24_FUT_CME.scid").write_bytes(b"SCID" + b"\x00" * 10)
    with pytest.raises(Exception, match="too small"):
        scan_ticks(spark, str(tmp_path)).count()


def test_splits_and_pushdown(spark, tmp_path):
    n = 5000
    base = _raw("2024-03-01T00:00:00")
    rows = [(base + i * 1_000_000, 0.0, 1.0, 1.0, float(i % 97), 1, 1, 1, 0) for i in range(n)]
    _write(tmp_path / "ESZ24_FUT_CME.scid", rows)
    whole = scan_ticks(spark, str(tmp_path), split_records=700)
    assert whole.rdd.getNumPartitions() == 8
    assert whole.count() == n and whole.agg(F.sum("record_no")).first()[0] == n * (n - 1) // 2
    lo, hi = base + 1000 * 1_000_000, base + 2000 * 1_000_000
    cut = whole.where((F.col("raw_time") >= lo) & (F.col("raw_time") < hi))
    plan = cut._jdf.queryExecution().executedPlan().toString()
    assert "raw_time" in plan
    assert cut.count() == 1000


def test_calendar_defaults_and_rows(spark, tmp_path):
    from tickline.sources.calendar import contract_calendar, list_symbols
    cfg = {"symbols": {"ES": {"contracts": [
        {"file": "C:\\Data\\ESH24_FUT_CME.scid", "start_date": "2024-01-01", "end_date": "2024-03-11"},
        {"file": "C:\\Data\\ESM24_FUT_CME.scid", "start_date": "2024-03-11", "end_date": None}]},
        "NQ": {"table_name": "NQX", "price_multiplier": 0.01, "contracts": []}}}
    p = tmp_path / "config.json"
    p.write_text(json.dumps(cfg))
    rows = contract_calendar(spark, str(p)).orderBy("file").collect()
    assert [(r.symbol, r.table_name, r.price_multiplier, r.end_date) for r in rows] == [
        ("ES", "ES", 1.0, "2024-03-11"), ("ES", "ES", 1.0, None)]
    assert sorted(r.symbol for r in list_symbols(spark, str(p)).collect()) == ["ES", "NQ"]
    assert contract_calendar(spark, str(tmp_path / "missing.json")).count() == 0
    assert sorted(r.symbol for r in list_symbols(spark, None).collect()) == ["ES", "NQ"]


def test_a_time_range_reads_only_its_records(tmp_path, monkeypatch):
    from pyspark.sql.datasource import GreaterThanOrEqual, LessThan

    from tickline.schema import SCAN_SCHEMA
    from tickline.sources.scid import TickFileReader
    start = _raw("2024-03-01T00:00:00")
    _write(tmp_path / "ESZ24.scid", [(start + i // 3 * 1000, 0.0, 1, 1, 1, 1, 1, 1, 0) for i in range(1000)])
    reader = TickFileReader({"path": str(tmp_path), "chronological": "true", "splitRecords": "50"}, SCAN_SCHEMA)
    lo, hi = start + 100 * 1000, start + 120 * 1000
    assert list(reader.pushFilters([GreaterThanOrEqual(("raw_time",), lo), LessThan(("raw_time",), hi)])) == []
    parts = reader.partitions()
    assert [(p.first, p.stop) for p in parts] == [(k, k + 50) for k in range(0, 1000, 50)]      # planned without opening a file
    got, read = counted(monkeypatch, reader, parts)
    assert got == [start + i // 3 * 1000 for i in range(300, 360)]
    assert read == 60


def counted(monkeypatch, reader, parts):
    """Raw times that a reader's partitions give, and how many records they read whole."""
    from tickline.sources import scid
    real, read = scid.open_file, []

    class Counting:
        def __init__(self, path):
            self.file = real(path)

        def __enter__(self):
            return self

        def __exit__(self, *exc):
            self.file.close()

        def size(self):
            return self.file.size()

        def read_at(self, n, at):
            if n >= 40 and at >= 56:
                read.append(n // 40)
            return self.file.read_at(n, at)

    monkeypatch.setattr(scid, "open_file", Counting)
    return [t for p in parts for b in reader.read(p) for t in b.column("raw_time").to_pylist()], sum(read)


def test_windows_of_the_calendar_are_all_that_is_read(spark, tmp_path, monkeypatch):
    from tickline.schema import SCAN_SCHEMA
    from tickline.sources.calendar import continuous_series, contract_calendar, read_ranges
    from tickline.sources.scid import TickFileReader
    day = 86_400_000_000
    start = _raw("2024-03-01T00:00:00")
    names = [f"file:{tmp_path}/ESH24_FUT, CME.scid", f"file://{tmp_path}/ESM24[1].scid", str(tmp_path / "ESU24 ü.scid")]
    for k, n in enumerate(("ESH24_FUT, CME.scid", "ESM24[1].scid", "ESU24 ü.scid")):
        _write(tmp_path / n, [(start + i * day // 10, 0.0, 1, 1, k + i / 8, 1, 1, 1, 0) for i in range(200)])
    cfg = {"symbols": {"ES": {"contracts": [
        {"file": names[0], "start_date": None, "end_date": "2024-03-05"}, {"file": names[1], "start_date": "2024-03-05", "end_date": "2024-03-09"},
        {"file": names[2], "start_date": "2024-03-09"}, {"file": str(tmp_path / "gone.scid")}]},
        "NQ": {"contracts": [{"file": names[1], "start_date": "2024-03-07", "end_date": "2024-03-11"}]}}}
    (tmp_path / "config.json").write_text(json.dumps(cfg))
    cal = contract_calendar(spark, str(tmp_path / "config.json"))
    whole = {(r.file, r.record_no) for r in scan_ticks(spark, names).collect()}
    assert len(whole) == 600                                                       # commas and brackets lose no file
    for chronological in (False, True):
        out = continuous_series(spark, cal, ordered=False, chronological=chronological, split_records=30)
        got = {}
        for r in out.collect():
            got.setdefault(r.file, []).append(r.record_no)
        assert {f: sorted(n) for f, n in got.items()} == {
            names[0]: list(range(40)), names[1]: sorted([*range(40, 80), *range(60, 100)]), names[2]: list(range(80, 200))}
    ranges = read_ranges(cal)
    reader = TickFileReader({"files": json.dumps(ranges), "chronological": "true", "splitRecords": "30"}, SCAN_SCHEMA)
    got, read = counted(monkeypatch, reader, reader.partitions())
    assert len(got) == read == 40 + 60 + 120                                        # of 600: the union of each file's windows


def test_names_patterns_and_uris(spark, tmp_path):
    from tickline.sources.scid import list_files
    (tmp_path / "a").mkdir(), (tmp_path / "b,c").mkdir()
    for n in ("a/ESH24.scid", "a/ES[H24.scid", "a/note.txt", "b,c/NQH25.scid"):
        _write(tmp_path / n, ROWS[:1])
    t = str(tmp_path)
    assert list_files(f"{t}/a") == [f"{t}/a/ESH24.scid", f"{t}/a/ES[H24.scid"]
    assert list_files(f"file://{t}/b,c") == [f"file://{t}/b,c/NQH25.scid"]
    assert list_files(f"{t}/*/ES*.scid") == [f"{t}/a/ESH24.scid", f"{t}/a/ES[H24.scid"]
    assert list_files([f"{t}/a/ES[H24.scid", f"file:{t}/b,c/*H25.scid", f"{t}/no"]) == [f"{t}/a/ES[H24.scid", f"file:{t}/b,c/NQH25.scid"]
    rows = scan_ticks(spark, [f"{t}/a/ES[H24.scid", f"file:{t}/b,c"]).select("file", "contract").collect()
    assert {tuple(r) for r in rows} == {(f"{t}/a/ES[H24.scid", "ES[H24"), (f"file:{t}/b,c/NQH25.scid", "NQH25")}
    with pytest.raises(Exception, match="no tick files"):
        scan_ticks(spark, f"{t}/none").count()
    assert scan_ticks(spark, files=[(f"{t}/none", None, None)]).count() == 0


def test_written_files_appear_when_all_tasks_are_done(spark, tmp_path):
    from tickline.sources.scid import write_ticks
    ticks = scan_ticks(spark, _some(tmp_path)).drop("file")
    write_ticks(ticks.withColumn("part", F.when(F.col("record_no") > 1, "late")), str(tmp_path / "out"))
    names = sorted(n.split(".")[0:2] for n in os.listdir(tmp_path / "out"))
    assert [n[0] for n in names] == ["ESZ24_FUT_CME"] * 2 and names[1][1] == "late"
    assert scan_ticks(spark, str(tmp_path / "out")).count() == 4
    broken = ticks.withColumn("volume", F.when(F.col("record_no") == 3, F.raise_error(F.lit("no"))).otherwise(F.col("volume")).cast("long"))
    with pytest.raises(Exception):
        write_ticks(broken, str(tmp_path / "broken"))
    assert not [n for n in (os.listdir(tmp_path / "broken") if os.path.isdir(tmp_path / "broken") else []) if n.endswith(".scid")]


def _some(tmp_path):
    _write(tmp_path / "ESZ24.scid", ROWS)
    return str(tmp_path / "ESZ24.scid")


def test_a_growing_file_is_streamed_once(spark, tmp_path):
    from tickline.sources.scid import follow_ticks
    src, sink, ck = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "ck")
    src.mkdir()
    whole = np.zeros(5, dtype=np.dtype(RECORD_DTYPE))
    whole["raw_time"] = [r[0] for r in ROWS] + [ROWS[-1][0] + 5]

    def run():
        (follow_ticks(spark, str(src)).writeStream.format("parquet").option("checkpointLocation", ck)
         .trigger(once=True).start(sink).awaitTermination())

    _write(src / "ESZ24.scid", ROWS[:2], tail=whole[2:3].tobytes()[:11])      # the third record is still being written
    run()
    with open(src / "ESZ24.scid", "ab") as fh:
        fh.write(whole[2:5].tobytes()[11:])
    _write(src / "ESH25.scid", ROWS[:1])
    run()
    run()
    got = sorted((r.contract, r.record_no) for r in spark.read.parquet(sink).collect())
    assert got == [("ESH25", 0)] + [("ESZ24", k) for k in range(5)]
