"""Tick files followed while they grow; bars that take late ticks."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tests.test_loads import ticks
from tests.test_sources import _raw, _write
from tickline.context import workspace
from tickline.operators.bars import bars_all
from tickline.plans.bar_table import merge_bars, read_bars
from tickline.plans.ingest import read_table
from tickline.schema import RECORD_DTYPE
from tickline.sources.calendar import contract_calendar
from tickline.sources.scid import TickFileStream
from tickline.streaming.follow import follow_into, last_offset, read_follow_ledger

MINUTE = 60_000_000
START = _raw("2024-03-01T00:00:00")


def records(lo, hi):
    return [(START + i * MINUTE // 4, 0.0, 10 + i % 7, 9 - i % 5, 5 + i % 11, 1, 1 + i % 3, 0, 0) for i in range(lo, hi)]


def bars_of(df):
    return {r.candle_time: tuple(r) for r in df.select("candle_time", "open", "high", "low", "close", "volume", "trades").collect()}


class Stop(Exception):
    pass


@pytest.fixture
def files(tmp_path):
    (tmp_path / "in").mkdir()
    a, b, late = (str(tmp_path / "in" / n) for n in ("ESH24_FUT_CME.scid", "ESM24, x.scid", "ESU24.scid"))
    cfg = {"symbols": {"ES": {"contracts": [{"file": f"file:{a}", "end_date": "2024-03-02"}, {"file": b, "start_date": "2024-03-01"}, {"file": late}]},
                       "NQ": {"table_name": "NQ_ticks", "contracts": [{"file": b, "end_date": "2024-03-02"}]}}}
    (tmp_path / "config.json").write_text(json.dumps(cfg))
    return a, b, late, str(tmp_path / "config.json")


def test_growing_files_come_into_the_tables_once(spark, files):
    a, b, late, config = files
    cal = contract_calendar(spark, config)
    root, bars, ledger, ck = (workspace(spark, n) for n in ("table", "bars", "ledger", "ck"))
    _write(a, records(0, 500), tail=b"\x01" * 13)
    _write(b, records(300, 400))
    seen = []

    def probe(step):
        seen.append(step)
        if len(seen) == 3:
            raise Stop                      # in the middle of a batch, between its commits

    with pytest.raises(Exception, match="Stop"):
        follow_into(spark, cal, root, ledger, ck, bars, records_per_trigger=150, probe=probe)
    assert json.loads(last_offset(spark, ck)) != {}
    _write(a, records(0, 700))              # grown: what was there is as it was
    _write(late, records(6000, 6010))       # a file that comes later
    follow_into(spark, cal, root, ledger, ck, bars, records_per_trigger=150)
    follow_into(spark, cal, root, ledger, ck, bars, records_per_trigger=150)
    _write(b, records(300, 450))
    follow_into(spark, cal, root, ledger, ck, bars, records_per_trigger=150)

    day = START + 24 * 60 * MINUTE
    es = {START + i * MINUTE // 4 for i in range(700)} | {START + i * MINUTE // 4 for i in range(6000, 6010)}
    stored = read_table(spark, f"{root}/ES")
    assert sorted(r.raw_time for r in stored.collect()) == sorted(es)
    nq = [START + i * MINUTE // 4 for i in range(300, 450)]
    assert sorted(r.raw_time for r in read_table(spark, f"{root}/NQ_ticks").collect()) == [t for t in nq if t < day]
    assert bars_of(read_bars(spark, f"{bars}/ES")) == bars_of(bars_all(stored))
    led = read_follow_ledger(spark, ledger)
    rows = {(r.symbol, r.file): (r.n, r.i, r.lo, r.hi) for r in led.groupBy("symbol", "file").agg(
        F.sum("rows_processed").alias("n"), F.sum("rows_inserted").alias("i"), F.min("first_record").alias("lo"), F.max("last_record").alias("hi")).collect()}
    assert {k: v[0] for k, v in rows.items()} == {("ES", f"file:{a}"): 700, ("ES", b): 150, ("ES", late): 10, ("NQ", b): 150}
    assert rows["NQ", b] == (150, 150, 0, 149) and sum(v[1] for k, v in rows.items() if k[0] == "ES") == len(es)
    jobs = led.groupBy("job").agg(F.sum("rows_processed")).collect()
    assert len(jobs) > 5 and led.groupBy("job", "symbol", "file").count().where("count > 1").count() == 0


def test_a_trigger_takes_no_more_than_its_share(tmp_path):
    from tickline.schema import SCAN_SCHEMA
    for k, n in enumerate((1000, 10, 90)):
        _write(tmp_path / f"ES{k}.scid", records(0, n))
    options = {"paths": json.dumps([str(tmp_path)]), "recordsPerTrigger": "100"}
    s, at, taken = TickFileStream(options, SCAN_SCHEMA), {}, []
    for _ in range(20):
        new = s.latestOffset()
        if new == at:
            break
        parts = s.partitions(at, new)
        taken.append(sum(p.stop - p.first for p in parts))
        if len(taken) == 2:         # a restart
            s = TickFileStream({**options, "startOffset": json.dumps(new)}, SCAN_SCHEMA)
        at = new
    assert taken == [100] * 11 and sorted(at.values()) == [10, 90, 1000]
    assert all(v > 0 for v in at.values())


def test_late_ticks_correct_their_bars(spark):
    t = ticks(spark, SF_SMALL)
    path = workspace(spark, "bars")
    rng = np.random.default_rng(2)
    order = [int(k) for k in rng.permutation(5)]
    for k in order:                         # every part has ticks of most minutes, and some minutes' first and last ones
        merge_bars(t.where(F.pmod(F.xxhash64("record_no"), F.lit(5)) == k), path, job=f"part-{k}")
        merge_bars(t.where(F.pmod(F.xxhash64("record_no"), F.lit(5)) == k), path, job=f"part-{k}")       # again: no change
    assert bars_of(read_bars(spark, path)) == bars_of(bars_all(t))
    assert merge_bars(t.limit(0), path) == 0
    assert RECORD_DTYPE and bars_of(read_bars(spark, workspace(spark, "none"))) == {}
