"""Publishing by whole files: broken jobs, copy-on-write, footers."""

import os
import shutil
import time

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tests.test_loads import plan, ticks
from tickline.context import workspace
from tickline.plans import publish as P
from tickline.plans.ingest import insert_ignore, read_table, stage_monthly, upsert_replace, write_monthly
from tickline.plans.maintain import (
    compact_old, detach_month, drop_month, month_rows, partition_files, partition_inventory, table_sizes, table_summary,
)


class Broken(Exception):
    pass


def break_at(monkeypatch, k):
    """Let the ``k``-th change of a table fail."""
    count = [0]

    def step(action, *args):
        count[0] += 1
        if count[0] > k:
            raise Broken
        return action(*args)

    monkeypatch.setattr(P, "_step", step)


def local(path):
    return path.replace("file:", "")


def ids(spark, *tables):
    out = []
    for t in tables:
        if os.path.exists(local(t)):
            out += [r.record_no for r in read_table(spark, t).select("record_no").collect()]
    return sorted(out)


def small(spark, lo, hi, shift=0):
    """Rows ``lo`` to ``hi``, an hour apart, over some months."""
    us = F.lit(1_704_067_200_000_000) + F.col("id") * 3_600_000_000 * 5
    return spark.range(lo, hi, numPartitions=2).select(
        F.timestamp_micros(us).alias("datetime"), (us + 2209161600000000).alias("raw_time"), *(F.lit(1.0).alias(c) for c in ("open", "high", "low", "close")),
        *(F.lit(1 + shift).cast("long").alias(c) for c in ("num_trades", "volume", "bid_volume", "ask_volume")),
        F.when(F.col("id") % 2 == 0, "ESH24").otherwise("ESM24").alias("contract"), (F.col("id") + shift).alias("record_no"))


def steps_of(monkeypatch, prepare, job, check):
    """Break ``job`` before each of its changes in turn; ``check`` after each, then finish it."""
    for k in range(100):
        state = prepare()
        with monkeypatch.context() as m:
            break_at(m, k)
            try:
                job(state)
                broke = False
            except Broken:
                broke = True
        check(state, broke)
        if not broke:
            return k
    raise AssertionError("never came to its end")


@pytest.fixture(scope="module")
def base(spark):
    """A table of 200 rows over two months, and 60 more rows staged."""
    path = workspace(spark, "table")
    write_monthly(small(spark, 0, 200), path)
    return path


def copies(base):
    n = [0]

    def copy():
        n[0] += 1
        target = f"{base}-{time.monotonic_ns()}-{n[0]}"
        shutil.copytree(local(base), local(target))
        return target
    return copy


def test_a_broken_publish_is_finished_or_undone(spark, base, monkeypatch):
    template = f"{base}-staged"
    shutil.copytree(local(base), local(template))
    new = small(spark, 150, 260, shift=1000)
    stage_monthly(new.withColumn("month", F.date_format("datetime", "yyyyMM")), template, "job", None)
    old = P.published_files(spark, base)
    before, after = list(range(200)), sorted([*range(1150, 1260)])

    def check(path, broke):
        seen = ids(spark, path)
        assert seen in (before, after)                      # readers see all of a commit or nothing
        P.recover(spark, path)
        assert ids(spark, path) == seen                     # and mending changes nothing that was seen
        names = set(os.listdir(local(path)))
        assert not [n for n in os.listdir(f"{local(path)}/_staged") if n] if "_staged" in names else True
        P.recover(spark, path)
        assert ids(spark, path) == seen

    assert steps_of(monkeypatch, copies(template), lambda p: P.publish(spark, p, "job", old), check) > 6


def test_a_broken_recovery_is_recovered(spark, base, monkeypatch):
    template = f"{base}-committed"
    shutil.copytree(local(base), local(template))
    stage_monthly(small(spark, 200, 230).withColumn("month", F.date_format("datetime", "yyyyMM")), template, "job", None)
    with monkeypatch.context() as m:
        break_at(m, 3)
        with pytest.raises(Broken):
            P.publish(spark, template, "job", P.published_files(spark, base))

    def check(path, broke):
        assert ids(spark, path) == list(range(200, 230))
        P.recover(spark, path)
        assert ids(spark, path) == list(range(200, 230))

    steps_of(monkeypatch, copies(template), lambda p: P.recover(spark, p), check)


def test_a_broken_detach_has_the_month_once(spark, base, monkeypatch):
    copy = copies(base)
    total = list(range(200))

    def prepare():
        t = copy()
        return t, f"{t}-archive"

    def check(state, broke):
        table, archive = state
        assert ids(spark, table, archive) == total
        P.recover(spark, archive)
        assert ids(spark, table, archive) == total
        P.recover(spark, table)
        assert ids(spark, table, archive) == total
        detach_month(spark, table, "202401", archive)
        assert ids(spark, table, archive) == total and len(ids(spark, archive)) == 149
        assert not os.path.exists(f"{local(table)}/month=202401")
        detach_month(spark, table, "202401", archive)
        assert ids(spark, table, archive) == total

    # The archive holds an older copy of the month, which is replaced.
    assert steps_of(monkeypatch, prepare, lambda s: detach_month(spark, s[0], "202401", s[1]), check) > 6


@pytest.mark.parametrize("job", ["insert", "upsert", "compact", "drop"])
def test_broken_jobs_run_again(spark, base, monkeypatch, job):
    late = small(spark, 190, 220, shift=0).cache()
    run = {"insert": lambda p: insert_ignore(late, p), "upsert": lambda p: upsert_replace(late, p),
           "compact": lambda p: compact_old(spark, p, f"{p}-ledger", "2025-01-01"), "drop": lambda p: drop_month(spark, p, "202402")}[job]
    want = {"insert": list(range(220)), "upsert": list(range(220)), "compact": list(range(200)), "drop": list(range(149))}[job]

    def check(path, broke):
        assert ids(spark, path) in (list(range(200)), want)
        if broke:
            run(path)
        assert ids(spark, path) == want

    # Every second change: each run is several Spark jobs.
    copy = copies(base)
    for k in range(0, 100, 2):
        path = copy()
        with monkeypatch.context() as m:
            break_at(m, k)
            try:
                run(path)
                broke = False
            except Broken:
                broke = True
        check(path, broke)
        if not broke:
            break


def test_a_named_job_is_done_once(spark):
    path = workspace(spark, "table")
    assert insert_ignore(small(spark, 0, 50), path, job="batch-1") == 50
    assert insert_ignore(small(spark, 0, 80), path, job="batch-1") == 50 and ids(spark, path) == list(range(50))
    assert insert_ignore(small(spark, 0, 80), path, job="batch-2") == 30
    assert insert_ignore(small(spark, 0, 80), path, job="batch-3") == 0 and P.done_record(spark, path, "batch-3")["note"] == {"rows": 0}
    assert ids(spark, path) == list(range(80))


def stamps(path):
    return {f"{d}/{n}": os.stat(f"{local(path)}/{d}/{n}").st_mtime_ns for d in os.listdir(local(path)) if "=" in d
            for n in os.listdir(f"{local(path)}/{d}") if n.endswith(".parquet")}


def test_an_upsert_leaves_other_files_alone(spark, monkeypatch):
    monkeypatch.setattr("tickline.plans.ingest.ROWS_PER_FILE", 100)
    path = workspace(spark, "table")
    t = ticks(spark, SF_SMALL)
    rows = t.count()
    write_monthly(t, path, rows=rows)
    before = stamps(path)
    assert len(before) > 5
    hour = t.where(F.col("datetime").between("2024-01-12 09:00:00", "2024-01-12 12:00:00"))
    again, fresh = hour.withColumn("volume", F.lit(777).cast("long")), hour.limit(1).withColumn("raw_time", F.col("raw_time") + 1)
    n = hour.count()
    assert n
    upsert_replace(again.unionByName(fresh), path)
    after = stamps(path)
    kept = {f: s for f, s in before.items() if after.get(f) == s}
    assert len(before) - 2 <= len(kept) < len(before)            # one file's range, or two
    assert read_table(spark, path).count() == rows + 1
    assert read_table(spark, path).where("volume = 777").count() == n
    # Only new keys: no file is touched.
    upsert_replace(fresh.withColumn("raw_time", F.col("raw_time") + 7), path)
    assert {f: s for f, s in after.items() if stamps(path).get(f) == s} == after


def test_inventories_read_no_rows(spark, base):
    for df in (month_rows(spark, base), table_summary(spark, base), partition_inventory(spark, base), table_sizes(spark, {"a": base})):
        text = plan(df)
        scans = [x for x in text.splitlines() if "Scan" in x]
        assert scans and all("PushedAggregation: [COUNT(*)" in x or "binaryFile" in x and "content" not in x for x in scans), text
    assert "content" not in plan(partition_files(spark, base))
    got = {r.month: (r.rows, r.files) for r in partition_inventory(spark, base).collect()}
    assert {m: n for m, (n, _) in got.items()} == {"202401": 149, "202402": 51}
    r = table_summary(spark, base).first()
    want = read_table(spark, base).agg(F.count(F.lit(1)), F.min("datetime"), F.max("datetime"), F.max("raw_time")).first()
    assert tuple(r) == tuple(want)
    none = workspace(spark, "none")
    assert tuple(table_summary(spark, none).first()) == (0, None, None, None)
    assert table_sizes(spark, {"a": none}).select("rows", "bytes").first() == (0, 0)


def test_inventories_see_a_commit_that_is_not_carried_out(spark, base, monkeypatch):
    path = copies(base)()
    with monkeypatch.context() as m:
        break_at(m, 4)
        with pytest.raises(Broken):
            upsert_replace(small(spark, 100, 210), path)
    assert ids(spark, path) == list(range(210))
    assert table_summary(spark, path).first().record_count == 210
    assert sum(r.rows for r in partition_inventory(spark, path).collect()) == 210


def test_symbols_load_at_the_same_time(spark, monkeypatch):
    from tickline.plans import catalog, ingest
    spans, real = [], ingest._load_symbol

    def load(*a):
        start = time.monotonic()
        try:
            return real(*a)
        finally:
            spans.append((start, time.monotonic()))

    monkeypatch.setattr(ingest, "_load_symbol", load)
    catalog._synced(spark, SF_SMALL)
    (a, b), (c, d) = sorted(spans)[:2]
    assert c < b and a < d
