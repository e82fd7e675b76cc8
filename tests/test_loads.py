"""Loads, maintenance and the fade scan beyond what the registered queries cover."""

import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tickline.context import workspace
from tickline.operators.bars import bars_all, bars_clean
from tickline.operators.scan import first_drawdown
from tickline.plans.ingest import LEDGER_SCHEMA, insert_ignore, pending_files, read_table, upsert_replace
from tickline.plans.maintain import migrate_layout
from tickline.sources.fixture import events, ticks_from_events


def ticks(spark, sf_dir):
    return ticks_from_events(events(spark, sf_dir))


NOW = dt.datetime(2024, 1, 1)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("chunks", [4, 64])
def test_fade_scan_equals_a_window_on_unsorted_rows(spark, chunks):
    """Range bounds are sampled: the chunk ids must still be the same for both branches."""
    rows = spark.range(0, 400_000, numPartitions=7).select(
        F.pmod(F.xxhash64("id", F.lit(1)), F.lit(4)).cast("int").alias("g"), F.xxhash64("id", F.lit(2)).alias("t"), F.col("id").alias("rec"),
        (F.pmod(F.xxhash64("id", F.lit(3)), F.lit(100_000)) / 4).alias("q"), F.lit(None).cast("double").alias("seed"), F.lit(24_000.0).alias("depth"))
    got = {r.g: tuple(r.hit) for r in first_drawdown(rows, ["g"], ["t", "rec"], "q", "seed", "depth", chunks).collect()}
    w = Window.partitionBy("g").orderBy("t", "rec").rowsBetween(Window.unboundedPreceding, 0)
    want = {r.g: tuple(r.h) for r in (rows.withColumn("ext", F.max("q").over(w)).where(F.col("q") <= F.col("ext") - F.col("depth"))
                                      .groupBy("g").agg(F.min(F.struct("t", "rec", "q", "ext")).alias("h")).collect())}
    assert got == want and len(want) == 4


def test_bars_are_hash_aggregates(spark):
    t = ticks(spark, SF_SMALL)
    for bars in (bars_all(t), bars_clean(t)):
        assert "HashAggregate" in plan(bars) and "SortAggregate" not in plan(bars) and "Sort [" not in plan(bars)


def test_upsert_by_load_order_within_one_batch(spark):
    t = ticks(spark, SF_SMALL)
    both = t.withColumn("load", F.lit(2)).withColumn("volume", F.col("volume") + 7).unionByName(t.withColumn("load", F.lit(1)))
    path = workspace(spark, "table")
    upsert_replace(both, path, load_order="load")
    stored = read_table(spark, path)
    assert stored.count() == t.count()
    assert stored.agg(F.sum("volume")).first()[0] == t.agg(F.sum(F.col("volume") + 7)).first()[0]


def test_insert_ignore_takes_the_first_by_the_given_order(spark):
    t = ticks(spark, SF_SMALL).limit(200)
    both = t.withColumn("seq", F.lit(1)).unionByName(t.withColumn("seq", F.lit(0)).withColumn("volume", F.lit(99).cast("long")))
    path = workspace(spark, "table")
    assert insert_ignore(both, path, order=F.struct("seq", "record_no")) == 200
    assert insert_ignore(t, path) == 0 and insert_ignore(t.limit(0), path) == 0
    assert {r.volume for r in read_table(spark, path).collect()} == {99}


def test_equal_file_names_in_two_folders_are_two_files(spark):
    cal = spark.createDataFrame([("ES", "ES", 1.0, f, None, None) for f in ("/a/ESH24.scid", "C:\\b\\ESH24.scid", "file:///c/ESH24.scid")] + [("NQ", "NQ", 1.0, "/a/ESH24.scid", None, None)],
                                "symbol string, table_name string, price_multiplier double, file string, start_date string, end_date string")
    done = spark.createDataFrame([("ES", "c:/B/esh24.scid", True, 1, 1, 0.1, NOW), ("ES", "/C/ESH24.scid", True, 1, 1, 0.1, NOW), ("NQ", "/a/ESH24.scid", False, 0, 0, 0.1, NOW)], LEDGER_SCHEMA)
    assert {(r.symbol, r.file) for r in pending_files(cal, done).collect()} == {("ES", "/a/ESH24.scid"), ("NQ", "/a/ESH24.scid")}


def test_migration_needs_an_empty_target(spark):
    src, dst = workspace(spark, "flat"), workspace(spark, "table")
    ticks(spark, SF_SMALL).limit(50).withColumn("load_order", F.lit(0)).write.parquet(src)
    migrate_layout(spark, src, dst)
    with pytest.raises(ValueError):
        migrate_layout(spark, src, dst)


def test_study_agrees_for_any_number_of_partitions(spark):
    from tickline.plans import catalog
    was = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        found = []
        for n in ("3", "17"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            found.append(sorted(map(tuple, catalog.QUERIES["strategy_s3"](spark, "/root/testdata/sf0.1").collect())))
        assert found[0] == found[1] and found[0]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", was)
