"""Tick view over the driver's ``events`` table.

The test data holds no exchange ticks, so we derive a deterministic tick
stream from ``events`` with exact arithmetic only (all prices are multiples
of 0.25, so double sums and comparisons do not depend on evaluation order).
The same definition is written in SQL for the DuckDB oracle
(``tickline.plans.catalog.TICKS_SQL``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickline.schema import EPOCH_SHIFT_US, FIRST_BUNDLE_TRADE, LAST_BUNDLE_TRADE, TICK_SCHEMA


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def ticks_from_events(ev: DataFrame) -> DataFrame:
    """events(event_id, ts, user_id, value, ...) -> canonical tick rows."""
    ts = F.col("ts").cast("timestamp")            # timestamp_ntz read as a UTC instant
    us = F.unix_micros(ts)
    minute = ((us - F.pmod(us, F.lit(60000000))) / F.lit(60000000)).cast("long")
    close = (F.lit(5000.0)
             + F.lit(0.25) * F.abs(F.pmod(minute, F.lit(400)) - F.lit(200))
             + F.lit(0.25) * F.floor(F.col("value") / F.lit(50.0)))
    eid = F.col("event_id")
    volume = F.lit(1) + F.pmod(eid, F.lit(5))
    even = F.pmod(eid, F.lit(2)) == 0
    return ev.select(
        ts.alias("datetime"),
        (us + F.lit(EPOCH_SHIFT_US)).alias("raw_time"),
        F.when(F.pmod(eid, F.lit(10)) == 3, F.lit(FIRST_BUNDLE_TRADE))
         .when(F.pmod(eid, F.lit(10)) == 7, F.lit(LAST_BUNDLE_TRADE))
         .otherwise(F.lit(0.0)).alias("open"),
        (close + F.lit(0.25)).alias("high"),
        (close - F.lit(0.25)).alias("low"),
        close.alias("close"),
        F.lit(1).cast("long").alias("num_trades"),
        volume.cast("long").alias("volume"),
        F.when(even, volume).otherwise(F.lit(0)).cast("long").alias("bid_volume"),
        F.when(even, F.lit(0)).otherwise(volume).cast("long").alias("ask_volume"),
        F.when(F.pmod(F.col("user_id"), F.lit(2)) == 0, F.lit("ESH24"))
         .otherwise(F.lit("ESM24")).alias("contract"),
        eid.cast("long").alias("record_no"),
    )


def tick_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = ticks_from_events(events(spark, sf_dir))
    return df.select([F.col(f.name).cast(f.dataType) for f in TICK_SCHEMA.fields])


def redelivered(ticks: DataFrame, since: str = "2024-01-10") -> DataFrame:
    """A resumed load re-reads the file from an earlier offset: every tick from
    ``since`` on arrives again, same key, volume + 1 (so the winner is visible)."""
    return (ticks.where(F.col("datetime") >= F.to_timestamp(F.lit(since)))
                 .withColumn("volume", F.col("volume") + 1))


def grow_files(spark: SparkSession, src: str, dst: str, share: float) -> None:
    """Bring the tick files of ``dst`` up to ``share`` of the records of those in
    ``src``, and a part of one more record; tasks copy the bytes."""
    from tickline.schema import HEADER_SIZE, RECORD_SIZE
    from tickline.sources.scid import copy_prefix, sized_files, whole_records

    def cut(size: int) -> int:
        n = whole_records(size)
        return min(size, HEADER_SIZE + int(n * share) * RECORD_SIZE + RECORD_SIZE // 3)

    files = [(name, f"{dst.rstrip('/')}/{name.rsplit('/', 1)[-1]}", cut(size)) for name, size in sized_files(src).items()]

    def run(batches):
        for b in batches:
            for row in b.to_pylist():
                copy_prefix(**row)
        yield from ()

    (spark.createDataFrame(files, "src string, dst string, size long").repartition(max(1, len(files))).mapInArrow(run, "src string")
          .write.format("noop").mode("overwrite").save())
