"""OHLCV bars.

Two semantics, both kept:

* ``bars_all`` -- every tick counts (bundle markers included); open/close are
  the close of the first/last tick by (datetime, raw_time); high/low come from
  the tick high/low columns.  Columns: candle_time, open, high, low, close,
  volume, trades.
* ``bars_clean`` -- marker rows dropped first, prices scaled, open repaired;
  first/last in file order; grouped on the integer raw-clock minute and turned
  into a timestamp only after aggregation.  Columns: datetime, open, high, low,
  close, trades, volume, bid_volume, ask_volume.

Both are one hash aggregate: partial aggregation on the map side, one exchange
on the minute key, final aggregation.  First and last go by one long: the
microseconds of raw_time within the minute (26 bits) above the record number
(37 bits), so every buffer is a fixed-width value and no rows are sorted.  A
hot minute is combined before the shuffle and never lands whole on one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickline.context import path_exists
from tickline.functions.expr import bucket_to_timestamp, month_key, start_of_minute
from tickline.operators.clean import chosen_ticks, clean_ticks
from tickline.operators.joins import materialize
from tickline.plans.publish import new_job, publish, published_files, read_published, recover, staged_path
from tickline.schema import MINUTE_US


BARS_PER_FILE = 1_000_000
RECORD_BITS = 37      # a file of up to 1.3e11 records


def order_key(ticks: DataFrame, width: int = MINUTE_US):
    """(raw_time, record_no) within one bar as a long.  For bars of at most 67
    seconds; wider ones use a struct (and so a sort aggregate)."""
    record = F.col("record_no") if "record_no" in ticks.columns else F.lit(0).cast("long")
    if width > 1 << (63 - RECORD_BITS):
        return F.struct(F.col("raw_time"), record)
    return F.shiftleft(F.pmod(F.col("raw_time"), F.lit(width)), RECORD_BITS) + record


def bars_all(ticks: DataFrame, by: list[str] | None = None) -> DataFrame:
    by = list(by or [])
    key = order_key(ticks)
    return (ticks
            .groupBy(*by, start_of_minute("datetime").alias("candle_time"))
            .agg(F.min_by("close", key).alias("open"),
                 F.max("high").alias("high"),
                 F.min("low").alias("low"),
                 F.max_by("close", key).alias("close"),
                 F.sum("volume").cast("long").alias("volume"),
                 F.sum("num_trades").cast("long").alias("trades")))


def bars_clean(ticks: DataFrame, multiplier: float = 1.0, minutes: int = 1,
               by: list[str] | None = None) -> DataFrame:
    by = list(by or [])
    width = MINUTE_US * int(minutes)
    bucket = F.expr(f"raw_time div {width}")
    key = order_key(ticks, width)
    agg = (clean_ticks(ticks, multiplier)
           .groupBy(*by, bucket.alias("_bucket"))
           .agg(F.min_by("open", key).alias("open"),
                F.max("high").alias("high"),
                F.min("low").alias("low"),
                F.max_by("close", key).alias("close"),
                F.sum("num_trades").cast("long").alias("trades"),
                F.sum("volume").cast("long").alias("volume"),
                F.sum("bid_volume").cast("long").alias("bid_volume"),
                F.sum("ask_volume").cast("long").alias("ask_volume")))
    return agg.select(*by, bucket_to_timestamp("_bucket", minutes).alias("datetime"),
                      "open", "high", "low", "close", "trades", "volume",
                      "bid_volume", "ask_volume")


def bars_clean_range(ticks: DataFrame, start=None, end=None, limit: int | None = None,
                     multiplier: float = 1.0, calendar: DataFrame | None = None, by: list[str] | None = None) -> DataFrame:
    """The file resampler's full argument set: limit (first records of the
    file), half-open time range on the raw clock, then ``bars_clean``.  Without
    dates each file's window in the ``calendar`` holds."""
    return bars_clean(chosen_ticks(ticks, start, end, limit, calendar), multiplier, by=by)


def bars_range(bars: DataFrame, start=None, end=None, time_col: str = "candle_time") -> DataFrame:
    """Bars with ``start <= t < end``, ordered by time."""
    out = bars
    by_month = "month" in out.columns
    if start is not None:
        at = F.to_timestamp(F.lit(str(start)))
        out = out.where(F.col(time_col) >= at)
        if by_month:        # a month partition before the start holds none of it
            out = out.where(F.col("month") >= month_key(at))
    if end is not None:
        at = F.to_timestamp(F.lit(str(end)))
        out = out.where(F.col(time_col) < at)
        if by_month:
            out = out.where(F.col("month") <= month_key(at))
    if by_month:
        out = out.drop("month")
    return out.orderBy(time_col)


def bars_backfill(ticks: DataFrame, bar_path: str) -> DataFrame:
    """Aggregate history into the bar table (month-partitioned).  New bars
    replace stored ones of the same minute, other stored bars of their months
    stay; only those months are written anew, and published as one.  So a run is
    idempotent, never double counts, and may cover any range of whole minutes."""
    spark = ticks.sparkSession
    bars = materialize(bars_all(ticks).withColumn("month", month_key("candle_time")))
    months = [r.month for r in bars.df.select("month").distinct().collect()]     # bounded by the calendar
    recover(spark, bar_path)
    both, old_files = bars, []
    if months and path_exists(spark, bar_path):
        old_files = [n for n in published_files(spark, bar_path) if n.split("/")[0].removeprefix("month=") in set(months)]
    if old_files:
        old = read_published(spark, bar_path, bars.df.schema, only=old_files).join(bars.df.select("candle_time"), "candle_time", "left_anti")
        both = materialize(bars.df.unionByName(old.select(*bars.df.columns)))
    if both.rows:
        job, parts = new_job("backfill"), max(1, -(-both.rows // BARS_PER_FILE))
        (both.df.repartitionByRange(parts, "month", "candle_time").sortWithinPartitions("month", "candle_time")
             .write.mode("overwrite").partitionBy("month").parquet(staged_path(bar_path, job)))
        publish(spark, bar_path, job, old_files)
    return read_published(spark, bar_path, bars.df.schema)


def head_tail(bars: DataFrame, n: int = 10, time_col: str = "candle_time") -> DataFrame:
    """First and last ``n`` rows by time (two TakeOrderedAndProject, no full sort)."""
    head = bars.orderBy(F.col(time_col).asc()).limit(n).withColumn("part", F.lit("head"))
    tail = bars.orderBy(F.col(time_col).desc()).limit(n).withColumn("part", F.lit("tail"))
    return head.unionByName(tail)


def latest_ticks(ticks: DataFrame, n: int = 5) -> DataFrame:
    order = [F.col("datetime").desc(), F.col("raw_time").desc()]
    if "record_no" in ticks.columns:
        order.append(F.col("record_no").desc())
    return ticks.orderBy(*order).limit(n)
