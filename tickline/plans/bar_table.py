"""A table of 1-minute bars that takes ticks in any order.

A stored bar keeps, beside open and close, the packed order keys of the ticks
they come from (``operators.bars``).  Bars of the same minute from different
batches are then merged by the same minimum and maximum that made them, so a
tick that comes late corrects its bar, however late.  A merge rewrites only
the files that hold one of its minutes and is published with one record;
merges that are named by a stream's batch happen once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickline.context import path_exists
from tickline.functions.expr import month_key, start_of_minute
from tickline.operators.bars import BARS_PER_FILE, order_key
from tickline.operators.joins import materialize
from tickline.plans.ingest import extent, near_rows, touched_files
from tickline.plans.publish import done_record, new_job, publish, read_published, recover, staged_path

BAR_COLUMNS = ("candle_time", "open", "high", "low", "close", "volume", "trades")
STATE_SCHEMA = T.StructType(
    [T.StructField("candle_time", T.TimestampType())]
    + [T.StructField(c, T.DoubleType()) for c in ("open", "high", "low", "close")]
    + [T.StructField(c, T.LongType()) for c in ("volume", "trades", "first_key", "last_key")]
    + [T.StructField("month", T.StringType())])


def bar_states(ticks: DataFrame) -> DataFrame:
    """Bars of a batch with the keys of their first and last tick."""
    key = order_key(ticks)
    return ticks.groupBy(start_of_minute("datetime").alias("candle_time")).agg(
        F.min_by("close", key).alias("open"), F.max("high").alias("high"), F.min("low").alias("low"), F.max_by("close", key).alias("close"),
        F.sum("volume").cast("long").alias("volume"), F.sum("num_trades").cast("long").alias("trades"),
        F.min(key).alias("first_key"), F.max(key).alias("last_key")).withColumn("month", month_key("candle_time"))


def merged_states(states: DataFrame) -> DataFrame:
    """One bar per minute from several."""
    return states.groupBy("candle_time", "month").agg(
        F.min_by("open", "first_key").alias("open"), F.max("high").alias("high"), F.min("low").alias("low"), F.max_by("close", "last_key").alias("close"),
        F.sum("volume").cast("long").alias("volume"), F.sum("trades").cast("long").alias("trades"),
        F.min("first_key").alias("first_key"), F.max("last_key").alias("last_key")).select(*STATE_SCHEMA.names)


def read_states(spark: SparkSession, bar_path: str) -> DataFrame:
    if not path_exists(spark, bar_path):
        return spark.createDataFrame([], STATE_SCHEMA)
    return read_published(spark, bar_path, STATE_SCHEMA)


def read_bars(spark: SparkSession, bar_path: str) -> DataFrame:
    return read_states(spark, bar_path).select(*BAR_COLUMNS)


def merge_bars(ticks: DataFrame, bar_path: str, job: str | None = None) -> int:
    """Add ticks that the table has not seen to its bars.  Returns the number
    of bars they belong to.  A named ``job`` is done once."""
    spark = ticks.sparkSession
    recover(spark, bar_path)
    before = done_record(spark, bar_path, job) if job else None
    if before:
        return before["note"]["bars"]
    new = materialize(bar_states(ticks).select(*STATE_SCHEMA.names))
    out, rows, old_files = new.df, new.rows, []
    if new.rows and path_exists(spark, bar_path):
        _, months, lo, hi = extent(new.df, "candle_time")
        old_files = touched_files(near_rows(read_states(spark, bar_path), months, lo, hi, "candle_time"), new.df, ["candle_time"])
    if old_files:
        old = read_published(spark, bar_path, STATE_SCHEMA, only=old_files).select(*STATE_SCHEMA.names)
        out, rows = merged_states(old.unionByName(out)), rows + old.count()      # from the files' footers
    name = job or new_job("bars")
    if new.rows:
        (out.repartitionByRange(max(1, -(-rows // BARS_PER_FILE)), "month", "candle_time").sortWithinPartitions("month", "candle_time")
            .write.mode("overwrite").partitionBy("month").parquet(staged_path(bar_path, name)))
    if new.rows or job:
        publish(spark, bar_path, name, old_files, note={"bars": new.rows} if job else None)
    return new.rows
