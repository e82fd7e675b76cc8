"""Tick files followed into the tables while they grow.

One stream reads the calendar's files by record number, at most so many records
a trigger.  Each micro-batch is cut to the files' rollover windows and loaded
for every symbol in three commits: the ticks into the symbol's table
(insert-ignore), what was new among them into its bars, and a ledger row for each
file.  All are named by the stream and the batch, so a batch that runs
again after a crash redoes none that is done: every record counts once.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tickline.context import path_exists
from tickline.functions.expr import path_key
from tickline.operators.joins import materialize
from tickline.plans.bar_table import merge_bars
from tickline.plans.ingest import TABLE_SCHEMA, dedupe_batch, insert_new, table_for, with_month
from tickline.plans.publish import done_record, names_in, publish, read_published, recover, text_of
from tickline.schema import KEY_COLUMNS
from tickline.sources.calendar import in_window, read_ranges, windows
from tickline.sources.scid import follow_ticks

FOLLOW_SCHEMA = T.StructType([
    T.StructField("job", T.StringType()),
    T.StructField("symbol", T.StringType()),
    T.StructField("file", T.StringType()),
    T.StructField("first_record", T.LongType()),
    T.StructField("last_record", T.LongType()),
    T.StructField("rows_processed", T.LongType()),
    T.StructField("rows_inserted", T.LongType()),
    T.StructField("committed_at", T.TimestampType()),
])


def read_follow_ledger(spark: SparkSession, ledger_path: str) -> DataFrame:
    if not path_exists(spark, ledger_path):
        return spark.createDataFrame([], FOLLOW_SCHEMA)
    return spark.read.schema(FOLLOW_SCHEMA).parquet(ledger_path)


def last_offset(spark: SparkSession, checkpoint: str) -> str | None:
    """Where a stream's last planned batch ends, from its checkpoint's offset log."""
    log = f"{checkpoint.rstrip('/')}/offsets"
    numbers = [int(n) for n in names_in(spark, log) if n.isdigit()]
    if not numbers:
        return None
    line = text_of(spark, f"{log}/{max(numbers)}").split("\n")[2]       # version, metadata, then one offset a source
    return None if line == "-" else line


def load_batch(batch: DataFrame, job: str, calendar: DataFrame, table_root: str, ledger_path: str, bar_root: str | None = None,
               probe: Callable[[str], None] | None = None) -> None:
    """Load one micro-batch of file records; ``probe`` is called after each commit."""
    spark = batch.sparkSession
    probe = probe or (lambda step: None)
    if read_follow_ledger(spark, ledger_path).where(F.col("job") == job).limit(1).count():
        return
    cal = materialize(windows(calendar).select("symbol", "table_name", "file_key", "window_start", "window_end")).side()
    staged = materialize(batch.withColumn("file_key", path_key("file")).join(cal, "file_key")
                              .where(in_window(F.col("datetime"), "window_start", "window_end")).drop("window_start", "window_end", "file_key")).df
    cols, ledger = [f.name for f in TABLE_SCHEMA.fields], None
    for symbol, table_name in sorted(tuple(r) for r in staged.select("symbol", "table_name").distinct().collect()):     # of the configuration
        table, name = table_for(table_root, table_name), f"{job}-{symbol}"
        mine = staged.where((F.col("symbol") == symbol) & (F.col("table_name") == table_name))
        fresh = materialize(dedupe_batch(with_month(mine).select(*cols, "file", F.struct("file", "record_no").alias("_order")), order="_order").drop("_order")).df
        recover(spark, table)
        if done_record(spark, table, name) is None:
            rows, _ = insert_new(fresh.select(*cols), table, name)
            publish(spark, table, name, note={"rows": rows})
            probe("ticks")
        new = read_published(spark, table, TABLE_SCHEMA, only=done_record(spark, table, name)["add"])
        if bar_root is not None:
            merge_bars(new, table_for(bar_root, table_name), name)
            probe("bars")
        inserted = fresh.join(new.select(*KEY_COLUMNS), KEY_COLUMNS, "left_semi").groupBy("file").agg(F.count(F.lit(1)).alias("rows_inserted"))
        seen = (mine.groupBy("symbol", "file").agg(F.min("record_no").alias("first_record"), F.max("record_no").alias("last_record"),
                                                   F.count(F.lit(1)).alias("rows_processed"))
                    .join(inserted, "file", "left").withColumn("rows_inserted", F.coalesce("rows_inserted", F.lit(0))))
        ledger = seen if ledger is None else ledger.unionByName(seen)
    if ledger is not None:
        now = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
        rows = ledger.withColumns({"job": F.lit(job), "committed_at": F.lit(now).cast("timestamp")})
        rows.select(*[F.col(f.name).cast(f.dataType) for f in FOLLOW_SCHEMA.fields]).coalesce(1).write.mode("append").parquet(ledger_path)


def follow_into(spark: SparkSession, calendar: DataFrame, table_root: str, ledger_path: str, checkpoint: str, bar_root: str | None = None,
                records_per_trigger: int | None = None, until_idle: bool = True, probe: Callable[[str], None] | None = None) -> StreamingQuery:
    """Follow the calendar's files into the symbols' tables (and, below
    ``bar_root``, their bars).  ``until_idle`` returns when all records that are
    there are loaded; otherwise the running query is returned.  Started again
    with the same checkpoint it goes on where it was; files may have grown, and
    the calendar may name more."""
    ticks = follow_ticks(spark, files=read_ranges(calendar), records_per_trigger=records_per_trigger, start=last_offset(spark, checkpoint))

    def load(batch: DataFrame, number: int) -> None:
        stream = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        load_batch(batch, f"{stream}-{number}", calendar, table_root, ledger_path, bar_root, probe)

    q = ticks.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint).start()
    if until_idle:
        try:
            q.processAllAvailable()
        finally:
            q.stop()
    return q
