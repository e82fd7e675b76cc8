"""Contract calendar: which file holds which contract, and its rollover window.

The configuration is JSON: ``symbols`` maps a symbol to ``{table_name,
price_multiplier, contracts: [{file, start_date, end_date}]}``.  It is read
with Spark (``wholetext`` + ``from_json`` as a MAP, ``explode`` twice); a
missing file gives the default configuration (ES and NQ, no contracts).
The calendar has one row per contract file; joins with it broadcast it when its
counted size is small and shuffle otherwise.  Files are matched by their whole
path, in any case and with either slash.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickline.context import path_exists
from tickline.functions.expr import contract_from_file, parse_config_date, path_key
from tickline.operators.joins import attach, materialize
from tickline.schema import CALENDAR_SCHEMA, EPOCH_SHIFT_US

CONFIG_SCHEMA = ("symbols MAP<STRING, STRUCT<table_name: STRING, price_multiplier: DOUBLE, "
                 "contracts: ARRAY<STRUCT<file: STRING, start_date: STRING, end_date: STRING>>>>")

# The configuration used when no file exists.
DEFAULT_CONFIG = {
    "symbols": {
        "ES": {"table_name": "ES", "price_multiplier": 1.0, "contracts": []},
        "NQ": {"table_name": "NQ", "price_multiplier": 1.0, "contracts": []},
    }
}


def contract_calendar(spark: SparkSession, config_path: str | None) -> DataFrame:
    """Rows (symbol, table_name, price_multiplier, file, start_date, end_date)."""
    if config_path and path_exists(spark, config_path):
        text = spark.read.text(config_path, wholetext=True)
    else:
        text = spark.createDataFrame([(json.dumps(DEFAULT_CONFIG),)], "value string")
    cfg = text.select(F.from_json("value", CONFIG_SCHEMA).alias("c"))
    sym = cfg.select(F.explode("c.symbols").alias("symbol", "s"))
    rows = sym.select("symbol",
                      F.coalesce(F.col("s.table_name"), F.col("symbol")).alias("table_name"),
                      F.coalesce(F.col("s.price_multiplier"), F.lit(1.0)).alias("price_multiplier"),
                      F.explode_outer("s.contracts").alias("k"))
    out = rows.select("symbol", "table_name", "price_multiplier",
                      F.coalesce(F.col("k.file"), F.lit("")).alias("file"),
                      F.col("k.start_date").alias("start_date"), F.col("k.end_date").alias("end_date"))
    return out.where(F.col("file") != "").select([F.col(f.name).cast(f.dataType) for f in CALENDAR_SCHEMA.fields])


def list_symbols(spark: SparkSession, config_path: str | None) -> DataFrame:
    if config_path and path_exists(spark, config_path):
        text = spark.read.text(config_path, wholetext=True)
    else:
        text = spark.createDataFrame([(json.dumps(DEFAULT_CONFIG),)], "value string")
    return text.select(F.explode(F.map_keys(F.from_json("value", CONFIG_SCHEMA).getField("symbols")))
                       .alias("symbol"))


def windows(calendar: DataFrame) -> DataFrame:
    """Calendar with the contract code and half-open UTC window bounds."""
    return calendar.select(
        "symbol", "table_name", "price_multiplier", "file",
        contract_from_file("file").alias("contract"),
        path_key("file").alias("file_key"),
        parse_config_date("start_date").alias("window_start"),
        parse_config_date("end_date").alias("window_end"))


def contract_window_lookup(files: DataFrame, calendar: DataFrame, file_col: str = "file") -> DataFrame:
    """Window of each file, matched case-insensitively on its path; files
    missing from the calendar get null bounds."""
    w = calendar.select(path_key("file").alias("file_key"), "symbol", "start_date", "end_date")
    return files.withColumn("file_key", path_key(file_col)).join(w, "file_key", "left").drop("file_key")


def in_window(ts, start, end):
    return (F.col(start).isNull() | (ts >= F.col(start))) & (F.col(end).isNull() | (ts < F.col(end)))


def rollover_filter(ticks: DataFrame, calendar: DataFrame, by: str = "contract") -> DataFrame:
    """Keep each contract's ticks inside its own window ``[start, end)``
    (null end = open).  ``by='contract'`` matches on the contract code,
    ``by='file'`` on the source file's path."""
    cal = materialize(windows(calendar).select("contract", "file_key", "window_start", "window_end")).side()
    if by == "file":
        t = ticks.withColumn("file_key", path_key("file"))
        j = t.join(cal.drop("contract"), "file_key")
    else:
        j = ticks.join(cal.drop("file_key"), "contract")
    return j.where(in_window(F.col("datetime"), "window_start", "window_end")).drop(
        "window_start", "window_end", "file_key")


def default_window(ticks: DataFrame, calendar: DataFrame) -> DataFrame:
    """Ticks of files (with their ``file``) cut to the window that the calendar
    has for the file, the first symbol's if several have one.  Files that it does
    not name stay whole."""
    w = (windows(calendar).groupBy("file_key")
         .agg(F.min(F.struct("symbol", "window_start", "window_end")).alias("w"))
         .select("file_key", "w.window_start", "w.window_end"))
    return (attach(ticks.withColumn("file_key", path_key("file")), materialize(w), "file_key", "left")
            .where(in_window(F.col("datetime"), "window_start", "window_end")).select(*ticks.columns))


def read_ranges(calendar: DataFrame) -> list[tuple[str, int | None, int | None]]:
    """Each file of the calendar with the raw times (from, before) that any of
    its windows asks for; None is open."""
    raw = lambda c: F.unix_micros(parse_config_date(c)) + EPOCH_SHIFT_US
    name = F.translate("file", "\\", "/")
    spans = calendar.groupBy(name.alias("file")).agg(
        F.when(F.count_if(raw("start_date").isNull()) == 0, F.min(raw("start_date"))).alias("lo"),
        F.when(F.count_if(raw("end_date").isNull()) == 0, F.max(raw("end_date"))).alias("hi"))
    # The calendar is configuration: its file list is read by the driver as the configuration is.
    return [(r.file, r.lo, r.hi) for r in spans.orderBy("file").collect()]


def continuous_series(spark: SparkSession, calendar: DataFrame, symbol: str | None = None,
                      ordered: bool = True, chronological: bool = False, split_records: int | None = None) -> DataFrame:
    """All contract files of the calendar, each cut to its window, as one
    series ordered by (datetime, raw_time).  Missing files are skipped.  The
    windows go to the reader with the files, so records outside are not decoded;
    with ``chronological`` (times never go back within a file) not even read."""
    from tickline.sources.scid import scan_ticks
    cal = calendar if symbol is None else calendar.where(F.col("symbol") == symbol)
    ticks = scan_ticks(spark, files=read_ranges(cal), chronological=chronological, split_records=split_records)
    out = rollover_filter(ticks, cal, by="file")
    return out.orderBy("datetime", "raw_time", "record_no") if ordered else out
